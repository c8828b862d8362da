"""The same results in DuckDB SQL, written from the rules' definitions."""

from __future__ import annotations

_AMOUNT = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
_CUSTOMER = "CAST(o_custkey AS VARCHAR)"

FEED = f"""
feed AS (
  SELECT
    CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderkey % 11 = 0 THEN 'abc'
         WHEN o_orderkey % 13 = 0 THEN '-' || {_AMOUNT}
         WHEN o_orderkey % 17 = 0 THEN NULL
         ELSE {_AMOUNT} END AS amount,
    CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%d-%m-%Y')
         WHEN o_orderkey % 19 = 0 THEN strftime(o_orderdate, '%Y') || '-02-30'
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_dt,
    CASE WHEN o_orderkey % 23 = 0 THEN {_CUSTOMER}
         ELSE lpad({_CUSTOMER}, 16, '0') END AS cust_code,
    CASE WHEN o_orderkey % 29 = 0 THEN 'c@example'
         ELSE 'c' || {_CUSTOMER} || '@example.com' END AS email,
    CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority
         ELSE substr(o_orderpriority, 3) END AS priority,
    CASE WHEN o_orderkey % 2 = 0 THEN 202501 ELSE 202502 END AS delivery
  FROM orders
)"""


# Fixed values in the rules below: the text each rule accepts.
def non_negative_number(c: str) -> str:
    return f"coalesce(regexp_matches({c}, '^[0-9]+(\\.[0-9]+)?\\z') AND try_cast({c} AS DOUBLE) >= 0, false)"


def iso_date(c: str) -> str:
    return (
        f"coalesce(regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\\z')"
        f" AND try_strptime({c}, '%Y-%m-%d') IS NOT NULL, false)"
    )


def email(c: str) -> str:
    return f"coalesce(regexp_matches({c}, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}\\z'), false)"


def exact_length(c: str, n: int) -> str:
    return f"coalesce(length({c}) = {n}, false)"


def no_digits(c: str) -> str:
    return f"coalesce(NOT regexp_matches({c}, '[0-9]'), false)"


def signed_number(c: str) -> str:
    return f"coalesce(regexp_matches({c}, '^-?[0-9]+(\\.[0-9]+)?\\z'), false)"


PASSED = {
    "amount": non_negative_number("amount"),
    "order_dt": iso_date("order_dt"),
    "cust_code": exact_length("cust_code", 16),
    "email": email("email"),
    "priority": no_digits("priority"),
}
VALID = " AND ".join(PASSED.values())
TYPED = "order_id, CAST(amount AS DOUBLE) AS amount, CAST(order_dt AS DATE) AS order_dt, cust_code, email, priority"
TEXT = "order_id, amount, order_dt, cust_code, email, priority"
DINS = "TIMESTAMP '2025-02-01 12:00:00' AS DINS"
CUSTOMERS = """
customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance,
         'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email
  FROM customer
)"""
# Metrics in long form, from a relation `flags` with one boolean per rule.
_FLAGS = "flags AS (SELECT delivery, " + ", ".join(f"{sql} AS ok_{c}" for c, sql in PASSED.items()) + " FROM feed)"
_ALL_OK = " AND ".join(f"ok_{c}" for c in PASSED)


def _metrics(select: str, group: str, value: str) -> str:
    counts = {"raw": "true", "good": _ALL_OK, "rejects": f"NOT ({_ALL_OK})"}
    counts |= {f"passed:{c}": f"ok_{c}" for c in PASSED}
    parts = [
        f"SELECT {select}'{name}' AS metric, count(*) FILTER (WHERE {condition}) AS {value} FROM flags {group}"
        for name, condition in counts.items()
    ]
    return f"WITH {FEED}, {_FLAGS} " + " UNION ALL ".join(parts)


def _rule(sql: str) -> str:
    return f"WITH {FEED} SELECT order_id, {sql} AS flag FROM feed"


_FIRST = f"SELECT delivery AS ID_PER, {TYPED} FROM feed WHERE {VALID}"
_CORRECTED = """
corrected AS (
  SELECT * REPLACE (CASE WHEN regexp_matches(priority, '^[0-9]-') THEN substr(priority, 3) ELSE priority END AS priority)
  FROM feed
)"""
_KNOWN_CUSTOMER = """cust_code IN (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 16, '0') FROM customer WHERE c_mktsegment = 'BUILDING')"""

ORACLES: dict[str, str] = {
    "csv_scan_strings": f"WITH {FEED} SELECT {TEXT} FROM feed",
    "period_from_filename": f'WITH {FEED} SELECT delivery AS ID_PER, count(*) AS "rows" FROM feed GROUP BY delivery',
    "rule_non_negative_number": _rule(non_negative_number("amount")),
    "rule_is_number": f"""WITH {CUSTOMERS}
        SELECT customer_id, regexp_matches(balance, '^[0-9]+(\\.[0-9]+)?\\z') AS flag FROM customers""",
    "rule_no_digits": _rule(no_digits("priority")),
    "rule_iso_date": _rule(iso_date("order_dt")),
    "rule_email": _rule(email("email")),
    "rule_exact_length": _rule(exact_length("cust_code", 16)),
    "rule_signed_number": f"""WITH {FEED}
        SELECT order_id, {signed_number("amount")} AS is_number,
               coalesce(try_cast(amount AS DOUBLE) >= 0, false) AS is_non_negative
        FROM feed""",
    "rule_skip_and_missing": f"""WITH {FEED}
        SELECT order_id, {PASSED["amount"]} AND {PASSED["order_dt"]} AS valid FROM feed""",
    "clean_good": f"WITH {FEED} SELECT 7 AS ID_PER, {TYPED}, {DINS} FROM feed WHERE {VALID}",
    "clean_rejects": f"WITH {FEED} SELECT 7 AS ID_PER, {TEXT}, {DINS} FROM feed WHERE NOT ({VALID})",
    "skipped_conversion": f"""WITH {FEED}
        SELECT 7 AS IDRUN, order_id, try_cast(amount AS DOUBLE) AS amount,
               CASE WHEN {PASSED["order_dt"]} THEN try_cast(order_dt AS DATE) END AS order_dt,
               cust_code, email, priority, {DINS}
        FROM feed WHERE {PASSED["cust_code"]}""",
    "feed_from_files": f"WITH {FEED} SELECT delivery AS ID_PER, {TYPED}, {DINS} FROM feed WHERE {VALID}",
    "feed_rejects_from_files": f"WITH {FEED} SELECT delivery AS ID_PER, {TEXT}, {DINS} FROM feed WHERE NOT ({VALID})",
    "metrics": _metrics("", "", '"rows"'),
    "metrics_by_period": _metrics("delivery AS ID_PER, ", "GROUP BY delivery", "rows_ok"),
    "target_projection": f"""WITH {FEED}
        SELECT 7 AS ID_PER, order_id AS COD_ORD, CAST(amount AS DOUBLE) AS amount FROM feed WHERE {VALID}""",
    "filter_equals": f"""WITH {FEED}
        SELECT 7 AS ID_PER, {TYPED}, {DINS} FROM feed WHERE {VALID} AND priority = 'LOW'""",
    "partition_replace": f"""WITH {FEED}, {_CORRECTED}
        {_FIRST} AND delivery = 202501
        UNION ALL SELECT delivery AS ID_PER, {TYPED} FROM corrected WHERE {VALID} AND delivery = 202502""",
    "partition_empty": f"WITH {FEED} {_FIRST} AND delivery = 202501",
    "rejects_published": f"WITH {FEED} SELECT delivery AS ID_PER, {TEXT} FROM feed WHERE NOT ({VALID})",
    "union_feeds": f"""WITH {FEED}, {CUSTOMERS}
        SELECT 'orders' AS feed, {TEXT}, NULL AS customer_id, NULL AS name, NULL AS balance FROM feed
        UNION ALL
        SELECT 'customers', NULL, NULL, NULL, NULL, email, NULL, customer_id, name, balance FROM customers""",
    "multi_rule_column": f"""WITH {FEED}
        SELECT order_id, {signed_number("amount")} AND coalesce(try_cast(amount AS DOUBLE) >= 0, false)
               AND {PASSED["cust_code"]} AND {non_negative_number("cust_code")} AS valid
        FROM feed""",
    "foreign_key_split": f"WITH {FEED} SELECT order_id, {_KNOWN_CUSTOMER} AS valid FROM feed",
    "foreign_key_clean": f"""WITH {FEED}
        SELECT 7 AS ID_PER, {TYPED}, {DINS} FROM feed WHERE {VALID} AND {_KNOWN_CUSTOMER}""",
    "foreign_key_few_missing": """
        SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer,
               o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 7) AS valid
        FROM orders""",
    "foreign_key_shuffled": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_suppkey AS VARCHAR) END AS supplier,
               l_linenumber <> 7 AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12) AS valid
        FROM lineitem""",
    "partition_many": """
        SELECT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS ID_PER, o_orderkey, o_custkey FROM orders""",
    "partition_layouts": f"""WITH {FEED}
        SELECT delivery AS ID_PER, {TEXT.removesuffix(", priority")},
               CASE WHEN delivery = 202502 THEN priority END AS priority
        FROM feed""",
    "foreign_key_long_hot": """
        SELECT l_orderkey, l_linenumber,
               l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12) AS valid
        FROM lineitem""",
    "foreign_key_several": """
        SELECT l_orderkey, l_linenumber,
               l_partkey IN (SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0) AS part_ok,
               l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12) AS supplier_ok,
               l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') AS order_ok
        FROM lineitem""",
}
