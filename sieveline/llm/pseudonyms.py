"""Format-preserving pseudonyms for personal data in texts.

Numbers and dates that are valid (a card's check digit, an address's octets, a date of
the calendar) are permuted by a keyed Feistel network within their format; equal values
become equal ones in every document, and different numbers and dates different ones. Letters
of mail addresses and secrets get keyed digests of the same length (no permutation), and
the domain of an address stays. Everything is a column
expression; rows are not shuffled, and texts without a digit or ``@`` are not searched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import keyed_texts

ROUNDS = 10
# The days of 400 years (they repeat), as a product for the two halves.
FIRST_DAY, DAYS_LEFT, DAYS_RIGHT = "1800-01-01", 189, 773
# The same for the days from the 13th of a month on.
FIRST_YEAR, MONTHS, LATE_LEFT, LATE_RIGHT = 1800, 4800, 9, 9833
DATE_FORMATS = {"iso": "yyyy-MM-dd", "dots": "dd.MM.yyyy", "slashes": "dd/MM/yyyy", "american": "MM/dd/yyyy"}

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+"
ADDRESS = r"(?<![\p{L}\p{N}.])(?:\d{1,3}\.){3}\d{1,3}(?![\p{L}\p{N}]|\.\d)"
DATE = r"(?<![\p{L}\p{N}./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\p{L}\p{N}]|[./-]\d)"
PHONE = r"(?<![\p{L}\p{N}])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\p{L}\p{N}]|[.-]\d)"
SOCIAL = r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)"
CARD = r"(?<![\p{L}\p{N}.-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,4}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5})(?![\p{L}\p{N}]|[.-]\d)"
SECRET = r"(?<![\p{L}\p{N}])(?=[a-f]*\d)(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})(?![\p{L}\p{N}])"
ANY = "|".join(f"(?:{p})" for p in (EMAIL, ADDRESS, DATE, PHONE, SOCIAL, SECRET, CARD))
KINDS = ("email", "address", "date", "phone", "social", "secret", "card")


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda variable."""
    return F.transform(F.array(value), use)[0]


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of the pairs below the two sizes, as a struct ``(l, r)``.
    Each round adds a digest of one half to the other, modulo its size."""

    def digest(half: Column, i: Column) -> Column:
        text = F.concat_ws("|", F.lit(key), tweak, i.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")

    def one(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        l = F.when(even, F.pmod(state.l + F.pmod(digest(state.r, i), left_size), left_size)).otherwise(state.l)
        r = F.when(even, state.r).otherwise(F.pmod(state.r + F.pmod(digest(state.l, i), right_size), right_size))
        return F.struct(l.alias("l"), r.alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one)


def permute_digits(digits: Column, key: str, tweak: str) -> Column:
    """Digits to as many other digits, 2 to 36 of them in halves of at most 18."""

    def of(d: Column) -> Column:
        n = F.length(d)
        u = F.floor(n / 2).cast("int")
        size = lambda k: F.rpad(F.lit("1"), k + 1, F.lit("0")).cast("long")
        state = feistel(
            F.substring(d, F.lit(1), u), F.substring(d, u + 1, n), size(u), size(n - u), key, F.concat(F.lit(tweak), n.cast("string"))
        )
        return _bind(state, lambda s: F.concat(F.lpad(s.l.cast("string"), u, "0"), F.lpad(s.r.cast("string"), n - u, "0")))

    return F.when(F.length(digits) < 2, digits).otherwise(_bind(digits, of))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(mask: Column, digits: Column) -> Column:
    """The mask with its digits replaced, in order."""

    def char(c: Column, i: Column) -> Column:
        place = F.length(_digits(F.substring(mask, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9]"), F.substring(digits, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(mask, ""), char), "")


def _luhn_sum(digits: Column) -> Column:
    """Check sum of digits whose last one counts once, the one before twice, and so on."""

    def add(total: Column, x: Column) -> Column:
        return total + x

    def weight(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = (F.length(digits) - i) % 2 == 0
        return F.when(~twice, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(F.split(digits, ""), weight), F.lit(0), add)


def card(text: Column, key: str) -> Column:
    """Another valid number with the first digit and the separators of this one; null
    if its check digit is wrong."""

    def of(d: Column) -> Column:
        inner = permute_digits(F.substring(d, F.lit(2), F.length(d) - 2), key, "card")
        fresh = F.concat(F.substring(d, 1, 1), inner)
        check = (10 - _luhn_sum(F.concat(fresh, F.lit("0"))) % 10) % 10
        return F.when(_luhn_sum(d) % 10 == 0, _refill(text, F.concat(fresh, check.cast("string"))))

    return _bind(_digits(text), of)


def address(text: Column, key: str) -> Column:
    """Another address; null if an octet is over 255."""

    def of(o: Column) -> Column:
        state = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, F.lit("address"))
        octet = lambda h: F.concat_ws(".", F.floor(h / 256).cast("string"), (h % 256).cast("string"))
        return F.when(F.array_max(o) <= 255, _bind(state, lambda s: F.concat_ws(".", octet(s.l), octet(s.r))))

    return _bind(F.split(text, r"\.").cast("array<int>"), of)


def _month_start(month: Column) -> Column:
    """The first day of a month, counted from the first one."""
    return F.add_months(F.lit(FIRST_DAY).cast("date"), month.cast("int"))


def _late_before(month: Column) -> Column:
    """Late days (from the 13th on) before a month."""
    return F.datediff(_month_start(month), F.lit(FIRST_DAY).cast("date")) - 12 * month


def date(text: Column, key: str) -> Column:
    """Another date in the same format, between the years 1800 and 2199; null if it is
    none of these years or of the calendar.

    With slashes a date is read with the day first if it can be, so only late days (from
    the 13th on) are read with the month first; these are permuted among themselves, so
    that the result is read in the same way, and different dates stay different.
    """
    first = F.lit(FIRST_DAY).cast("date")

    def permuted(place: Column, left: int, right: int, tweak: str) -> Column:
        state = feistel(F.floor(place / right), place % right, F.lit(left), F.lit(right), key, F.lit(tweak))
        return _bind(state, lambda s: s.l * right + s.r)

    def of(written: str) -> Column:
        days = F.datediff(F.try_to_date(text, written), first)
        moved = F.date_add(first, permuted(days, DAYS_LEFT, DAYS_RIGHT, "date").cast("int"))
        return F.when(days.between(0, DAYS_LEFT * DAYS_RIGHT - 1), F.date_format(moved, written))

    def late() -> Column:
        written = DATE_FORMATS["american"]
        read = F.try_to_date(text, written)
        month = (F.year(read) - FIRST_YEAR) * 12 + F.month(read) - 1
        place = _late_before(month) + F.dayofmonth(read) - 13

        def made(moved: Column) -> Column:
            about = F.floor(moved * MONTHS / (LATE_LEFT * LATE_RIGHT)).cast("int")
            near = F.filter(F.sequence(F.greatest(about - 2, F.lit(0)), F.least(about + 2, F.lit(MONTHS - 1))), lambda m: _late_before(m) <= moved)
            day = _bind(F.array_max(near), lambda m: F.date_add(_month_start(m), (moved - _late_before(m) + 12).cast("int")))
            return F.date_format(day, written)

        known = F.year(read).between(FIRST_YEAR, FIRST_YEAR + 399) & (F.dayofmonth(read) > 12)
        return F.when(known, _bind(permuted(place, LATE_LEFT, LATE_RIGHT, "late"), made))

    return (
        F.when(text.rlike("^[0-9]{4}-"), of(DATE_FORMATS["iso"]))
        .when(text.contains("."), of(DATE_FORMATS["dots"]))
        .otherwise(F.coalesce(of(DATE_FORMATS["slashes"]), late()))
    )


def phone(text: Column, key: str) -> Column:
    """Another number with the same country code and separators; null below 7 or above
    15 digits."""
    code = F.regexp_extract(text, r"^\+[0-9]{1,3}(?=[^0-9])", 0)
    rest = F.substring(text, F.length(code) + 1, F.length(text))
    n = F.length(_digits(text))
    return F.when(n.between(7, 15), F.concat(code, _refill(rest, permute_digits(_digits(rest), key, "phone"))))


def _letters(text: Column, key: str, kind: str) -> Column:
    """A keyed digest of the same length in hexadecimal digits."""
    part = lambda i: F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lit(i), text), 256)
    return F.substring(F.concat(part("0"), part("1")), F.lit(1), F.length(text))


def kind_of(text: Column) -> Column:
    """Which of ``KINDS`` a match is."""
    whole = lambda p: text.rlike(f"^(?:{p})$")
    return (
        F.when(text.contains("@"), "email")
        .when(text.startswith("+"), "phone")
        .when(whole(r"(?:\d{1,3}\.){3}\d{1,3}"), "address")
        .when(whole(r"\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4}"), "date")
        .when(whole(r"\d{3}-\d{2}-\d{4}"), "social")
        .when(whole(r"[0-9a-f]*[a-f][0-9a-f]*|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}"), "secret")
        .otherwise("card")
    )


def pseudonym(text: Column, key: str) -> Column:
    """The replacement of a match, null if it is not valid and stays."""
    at = F.locate("@", text)
    kind = kind_of(text)
    return (
        F.when(kind == "email", F.concat(_letters(F.substring(text, F.lit(1), at - 1), key, "email"), F.substring(text, at, F.length(text))))
        .when(kind == "phone", phone(text, key))
        .when(kind == "address", address(text, key))
        .when(kind == "date", date(text, key))
        .when(kind == "social", _refill(text, permute_digits(_digits(text), key, "social")))
        .when(kind == "secret", _letters(text, key, "secret"))
        .otherwise(card(text, key))
    )


def replace(docs: DataFrame, key: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, text, n_replaced, kinds)``, one row for each row: the text with
    pseudonyms, how many there are, and of which kinds (sorted, distinct).

    Null texts stay null, with nothing replaced. What looks like a number or date but
    is not valid stays as it is. Other columns are left behind.
    """
    texts = keyed_texts(docs, id_column, text_column)
    nothing = F.array().cast("array<struct<old:string,new:string>>")
    fresh = F.transform(F.regexp_extract_all("text", F.lit(ANY), 0), lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("new")))
    found = texts.select(
        "doc_id", "text", F.when(F.col("text").rlike("[0-9@]"), fresh).otherwise(nothing).alias("found")
    )
    between = F.split("text", ANY, -1)
    joined = F.array_join(
        F.zip_with(between, "found", lambda piece, m: F.concat(piece, F.coalesce(m.new, m.old, F.lit("")))), ""
    )
    changed = F.filter("found", lambda m: m.new.isNotNull())
    return found.select(
        "doc_id",
        F.when(F.size("found") > 0, joined).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size(changed), F.lit(0)).cast("long").alias("n_replaced"),
        F.array_sort(F.array_distinct(F.transform(changed, lambda m: kind_of(m.old)))).alias("kinds"),
    )
