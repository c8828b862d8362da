"""Foreign keys: does a feed value exist among a parent's keys?

The rows are never multiplied: parent keys are made distinct first. All keys of a rule
set are measured together on the feed as it came, then looked up one after the other.
The way of each lookup follows measured sizes, against one bound for all lists that are
broadcast:

* Small parent: its keys are broadcast. The feed is not shuffled.
* Otherwise the distinct values of the feed are judged against the keys, which
  moves the keys' columns, pre-aggregated, and no rows. If the values the parent lacks
  are few (clean feeds), or else those it has, that list is broadcast instead. The feed
  is still not shuffled.
* Only if both lists are large are feed and keys shuffled on the key. Values with more
  than ``hot_rows`` rows, and at least a thousandth of the feed (so fewer than a
  thousand values), must not meet in one task: the list of their 8-byte hashes is
  broadcast, their rows are dealt out to buckets, and each of the parent's keys with a
  listed hash is there once per bucket. Rows with NULL are dealt out as well. The join
  compares whole values, so a hash that two values share only spreads one of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.predicates import quoted
from sieveline.shared import shared_root, written

BROADCAST_BYTES = 64 * 1024 * 1024
# What a broadcast row costs in the hash table besides its text.
ROW_OVERHEAD = 64
HOT_ROWS = 1_000_000
# A value is hot if it has at least one row in so many.
HOT_SHARE = 1000
# Buckets of hot rows for each shuffle partition, so that hashing fills them evenly.
BUCKETS_PER_PARTITION = 8
# A partition of the list of found values up to this size is hashed, not sorted.
HASHED_BYTES = 32 * 1024 * 1024


class ForeignKey(NamedTuple):
    column: str
    parent: DataFrame
    parent_column: str
    flag: str


class Lookup(NamedTuple):
    """How a key is looked up: a list to broadcast and what being in it means, or the
    judged values to join by shuffle."""

    key: ForeignKey
    listed: DataFrame | None = None
    listed_means: bool = True
    values: DataFrame | None = None
    hot_rows: int = 0
    found_bytes: int = 0


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column is called so."""
    lowered = {c.lower() for c in taken}
    while wanted.lower() in lowered:
        wanted = "_" + wanted
    return wanted


def as_text(column: str) -> Column:
    """Both sides are compared as text; feed columns already are."""
    return quoted(column).cast("string")


def parent_keys(parent: DataFrame, column: str) -> DataFrame:
    """Non-NULL keys of a parent table as text, one column ``key``."""
    return parent.select(as_text(column).alias("key")).where(F.col("key").isNotNull())


def broadcast_cost() -> Column:
    """Upper bound of the memory a broadcast ``key`` needs."""
    return F.octet_length("key") + F.lit(ROW_OVERHEAD)


def with_foreign_key(
    df: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    flag: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``df`` plus the boolean column ``flag``; NULL values are False."""
    keys = [ForeignKey(column, parent, parent_column, flag)]
    return with_foreign_keys(df, keys, broadcast_bytes=broadcast_bytes, hot_rows=hot_rows)


def with_foreign_keys(
    df: DataFrame, keys: Sequence[ForeignKey], *, broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``df`` plus a boolean column for each key; NULL values are False.

    Starts the jobs that measure: one or two over the parents' keys, and if they are
    not few, one over the values of the feed's columns. ``broadcast_bytes`` is the bound
    of all broadcast lists together.
    """
    for key in keys:
        if key.flag in df.columns:
            raise ValueError(f"column {key.flag!r} already exists")
    for lookup in measure(df, keys, broadcast_bytes, hot_rows):
        df = apply_lookup(df, lookup)
    return df


def measure(df: DataFrame, keys: Sequence[ForeignKey], broadcast_bytes: int, hot_rows: int) -> list[Lookup]:
    """The lookup of each key. Nothing here reads a frame that was joined before."""
    left = broadcast_bytes
    found: dict[int, Lookup] = {}
    sets = {i: parent_keys(k.parent, k.parent_column) for i, k in enumerate(keys)}
    # Repeated keys count in the first measure; only what is then too large is made distinct.
    for distinct in (False, True):
        open_sets = {i: s.distinct() if distinct else s for i, s in sets.items() if i not in found}
        sizes = _sizes(open_sets) if open_sets else {}
        for i in sorted(sizes, key=sizes.get):
            if sizes[i] <= left:
                left -= sizes[i]
                found[i] = Lookup(keys[i], sets[i].distinct())
    rest = [i for i in range(len(keys)) if i not in found]
    if rest:
        judged = judged_values(df, {i: keys[i].column for i in rest}, {i: sets[i] for i in rest})
        cost, known = broadcast_cost(), F.col("found")
        sums = judged.groupBy("rule").agg(
            F.coalesce(F.sum(F.when(~known, cost)), F.lit(0)).alias("missing"),
            F.coalesce(F.sum(F.when(known, cost)), F.lit(0)).alias("found"),
            F.sum("rows").alias("rows"),
        )
        measured = {r["rule"]: r for r in sums.collect()}
        for i in rest:
            mine = judged.where(F.col("rule") == i)
            sums_i = measured.get(i)
            missing, has, rows = (sums_i["missing"], sums_i["found"], sums_i["rows"]) if sums_i else (0, 0, 0)
            if min(missing, has) <= left:
                by_missing = missing <= left
                left -= missing if by_missing else has
                found[i] = Lookup(keys[i], mine.where(~known if by_missing else known).select("key"), not by_missing)
            else:
                found[i] = Lookup(keys[i], None, True, mine, max(hot_rows, -(-rows // HOT_SHARE)), has)
    return [found[i] for i in range(len(keys))]


def _sizes(sets: dict[int, DataFrame]) -> dict[int, int]:
    """Memory that each set needs when broadcast: one job, one row of sums per task."""
    tagged = [s.select(F.lit(i).alias("rule"), broadcast_cost().alias("cost")) for i, s in sets.items()]
    rows = reduce(DataFrame.unionAll, tagged).groupBy("rule").agg(F.sum("cost").alias("cost")).collect()
    return {i: 0 for i in sets} | {r["rule"]: r["cost"] for r in rows}


def judged_values(df: DataFrame, columns: dict[int, str], sets: dict[int, DataFrame]) -> DataFrame:
    """Each distinct value of the feed's columns: number of the ``rule``, ``key``, its
    ``rows``, and whether it was ``found`` among the rule's keys. One scan of the feed,
    one join.

    Counting combines on the map side, so a hot value is one row per task. The
    result is used more than once; where a shared folder is named it is stored there,
    elsewhere it is computed again.
    """
    pairs = [F.struct(F.lit(i).alias("rule"), as_text(c).alias("key")) for i, c in columns.items()]
    values = df.select(F.explode(F.array(*pairs)).alias("pair")) if len(pairs) > 1 else df.select(pairs[0].alias("pair"))
    values = values.where("pair.key IS NOT NULL").groupBy("pair.rule", "pair.key").agg(F.count("*").alias("rows"))
    tagged = [s.select(F.lit(i).alias("rule"), "key") for i, s in sets.items()]
    known = reduce(DataFrame.unionAll, tagged).distinct().withColumn("known", F.lit(True))
    judged = values.join(known, ["rule", "key"], "left").select("rule", "key", "rows", F.col("known").isNotNull().alias("found"))
    return written(judged, "judged") if has_shared_folder(df) else judged


def has_shared_folder(df: DataFrame) -> bool:
    return bool(shared_root(df.sparkSession))


def apply_lookup(df: DataFrame, lookup: Lookup) -> DataFrame:
    if lookup.listed is not None:
        return _broadcast_lookup(df, lookup.key.column, lookup.listed, lookup.key.flag, lookup.listed_means)
    return _shuffled_lookup(df, lookup)


def _broadcast_lookup(df: DataFrame, column: str, listed: DataFrame, flag: str, listed_means: bool) -> DataFrame:
    """Flag by a list of distinct values that are all found, or all missing."""
    key, mark = (free_name(df.columns, n) for n in ("__key", "__listed"))
    small = F.broadcast(listed.select(F.col("key").alias(key), F.lit(True).alias(mark)))
    value, is_listed = as_text(column), quoted(mark).isNotNull()
    return df.join(small, value == quoted(key), "left").select(
        *map(quoted, df.columns), (is_listed if listed_means else value.isNotNull() & ~is_listed).alias(flag)
    )


def hot_hashes(values: DataFrame, hot_rows: int) -> DataFrame:
    """8-byte hashes of the judged values with more than ``hot_rows`` rows."""
    return values.where(F.col("rows") > hot_rows).select(F.xxhash64("key").alias("hash")).distinct()


def _shuffled_lookup(df: DataFrame, lookup: Lookup) -> DataFrame:
    names = ("__hot", "__value", "__bucket", "__key", "__key_bucket", "__found")
    hot_hash, held, bucket, key, key_bucket, found = (free_name(df.columns, n) for n in names)
    columns, value = list(map(quoted, df.columns)), as_text(lookup.key.column)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS_PER_PARTITION * partitions
    hot = hot_hashes(lookup.values, lookup.hot_rows)

    listed = F.broadcast(hot.select(F.col("hash").alias(hot_hash)))
    marked = df.join(listed, F.when(value.isNotNull(), F.xxhash64(value)) == quoted(hot_hash), "left")
    # Dealt out by the row's content and input partition: unlike a random number, that
    # is the same when a lost task runs again.
    dealt = F.pmod(F.xxhash64(*columns, F.spark_partition_id()), F.lit(buckets)).cast("int")
    spread = marked.select(
        *columns, value.alias(held), F.when(quoted(hot_hash).isNotNull() | value.isNull(), dealt).otherwise(0).alias(bucket)
    )
    known = lookup.values.where("found").select(F.col("key").alias(key))
    known = known.join(F.broadcast(hot), F.xxhash64(quoted(key)) == F.col("hash"), "left")
    everywhere = F.sequence(F.lit(0), F.lit(buckets - 1))
    known = known.select(
        key, F.explode(F.when(F.col("hash").isNotNull(), everywhere).otherwise(F.array(F.lit(0)))).alias(key_bucket), F.lit(True).alias(found)
    )
    # Measured as too large to broadcast, whatever the statistics say. What a task gets
    # of the list is known too: it is hashed if that is little, else both are sorted.
    hint = "shuffle_hash" if lookup.found_bytes <= HASHED_BYTES * partitions else "merge"
    matches = (quoted(held) == quoted(key)) & (quoted(bucket) == quoted(key_bucket))
    return spread.join(known.hint(hint), matches, "left").select(
        *columns, F.coalesce(quoted(found), F.lit(False)).alias(lookup.key.flag)
    )
