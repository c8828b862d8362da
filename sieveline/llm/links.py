"""Joins without hot groups, connected components, and links from shared keys.

A key may hold a third of all rows. Keys are therefore counted in a pre-aggregated
pass; those over a thousandth of the rows are under a thousand, whatever the data, and
are looked up by broadcast, while the others take an ordinary join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions.predicates import quoted
from sieveline.llm.common import map_batches
from sieveline.shared import written

#: Rows up to which a list of fixed-size rows is broadcast. Beyond, it is joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Bytes of the members of a key that meet each other at once, and block pairs of a batch.
BLOCK_BYTES = 1 << 16
BLOCK_PAIRS = 64
#: Members that are compared with others at once, as pairs.
MEETINGS = 1 << 18
#: Pairs that a task holds before it gives any of them out.
HELD_PAIRS = 1 << 17
#: Bytes of a set's bitmap: half a byte for each of its elements, and up to twice that, between
#: these two. A bitmap travels with every key of its node, so that of a long set is narrow,
#: and rules out less.
LEAST_BITS, MOST_BITS = 32, 128


def lookup(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with the other columns of ``table``, null where it lacks the key.

    ``table`` has each ``key`` once, with ``n``, the rows that have it (or more), and is
    stored or cheap; ``total`` is at least the sum of all ``n``. ``n`` is not added. A
    table that can only be short, because ``total`` is, is broadcast.
    """
    if total <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table.drop("n")), key, "left").select(*map(quoted, rows.columns), *[c for c in table.columns if c not in (key, "n")])
    values = [c for c in table.columns if c not in (key, "n")]
    often = F.col("n") > max(1000, total // 1000)
    hot = table.where(often).select(F.col(key).alias("__hot"), *[F.col(v).alias(f"__hot_{v}") for v in values])
    cold = table.where(~often).select(F.col(key).alias("__key"), F.xxhash64(key).alias("__hash"), *[F.col(v).alias(f"__cold_{v}") for v in values])
    marked = rows.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    # Decided rows and rows without a key travel spread by their own hash.
    settled = F.col("__hot").isNotNull() | F.col(key).isNull()
    spread = marked.withColumns(
        {
            "__own": F.when(~settled, F.col(key)),
            "__spread": F.when(settled, F.xxhash64(*[quoted(c) for c in rows.columns])).otherwise(F.xxhash64(key)),
        }
    )
    joined = spread.join(cold, (F.col("__own") == F.col("__key")) & (F.col("__spread") == F.col("__hash")), "left")
    added = [F.when(F.col("__hot").isNotNull(), F.col(f"__hot_{v}")).otherwise(F.col(f"__cold_{v}")).alias(v) for v in values]
    return joined.select(*map(quoted, rows.columns), *added)


def checked_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """A list of ``rows`` fixed-size rows, broadcast if they are few enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("merge")


def with_listed(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """The rows whose key the table has, with its other columns. A short table is
    broadcast, so that rows stay in place; else it is ``lookup`` without the rows that
    have no match."""
    if (count := table.count()) <= BROADCAST_ROWS:
        return rows.join(checked_broadcast(table.drop("n"), count), key)
    listed = lookup(rows, table.withColumn("__listed", F.col(key).isNotNull()), key, total)
    return listed.where("__listed").drop("__listed")


def connected(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges (a, b)``: the smallest node they
    reach. Rounds of large and small stars until the edges are stars; the edges after
    each round are stored, which cuts the lineage.
    """
    stars = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    stars = written(stars, "edges")
    before = _digest(stars)
    while before[0]:
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        least = least.withColumn("m", F.least("a", "m"))
        large = lookup(both, least, "a", 2 * before[0]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        joined = lookup(large, least, "a", 2 * before[0])
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", "m")).where("a != b").distinct()
        stars = written(small, "edges")
        after = _digest(stars)
        if after == before:
            break
        before = after
    leaves = stars.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    centers = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return written(leaves.union(centers), "components")


def _digest(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and a sum of their hashes, which tells two sets of edges apart."""
    n, total = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return n, int(total or 0)


def best_anchors(sketches: DataFrame, possible: Callable[[Column, Column], Column]) -> DataFrame:
    """``(a, b)``: for each node ``b`` that shares a key with another one node ``a``, of
    those that its keys, which others have too, name the one named most often. A key names the node that shares
    most of its own keys: in a group of near copies, what they are copies of."""
    near, shared = sketches, sketches.count()
    counts = written(near.groupBy("node").agg(F.count("*").alias("n")).withColumn("shared", F.col("n")), "counts")
    ranked = with_listed(near, counts, "node", shared)
    named = F.max(F.struct("shared", (-F.col("node")).alias("first"), "size"))
    anchors = written(ranked.groupBy("key").agg(named.alias("named"), F.count("*").alias("n")), "anchors")
    met = with_listed(near, anchors, "key", shared).select(
        "node", "size", (-F.col("named.first")).alias("a"), F.col("named.size").alias("size_a"), "named.shared"
    )
    met = met.where((F.col("a") != F.col("node")) & possible(F.col("size_a"), F.col("size")))
    often = met.groupBy("node", "a", "shared").agg(F.count("*").alias("times"))
    best = often.groupBy("node").agg(F.max(F.struct("times", "shared", (-F.col("a")).alias("first"))).alias("best"))
    return best.select((-F.col("best.first")).alias("a"), F.col("node").alias("b"))


def linked(
    postings: DataFrame,
    sketches: DataFrame | None,
    bitmaps: Callable[[DataFrame], DataFrame],
    verify: Callable[[DataFrame], DataFrame],
    percent: int,
) -> DataFrame:
    """Components ``(node, component)`` of the verified links between nodes that share
    a key. ``postings`` has ``key``, ``node`` (a number), the ``size`` of its set and the
    ``place`` of the key in it (0 if it is in no order); ``sketches`` the same without places,
    None if they are the postings; ``bitmaps`` gives the ``bitmap`` of each ``node`` of a frame. A
    link shares ``percent`` of the union of two sets.

    First each node is paired with one other, by the few keys of its sketch (see
    ``best_anchors``), which joins most of a large group without its pairs. Then, by
    their postings, only nodes of one key that are still apart are compared, all of them,
    in blocks: lengths, places and bitmaps rule out whatever cannot be a link before it
    becomes a row, so no link that would join two components is missed. Two components that
    are linked in many places, or many that are one, are joined by their nearest pairs first. ``verify`` takes
    distinct pairs ``(a, b)`` and keeps the links.
    """
    alike = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)
    few = written(shared_keys(postings if sketches is None else sketches), "sketches")
    first = written(verify(written(best_anchors(few.select("key", "node", "size"), alike), "pairs")), "links")
    components = connected(first)

    several = few if sketches is None else postings
    links = first
    # First only the nearest pairs that join what meets in a task, which joins most of
    # those that are one; then, with what is still apart, all pairs.
    for nearest in (True, False):
        pairs = _apart_pairs(several, components, bitmaps, percent, nearest)
        more = written(verify(pairs), "links")
        if not more.isEmpty():
            links = links.union(more)
            components = connected(links)
    return components


def _apart_pairs(
    postings: DataFrame, components: DataFrame, bitmaps: Callable[[DataFrame], DataFrame], percent: int, nearest: bool
) -> DataFrame:
    """The pairs ``(a, b)`` of nodes that share a key, are in different components and
    can be links; with ``nearest`` the nearest ones that join the components that meet in a task."""
    joined = checked_broadcast(components, components.count())
    members = postings.join(joined, "node", "left").select("key", "node", "size", "place", F.coalesce("component", "node").alias("component"))
    bytes_of = F.lit(32) + bitmap_bytes(F.col("size"))
    mixed = members.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"), F.sum(bytes_of).alias("bytes")
    )
    mixed = written(mixed.where("lo != hi").select("key", "n", F.ceil(F.col("bytes") / BLOCK_BYTES).alias("parts")), "mixed")
    apart = with_listed(members, mixed, "key", mixed.agg(F.sum("n")).first()[0] or 0)
    apart = written(apart, "apart")
    apart = apart.join(bitmaps(apart.select("node").distinct()), "node")
    block = F.pmod(F.xxhash64("node"), F.col("parts"))
    member = F.struct("node", "component", "size", "place", "bitmap")
    blocks = apart.groupBy("key", "parts", block.alias("block")).agg(
        F.collect_list(member).alias("members"), F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    blocks = written(blocks, "blocks")
    # A block meets itself where it lies; each pair of blocks meets by itself, so that no task
    # gets all blocks of a key. Most keys have one block, and none of it travels again.
    itself = blocks.where("lo < hi").select("key", F.col("block").alias("x_block"), F.col("block").alias("y_block"), F.col("members").alias("left"), F.slice("members", 1, 0).alias("right"))
    several = blocks.where("parts > 1")
    left = several.where("block < parts - 1").select("key", F.col("block").alias("x_block"), F.explode(F.sequence(F.col("block") + 1, F.col("parts") - 1)).alias("y_block"), F.col("members").alias("left"), "lo", "hi")
    right = several.where("block > 0").select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("block") - 1)).alias("x_block"), F.col("block").alias("y_block"), F.col("members").alias("right"), F.col("lo").alias("y_lo"), F.col("hi").alias("y_hi"))
    met = left.join(right, ["key", "x_block", "y_block"]).where("least(lo, y_lo) < greatest(hi, y_hi)")
    met = itself.unionByName(met.select(itself.columns))
    return _few_at_once(components.sparkSession, lambda: written(survivors(met, percent, nearest).distinct(), "pairs"))


def _few_at_once(spark: SparkSession, job: Callable[[], DataFrame]) -> DataFrame:
    """Run a job whose Arrow batches hold few block pairs, whatever the session's batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BLOCK_PAIRS))
    try:
        return job()
    finally:
        spark.conf.set(name, before)


def shared_keys(postings: DataFrame) -> DataFrame:
    """The postings whose key another one has."""
    grouped = written(postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "keys")
    return with_listed(postings, grouped, "key", grouped.agg(F.sum("n")).first()[0] or 0)


def bitmap_bytes(size: Column) -> Column:
    """Bytes of the bitmap of a set, by its size."""
    power = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(size, F.lit(1)).cast("double") / 2)))
    return F.least(F.greatest(power, F.lit(float(LEAST_BITS))), F.lit(float(MOST_BITS))).cast("int")


def bitmap_width(size: int) -> int:
    width = LEAST_BITS
    while width < MOST_BITS and 2 * width < size:
        width *= 2
    return width


def bitmap(sets: np.ndarray) -> bytes:
    """The parities of how many of a set's 64-bit hashes fall on each bit. Two sets differ in
    at least as many elements as their bitmaps in bits."""
    width = bitmap_width(len(sets))
    places = (sets >> np.uint64(64 - (8 * width).bit_length() + 1)).astype(np.int64)
    odd = np.bincount(places, minlength=8 * width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows of bytes) as those of a smaller width: neighbouring bits fall together."""
    while bits.shape[1] > width:
        wide = np.unpackbits(bits, axis=1)
        bits = np.packbits(wide[:, ::2] ^ wide[:, 1::2], axis=1)
    return bits


class Members:
    """The members of a batch's blocks behind each other, as arrays; block ``r`` begins at
    ``begin[r]`` and has ``count[r]`` of them."""

    def __init__(self, blocks: pa.ListArray):
        values = blocks.flatten()
        self.count = blocks.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.begin = np.cumsum(self.count) - self.count
        self.node, self.component, self.size, self.place = (
            values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("node", "component", "size", "place")
        )
        bits = values.field("bitmap").cast(pa.large_binary())
        _, ends, raw = bits.buffers()
        ends = np.frombuffer(ends, np.int64, len(bits) + 1, 8 * bits.offset) if len(bits) else np.zeros(1, np.int64)
        self.at, self.width = ends[:-1], np.diff(ends)
        self.raw = np.frombuffer(raw, np.uint8) if raw else np.empty(0, np.uint8)
        self.made: dict[int, np.ndarray] = {}

    def bits(self, width: int) -> np.ndarray:
        """The bitmaps in a width, as words; zeros for those that are narrower."""
        if width not in self.made:
            rows = np.zeros((len(self.width), width), np.uint8)
            for own in np.unique(self.width[self.width >= width]).tolist():
                some = np.flatnonzero(self.width == own)
                rows[some] = folded(self.raw[self.at[some][:, None] + np.arange(own)], width)
            self.made[width] = rows.view(np.uint64)
        return self.made[width]


def meetings(x: Members, y: Members, rows: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, i, j)``: every two members of the blocks of each of some rows, those of a
    block with itself once, and few at a time."""
    block = np.repeat(rows, x.count[rows])
    i = np.arange(len(block)) + np.repeat(x.begin[rows] - (np.cumsum(x.count[rows]) - x.count[rows]), x.count[rows])
    first = i + 1 if same else y.begin[block]
    many = y.begin[block] + y.count[block] - first
    ends = np.cumsum(many)
    at = 0
    while at < len(i):
        until = max(at + 1, int(np.searchsorted(ends, ends[at] - many[at] + MEETINGS, "right")))
        some = slice(at, until)
        shift = first[some] - (ends[some] - many[some] - (ends[at] - many[at]))
        j = np.repeat(shift, many[some])
        j += np.arange(len(j))
        yield np.repeat(block[some], many[some]), np.repeat(i[some], many[some]), j
        at = until


def possible_pairs(x: Members, y: Members, rows: np.ndarray, same: bool, percent: int) -> tuple[np.ndarray, ...]:
    """``(row, i, j, far)``: which members can be linked: of different components, by their
    sizes, by what is left of their sets behind the key, and by the bits in which their
    bitmaps differ; with the share of bits that differ."""
    found: list[tuple[np.ndarray, ...]] = []
    for row, i, j in meetings(x, y, rows, same):
        apart = x.component[i] != y.component[j]
        row, i, j = row[apart], i[apart], j[apart]
        a, b = x.size[i], y.size[j]
        both = a + b
        left = np.minimum(a - x.place[i], b - y.place[j])
        mask = (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & ((100 + percent) * left >= percent * both)
        row, i, j, both = row[mask], i[mask], j[mask], both[mask]
        widths = np.minimum(x.width[i], y.width[j])
        differ = np.zeros(len(i), np.int64)
        for width in np.unique(widths).tolist():
            some = np.flatnonzero(widths == width)
            for at in range(0, len(some), 1 + (1 << 22) // width):
                part = some[at : at + 1 + (1 << 22) // width]
                differ[part] = np.bitwise_count(x.bits(width)[i[part]] ^ y.bits(width)[j[part]]).sum(axis=1, dtype=np.int64)
        near = (100 + percent) * differ <= (100 - percent) * both
        found.append((row[near], i[near], j[near], differ[near] / both[near]))
    if not found:
        return *(np.empty(0, np.int64) for _ in range(3)), np.empty(0)
    return tuple(np.concatenate(c) for c in zip(*found))


def nearest_pairs(x: Members, y: Members, row: np.ndarray, i: np.ndarray, j: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Which pairs differ least of those of two components that meet in a row, one for each."""
    a, b = x.component[i], y.component[j]
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((j, i, far, hi, lo, row))
    changed = [np.diff(c[order]) != 0 for c in (row, lo, hi)]
    return order[np.concatenate(([True], changed[0] | changed[1] | changed[2]))[: len(order)]]


def nearest_forest(pairs: list[np.ndarray]) -> list[np.ndarray]:
    """Of pairs ``[a, b, component of a, component of b, far]`` those that differ least and
    join all components that they can join: one fewer than there are, whatever the pairs."""
    a, b, of_a, of_b, far = pairs
    order = np.lexsort((b, a, far))
    above: dict[int, int] = {}
    kept = []

    def top(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    for k, x, y in zip(order.tolist(), of_a[order].tolist(), of_b[order].tolist()):
        x, y = top(x), top(y)
        if x != y:
            above[y] = x
            kept.append(k)
    return [c[kept] for c in pairs]


def distinct_pairs(pairs: list[np.ndarray]) -> list[np.ndarray]:
    order = np.lexsort(pairs[1::-1])
    a, b = pairs[0][order], pairs[1][order]
    first = order[np.concatenate(([True], (np.diff(a) != 0) | (np.diff(b) != 0)))[: len(order)]]
    return [c[first] for c in pairs]


def survivors(met: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """``(a, b)``, a below b: the pairs of members of two blocks that can be links; with
    ``nearest`` only as many of a task's pairs as join its components. Where a
    block meets itself, ``left`` has it. The blocks of a batch are compared at once."""
    fewer = nearest_forest if nearest else distinct_pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def condense() -> None:
            held[:] = [fewer([np.concatenate(c) for c in zip(*held)])] if held else []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in held.pop()[:2]], ["a", "b"])

        for batch in batches:
            same = batch.column("same").to_numpy(zero_copy_only=False).astype(bool)
            x, y = (Members(batch.column(c)) for c in ("left", "right"))
            for other, rows in ((x, np.flatnonzero(same)), (y, np.flatnonzero(~same))):
                row, i, j, far = possible_pairs(x, other, rows, other is x, percent)
                if nearest:
                    some = nearest_pairs(x, other, row, i, j, far)
                    i, j, far = i[some], j[some], far[some]
                a, b = x.node[i], other.node[j]
                held.append([np.minimum(a, b), np.maximum(a, b), x.component[i], other.component[j], far])
            if sum(len(h[0]) for h in held) >= HELD_PAIRS:
                condense()
                if len(held[0][0]) > HELD_PAIRS // 2:
                    yield made()
        condense()
        if held:
            yield made()

    return map_batches(met.select((F.col("x_block") == F.col("y_block")).alias("same"), "left", "right"), run, "a bigint, b bigint")
