"""Fuzzy deduplication of lines by MinHash.

A line's set is its shingles of eight characters, A-Z in lower case and white space as one
space; a shorter line is its own shingle, so only equal lines are similar to it. Equal
lines are one class, at any length; blank lines are none and stay. Of each class a MinHash signature is cut into bands;
lines that share a band are compared by the exact Jaccard similarity of their sets, and
union-find over the similar ones (distributed, in rounds of stars) gives the components,
of which one line is kept: the first of the document with the smallest id. Shingles are
compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sieveline.functions.predicates import quoted
from sieveline.llm.common import keyed_texts, map_batches, text_hash
from sieveline.llm.links import bitmap, checked_broadcast, linked, lookup
from sieveline.shared import owned, written

#: Characters of a shingle; bytes of a line below which it is always kept: only blank ones.
SHINGLE = 8
MIN_BYTES = 1
#: Percent of the union that two lines share at least.
PERCENT = 80
#: Bands and rows of the signature. At the threshold itself a pair is found with
#: probability 1 - (1 - 0.8 ** ROWS) ** BANDS = 0.998, above it more often.
BANDS, ROWS = 12, 4
#: Bytes of lines whose shingles a task keeps while it compares pairs.
KEPT_BYTES = 1 << 22
#: Lines a task remembers to give each signature once; it forgets them all then.
SEEN = 300_000
PIECE = 1 << 20


def normalize(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def _functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(8)
    n = BANDS * ROWS
    return random.integers(0, 1 << 32, n, np.uint32), random.integers(0, 1 << 31, n, np.uint32) * np.uint32(2) + np.uint32(1)


def mixed_grams(points: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the shingles that begin at the first ``n`` characters."""
    grams = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        grams *= np.uint64(0x9E3779B97F4A7C15)
        grams += points[k : k + n]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    return grams ^ (grams >> np.uint64(32))


def points_of(line: bytes) -> np.ndarray:
    """The characters; a byte that is no UTF-8 counts as one."""
    if line.isascii():
        return np.frombuffer(line, np.uint8)
    return np.frombuffer(line.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)


def grams_of(line: bytes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a normalized line; a line shorter than
    one is one."""
    points = points_of(line)
    if len(points) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(line)], np.uint64)
    return np.unique(mixed_grams(points, len(points) - SHINGLE + 1))


def signatures(lines: list[bytes]) -> tuple[np.ndarray, list[int]]:
    """Lines x bands, a hash of each band's minima; the size of each line's set. For
    lines of ``SHINGLE`` characters or more."""
    parts = [points_of(x) for x in lines]
    lengths = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(lengths)
    points = np.concatenate([*parts, np.zeros(SHINGLE, np.uint8)])
    inside = np.ones(int(ends[-1]), bool)
    for k in range(1, SHINGLE):
        inside[ends - k] = False
    grams = mixed_grams(points, int(ends[-1]))[inside]
    hashes = (grams >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum(lengths - SHINGLE + 1)))
    flips, factors = _functions()
    keys = np.empty((len(lines), BANDS), np.uint64)
    work = np.empty_like(hashes)
    for band in range(BANDS):
        key = np.full(len(lines), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            np.bitwise_xor(hashes, flips[k], out=work)
            np.multiply(work, factors[k], out=work)
            key = (key ^ np.minimum.reduceat(work, starts[:-1])) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        keys[:, band] = key
    sizes = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        own = grams[a:b]
        own.sort()
        sizes.append(1 + int(np.count_nonzero(own[1:] != own[:-1])))
    return keys.view(np.int64), sizes


def similar(a: bytes, b: bytes, percent: int = PERCENT) -> bool:
    """Whether two normalized lines share ``percent`` of their shingles."""
    return overlap_at_least(grams_of(a), grams_of(b), percent)


def overlap_at_least(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether the intersection has ``percent`` of the union."""
    least = percent * (len(a) + len(b))
    if (100 + percent) * min(len(a), len(b)) < least:
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return bool((100 + percent) * np.count_nonzero(both[1:] == both[:-1]) >= least)


def lines_of(texts: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``(doc_id, text_hash, place, identity, bands, size)`` of each line that is long
    enough; the last two are null where the task has given them for an equal line, and
    for lines shorter than a shingle, which meet equal ones by identity alone."""
    min_bytes = max(1, min_bytes)
    doc_type = to_arrow_type(texts.schema["doc_id"].dataType)
    kinds = [doc_type, pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.int32()]
    names = ["doc_id", "text_hash", "place", "identity", "bands", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        rows: list[tuple] = []
        fresh: list[bytes] = []
        at: list[int] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal rows, fresh, at, size
            signed: list[list] = [[None] * len(rows) for _ in kinds[4:]]
            if fresh:
                keys, sizes = signatures(fresh)
                for i, *values in zip(at, keys.tolist(), sizes):
                    for column, value in zip(signed, values):
                        column[i] = value
            columns = [pa.array(c, k) for c, k in zip([*zip(*rows), *signed], kinds)]
            made = pa.RecordBatch.from_arrays(columns, names)
            rows, fresh, at, size = [], [], [], 0
            return made

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, value in zip(ids, batch.column("text").cast(pa.binary())):
                raw = value.as_py()
                if not raw:
                    continue
                whole = text_hash(raw)
                for place, line in enumerate(raw.split(b"\n")):
                    if len(line) < min_bytes or len(norm := normalize(line)) < min_bytes:
                        continue
                    identity = xxhash.xxh3_128_digest(norm)
                    if identity not in seen and len(norm) >= SHINGLE and (norm.isascii() or len(points_of(norm)) >= SHINGLE):
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(identity)
                        at.append(len(rows))
                        fresh.append(norm)
                        size += len(norm)
                    rows.append((doc_id, whole, place, identity))
                if size >= PIECE or len(rows) >= 20_000:
                    yield flush()
        if rows:
            yield flush()

    kind = texts.schema["doc_id"].dataType.simpleString()
    return map_batches(texts, run, f"doc_id {kind}, text_hash bigint, place int, identity binary, bands array<bigint>, size int")


def with_lines(rows: DataFrame) -> DataFrame:
    """``(node, line)`` from ``(text, wanted)``, for the places of a text (``place``,
    ``identity``, ``node``) whose line is the one meant."""

    def made(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
        columns = zip(*found) if found else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary()))], ["node", "line"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, size = [], 0
            for value, wanted in zip(batch.column("text").cast(pa.binary()), batch.column("wanted")):
                lines = value.as_py().split(b"\n")
                for one in wanted.as_py():
                    norm = normalize(lines[one["place"]]) if one["place"] < len(lines) else b""
                    if xxhash.xxh3_128_digest(norm) == one["identity"]:
                        found.append((one["node"], norm))
                        size += len(norm)
                if size >= PIECE:
                    yield made(found)
                    found, size = [], 0
            yield made(found)

    return map_batches(rows.select("text", "wanted"), run, "node bigint, line binary")


def with_bitmaps(lines: DataFrame) -> DataFrame:
    """``(node, bitmap)`` of ``(node, line)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [bitmap(grams_of(line.as_py())) for line in batch.column("line")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(made, pa.binary())], ["node", "bitmap"])

    return map_batches(lines, run, "node bigint, bitmap binary")


def verified(pairs: DataFrame, percent: int) -> DataFrame:
    """Of ``(a, b, line_a, line_b)`` the pairs over the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        size = 0

        def grams(node: int, line: pa.Scalar) -> np.ndarray:
            nonlocal size
            if node not in kept:
                raw = line.as_py()
                if size + len(raw) > KEPT_BYTES:
                    kept.clear()
                    size = 0
                kept[node] = grams_of(raw)
                size += len(raw)
            return kept[node]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            rows = zip(a, batch.column("line_a"), b, batch.column("line_b"))
            links = pa.array([overlap_at_least(grams(i, x), grams(j, y), percent) for i, x, j, y in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(links), batch.column("b").filter(links)], ["a", "b"])

    return map_batches(pairs, run, "a bigint, b bigint")


@owned
def removals(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``(doc_id, text_hash, removed)``: the places of the lines that go, for each
    document that loses any.

    Blank lines, and others of fewer than ``min_bytes`` bytes, stay. Documents without an id count as the
    last ones. Rows with one id and text lose the same lines; rows with one id and
    different texts are told apart by the text.
    """
    texts = keyed_texts(docs, id_column, text_column)
    lines = written(lines_of(texts, min_bytes), "lines")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "place", "text_hash")
    signed = [F.first(c, True).alias(c) for c in ("bands", "size")]
    classes = lines.groupBy("identity").agg(F.min(order).alias("first"), F.count("*").alias("n"), *signed)
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    nodes = classes.select("node", "identity", "first")
    postings = classes.select(F.explode("bands").alias("key"), "node", "size", F.lit(0).alias("place"))

    def lines_at(wanted: DataFrame) -> DataFrame:
        """The lines of the given nodes are read again where they are, in one pass; they
        and no texts travel."""
        wanted = written(wanted, "wanted")
        count = wanted.count()
        # A text comes once, with all the places that are wanted of it.
        named = nodes.join(checked_broadcast(wanted, count), "node")
        place = F.struct("first.place", "identity", "node")
        named = named.groupBy(F.col("first.doc_id").alias("holder"), "first.text_hash").agg(F.collect_list(place).alias("wanted"))
        same = F.col("doc_id").eqNullSafe(F.col("holder")) & (F.xxhash64("text") == F.col("text_hash"))
        return written(with_lines(texts.join(checked_broadcast(written(named, "named"), count), same)).dropDuplicates(["node"]), "read")

    held: list[DataFrame] = []  # the lines of nodes that are apart; later ones are among them

    def bitmaps(wanted: DataFrame) -> DataFrame:
        if not held:
            held.append(lines_at(wanted))
        return with_bitmaps(held[0])

    def verify(pairs: DataFrame) -> DataFrame:
        read = held[0] if held else lines_at(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        of_a = read.select(F.col("node").alias("a"), F.col("line").alias("line_a"))
        of_b = read.select(F.col("node").alias("b"), F.col("line").alias("line_b"))
        return verified(pairs.join(of_b.hint("merge"), "b").join(of_a.hint("merge"), "a"), percent)

    components = linked(postings, None, bitmaps, verify, percent)
    # What stays of each class: the first line of its component, or of itself.
    reached = classes.drop("bands", "size").join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    reached = written(reached.where(F.col("n") > 1).unionByName(reached.where((F.col("n") == 1) & (F.col("component") != F.col("node"))))
                      .unionByName(reached.where(F.col("n") == 1).join(components.select("component").distinct(), "component", "left_semi")
                                   .where(F.col("component") == F.col("node")).select(reached.columns)), "reached")
    keep = reached.groupBy("component").agg(F.min("first").alias("keep"), F.count("*").alias("n"))
    total, rows = reached.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    table = lookup(reached.select("identity", "n", "component").withColumnRenamed("n", "rows"), written(keep, "keep"), "component", total)
    table = written(table.select("identity", F.col("rows").alias("n"), "keep"), "keep")
    judged = lookup(lines.drop("bands", "size"), table, "identity", rows).where("keep IS NOT NULL")
    stays = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("place") == F.col("keep.place")) & (F.col("text_hash") == F.col("keep.text_hash"))
    return judged.where(~stays).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("place")).alias("removed"))


def apply_removals(docs: DataFrame, removed: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the text of the lines that stay, and ``removed``, null where none go."""
    gone = removed.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("removed").alias("__gone"))
    cells = removed.agg(F.coalesce(F.sum(F.size("removed") + 8), F.lit(0))).first()[0]
    same = quoted(id_column).eqNullSafe(F.col("__id")) & (F.xxhash64(quoted(text_column).cast("string")) == F.col("__hash"))
    joined = docs.join(checked_broadcast(gone, cells // 8), same, "left")
    # Split once; the places that stay are found by hash: linear in the lines of a text.
    split = F.when(F.col("__gone").isNotNull(), F.split(quoted(text_column).cast("string"), "\n", -1))
    joined = joined.withColumn("__lines", split)
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    stays = F.transform(left, lambda i: F.element_at(F.col("__lines"), i + 1))
    text = F.when(F.col("__gone").isNull(), quoted(text_column).cast("string")).otherwise(F.array_join(stays, "\n"))
    columns = [text.alias(c) if c == text_column else quoted(c) for c in docs.columns if c != "removed"]
    return joined.select(*columns, F.col("__gone").alias("removed"))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``(doc_id, text, n_lines, n_removed, removed)``, one row for each row: the text of
    the lines that stay, the number of lines before, and the places of those that went
    (from 0). Null texts stay null and have no lines."""
    texts = keyed_texts(docs, id_column, text_column)
    before = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0))
    counted = texts.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(before).cast("long"))
    done = apply_removals(counted, removals(texts, percent=percent, min_bytes=min_bytes))
    nothing = F.array().cast("array<int>")
    places = F.coalesce("removed", nothing)
    return done.select("doc_id", "text", "n_lines", F.size(places).cast("long").alias("n_removed"), places.alias("removed"))
