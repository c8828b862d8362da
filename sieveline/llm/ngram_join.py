"""Jaccard self-join of texts on word n-grams by rare-first prefix filtering.

Texts with equal sets of n-grams are one class. All n-grams have one global order, by a
Count-Min sketch that every task fills and Spark sums up, the rarest first. Of each
class's set only a prefix is indexed: two sets over the threshold share an n-gram of their
prefixes, and n-grams that the sketch says are in one text alone need no entry. Texts that
meet there pass the length filter, the positional filter (what stands behind the places
that meet bounds the overlap), and the suffix filter (the bits in which bitmaps of the
whole sets differ bound it too), and are then verified once on whole sets. N-grams are
compared by 64-bit hashes, sets by 128-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sieveline.functions.predicates import quoted
from sieveline.llm.common import keyed_texts, map_batches, ship, text_hash
from sieveline.llm.links import bitmap, checked_broadcast, linked, lookup
from sieveline.shared import owned, written

WORDS = 5
#: Percent of the union that the intersection has at least.
PERCENT = 80
#: Cells of the sketch of counts, in two rows, and the pieces in which they travel, compressed. A cell's
#: noise is all n-grams over the cells; n-grams below it are in order of their hashes.
CELLS, ROWS, PIECE = 1 << 21, 2, 1 << 16
CACHED_WORDS = 200_000
#: N-grams of a sketch of a text.
SKETCH = 8

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, forgotten as a whole when there are too many."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value
        return value


def shingles(text: bytes | None, hashes: WordHashes, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text's words, A-Z in lower case; of
    all words as one if there are fewer than ``n``; none without words."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    grams = min(n, len(words))
    mixed = np.full(len(words) - grams + 1, grams, np.uint64)
    for k in range(grams):
        mixed = mixed * MULTIPLIER + values[k : len(values) - grams + 1 + k]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def set_id(sets: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(sets.tobytes())


def _texts(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    for value in batch.column("text").cast(pa.binary()):
        yield value.as_py()


def cells_of(grams: np.ndarray, row: int) -> np.ndarray:
    """The cell of each n-gram in a row of the sketch."""
    bits = np.uint64(CELLS.bit_length() - 1)
    mixed = grams * np.uint64(0xD6E8FEB86659FD93) if row else grams
    return (mixed >> (np.uint64(64) - bits)).astype(np.int64)


def identify(texts: DataFrame, n: int = WORDS) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, identity, piece, cells)``: a row for each text,
    and rows without identity that hold the task's sketch of counts in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        counts = np.zeros((ROWS, CELLS), np.uint16)
        seen: list[np.ndarray] = []
        pending, any_text = 0, False

        def condense() -> None:
            nonlocal pending
            grams = np.concatenate(seen)
            for row in range(ROWS):
                times = np.bincount(cells_of(grams, row), minlength=CELLS)
                counts[row] = np.minimum(counts[row] + times, 65535)
            seen.clear()
            pending = 0

        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary()]
        names = ["doc_id", "text_hash", "n_shingles", "identity", "piece", "cells"]
        for batch in batches:
            wholes, sizes, identities = [], [], []
            for text in _texts(batch):
                grams = shingles(text, hashes, n)
                wholes.append(None if text is None else text_hash(text))
                sizes.append(len(grams))
                identities.append(set_id(grams) if len(grams) else b"")
                if len(grams):
                    seen.append(grams)
                    pending += len(grams)
                    any_text = True
                if pending > 1_500_000:
                    condense()
            rest = [pa.nulls(len(sizes), k) for k in kinds[2:]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(wholes, kinds[0]), pa.array(sizes, kinds[0]), pa.array(identities, kinds[1]), *rest], names)
        if seen:
            condense()
        if any_text:
            raw = counts.reshape(-1)
            packer = zstandard.ZstdCompressor(1)
            pieces = [packer.compress(raw[at : at + PIECE].tobytes()) for at in range(0, len(raw), PIECE)]
            nothing = [pa.nulls(len(pieces), k) for k in (doc_type, kinds[0], kinds[0], kinds[1])]
            yield pa.RecordBatch.from_arrays([*nothing, pa.array(range(len(pieces)), kinds[2]), pa.array(pieces, kinds[3])], names)

    doc_type = to_arrow_type(texts.schema["doc_id"].dataType)
    kind = texts.schema["doc_id"].dataType.simpleString()
    return map_batches(texts, run, f"doc_id {kind}, text_hash bigint, n_shingles bigint, identity binary, piece int, cells binary")


def summed_counts(found: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches, which has a fixed size. Each piece is summed up over
    some of the tasks, and these sums over all."""

    def run(key: tuple, table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PIECE, np.int64)
        for batch in table:
            for packed in batch.column("cells"):
                raw = zstandard.decompress(packed.as_py())
                total += np.frombuffer(raw, np.uint16 if len(raw) == 2 * PIECE else np.uint32)
        held = zstandard.compress(np.minimum(total, (1 << 32) - 1).astype(np.uint32).tobytes(), 1)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([held], pa.binary())], ["piece", "cells"])

    ship(found.sparkSession)
    parts = found.where("identity IS NULL").select("piece", "cells", F.pmod(F.xxhash64("cells"), F.lit(32)).alias("some"))
    sums = parts.groupBy("piece", "some").applyInArrow(run, "piece int, cells binary").groupBy("piece").applyInArrow(run, "piece int, cells binary")
    counts = np.zeros((ROWS * CELLS // PIECE, PIECE), np.uint32)
    for row in sums.collect():
        counts[row["piece"]] = np.frombuffer(zstandard.decompress(bytes(row["cells"])), np.uint32)
    return counts.reshape(ROWS, CELLS)


def weights(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many texts hold each n-gram, or more."""
    return np.minimum.reduce([counts[row][cells_of(sets, row)] for row in range(ROWS)])


def prefix_length(size: int, percent: int = PERCENT) -> int:
    return size - -(-percent * size // 100) + 1


def standing(texts: DataFrame, ids: DataFrame, count: int) -> DataFrame:
    """``ids`` with the text of each, which ``least`` and ``text_hash`` name."""
    same = F.col("doc_id").eqNullSafe(F.col("least")) & (F.xxhash64("text") == F.col("text_hash"))
    return texts.join(checked_broadcast(ids, count), same).drop("doc_id", "least", "text_hash")


def _sets(batch: pa.RecordBatch, hashes: WordHashes, n: int) -> Iterator[np.ndarray | None]:
    """The set of each row's text, None for a text that is not the one meant. A text
    that comes several times in a row is cut into n-grams once."""
    last: bytes | None = None
    grams = np.empty(0, np.uint64)
    for text, identity in zip(_texts(batch), batch.column("identity").to_pylist()):
        if last is None or text != last:
            last, grams = text, shingles(text, hashes, n)
        yield grams if set_id(grams) == identity else None


def profiles(stands: DataFrame, counts: np.ndarray, n: int, percent: int) -> DataFrame:
    """``(node, size, places, prefix, bitmap, sketch)`` of each standing text: the n-grams of
    its prefix that another text may have, their places in the order, and the smallest
    hashes of its set as a sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())]
        for batch in batches:
            rows = []
            for node, sets in zip(batch.column("node").to_pylist(), _sets(batch, hashes, n)):
                if sets is not None:
                    often = np.minimum(weights(sets, counts), 65535).astype(np.uint16)  # sorted in linear time
                    first = np.argsort(often, kind="stable")[: prefix_length(len(sets), percent)]
                    places = np.flatnonzero(often[first] > 1)
                    several = sets[often > 1]
                    rows.append((node, len(sets), places, sets[first[places]].view(np.int64), bitmap(sets), several[:SKETCH].view(np.int64)))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "size", "places", "prefix", "bitmap", "sketch"])

    schema = "node bigint, size int, places array<int>, prefix array<bigint>, bitmap binary, sketch array<bigint>"
    return map_batches(stands.select("node", "identity", "text"), run, schema)


def with_sets(stands: DataFrame, n: int) -> DataFrame:
    """``(a, b, sets)`` of standing texts ``(a, b, identity, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows, size = [], 0
            for a, b, sets in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), _sets(batch, hashes, n)):
                if sets is not None:
                    rows.append((a, b, sets.tobytes()))
                    size += sets.nbytes
                if size > 4_000_000:
                    yield _set_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _set_batch(rows)

    return map_batches(stands.select("a", "b", "identity", "text"), run, "a bigint, b bigint, sets binary")


def overlap_at_least(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether the intersection has ``percent`` of the union."""
    least = percent * (len(a) + len(b))  # (100 + percent) * overlap must reach it
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return bool((100 + percent) * np.count_nonzero(both[1:] == both[:-1]) >= least)


def _set_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["a", "b", "sets"])


def verified(pairs: DataFrame, percent: int) -> DataFrame:
    """Of ``(a, b, sets_a, sets_b)`` the pairs over the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (batch.column("sets_a"), batch.column("sets_b"))
            keep = [overlap_at_least(*[np.frombuffer(s.as_buffer(), np.uint64) for s in pair], percent) for pair in zip(*sides)]
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], ["a", "b"])

    return map_batches(pairs, run, "a bigint, b bigint")


@owned
def link(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, text_hash)``, one row for each row: the size
    of its set, the smallest id among the texts it reaches by links, and Spark's
    ``xxhash64`` of the text.

    A text without words has an empty set, is linked with nothing and is its own
    component, by its id. Null ids are never the smallest; a component without any
    other has a null id. Rows with one id are told apart by their texts. Other
    columns are left behind.
    """
    texts = keyed_texts(docs, id_column, text_column)
    found = written(identify(texts, n), "sets")
    rows = found.where("identity IS NOT NULL").select("doc_id", "text_hash", "n_shingles", "identity")
    total = rows.count()
    counts = summed_counts(found)

    # One text of each class stands for it. Its number is given once, when it is stored.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("first")
    classes = rows.where("n_shingles > 0").groupBy("identity").agg(first, F.count("*").alias("n"))
    classes = classes.select("identity", F.col("first.doc_id").alias("least"), "first.text_hash", "n", F.monotonically_increasing_id().alias("node"))
    classes = written(classes, "classes")
    nodes = classes.select("least", "text_hash", "identity", "node")
    count = nodes.count()
    repeated = rows.select("doc_id", "text_hash").distinct().count() < total
    # Rows with one id and one text stand for their class once.
    once = lambda df, *keys: df.dropDuplicates(list(keys)) if repeated else df
    profile = written(once(profiles(standing(texts, nodes, count), counts, n, percent), "node"), "profiles")
    entries = F.inline(F.arrays_zip(F.col("places").alias("place"), F.col("prefix").alias("key")))
    postings = profile.select("node", "size", entries).select("key", "node", "size", "place")

    def verify(pairs: DataFrame) -> DataFrame:
        """Pairs are verified once. The texts of both sides are read again where they are;
        only the sets travel, the second side's to the first's."""
        later = pairs.join(nodes, F.col("b") == F.col("node")).select("a", "b", "least", "text_hash", "identity")
        first = pairs.select("a").distinct().withColumn("b", F.col("a"))
        first = first.join(nodes, F.col("a") == F.col("node")).select("a", "b", "least", "text_hash", "identity")
        size = pairs.count()
        sets_b = once(with_sets(standing(texts, later, size), n), "a", "b").withColumnRenamed("sets", "sets_b")
        sets_a = once(with_sets(standing(texts, first, size), n), "a").select("a", F.col("sets").alias("sets_a"))
        return verified(sets_b.join(sets_a.hint("merge"), "a"), percent)

    sketches = profile.select("node", "size", F.explode("sketch").alias("key")).select("key", "node", "size")
    components = linked(postings, sketches, lambda nodes: profile.select("node", "bitmap"), verify, percent)

    # Back from classes to rows; the smallest id of a component is that of its classes.
    reached = nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = reached.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    named = lookup(reached, written(smallest, "smallest"), "component", count)
    table = written(classes.select("identity", "n").join(named.select("identity", "component_id"), "identity"), "named")
    result = lookup(rows.withColumn("identity", F.when(F.col("n_shingles") > 0, F.col("identity"))), table, "identity", total)
    own = F.when(F.col("identity").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select("doc_id", "n_shingles", own.alias("component_id"), "text_hash")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; of
    rows with one id and text, one. Documents without an id or without words stay."""
    found = written(link(docs, id_column, text_column, n, percent), "linked")
    dropped = found.where("doc_id != component_id").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    dropped = written(dropped, "dropped")
    same = (quoted(id_column) == F.col("__id")) & (F.xxhash64(quoted(text_column).cast("string")) == F.col("__hash"))
    kept = docs.join(checked_broadcast(dropped, dropped.count()), same, "left_anti")
    repeated = found.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("doc_id", "text_hash").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    again = written(repeated.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")), "repeated")
    count = again.count()
    once = kept.join(checked_broadcast(again, count), same, "left_anti")
    several = kept.join(checked_broadcast(again, count), same, "left_semi").dropDuplicates([id_column, text_column])
    return once.unionByName(several)
