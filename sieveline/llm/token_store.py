"""Token ids in binary shards, compressed by a Re-Pair grammar.

Documents in ascending order are tokenized and cut into shards. In each shard frequent
pairs of neighbouring ids are replaced by nonterminals, the most frequent first, until
none is there ``MIN_COUNT`` times. A pass replaces all pairs that are at least an eighth as
frequent as the most frequent one, but for those whose occurrences could overlap with
one of a more frequent pair: a symbol is on the left of the pairs of a pass or on
the right of them. So no pair of a pass takes away from another's count. A shard stores the
rules, the length each symbol expands to, and an index of its documents, so one document,
or one token in it, is decoded without the others.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.llm.bpe import Known, byte_letters, chunks, pieces
from sieveline.llm.common import keyed_texts, map_batches
from sieveline.llm.files import make_folder, spread, store_of, task_file
from sieveline.shared import new_folder

#: Ids of a shard, after which the next one begins (a document is never cut).
SHARD_TOKENS = 1 << 22
#: Occurrences that make a pair frequent: what a rule costs is stored three times.
MIN_COUNT = 16
#: Part of the count of the most frequent pair that others of a pass have.
PASS_SHARE = 8
SLOT_BITS = 20
#: Places whose slots are made at once.
BLOCK = 1 << 15
CACHED_PIECES = 500_000
#: Ids of a shard that are decoded at once.
TOGETHER = 1 << 16
# Punctuation that no pattern of the vocabulary joins to a word, and the end of
# the letters that are the same in every normal form.
PUNCTUATION = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
PLAIN = "\u0250"
MAGIC = b"REPAIR01"
HEAD = struct.Struct("<8sIIIQQ")

MANIFEST = "part int, shard int, file string, docs int, tokens bigint"
READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


class Grammar:
    """Rules over the ids ``0 .. width - 1``; symbol ``width + k`` is rule ``k``."""

    def __init__(self, width: int, left: np.ndarray, right: np.ndarray):
        self.width, self.left, self.right = width, left, right
        self.lengths = np.ones(width + len(left), np.int64)
        for k in range(len(left)):
            self.lengths[width + k] = self.lengths[left[k]] + self.lengths[right[k]]

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """All symbols' expansions behind each other, and where each begins."""
        starts = np.zeros(len(self.lengths), np.int64)
        np.cumsum(self.lengths[:-1], out=starts[1:])
        flat = np.empty(int(self.lengths.sum()), np.int32)
        flat[: self.width] = np.arange(self.width)
        for k in range(len(self.left)):
            at, (a, b) = starts[self.width + k], (self.left[k], self.right[k])
            middle = at + self.lengths[a]
            flat[at:middle] = flat[starts[a] : starts[a] + self.lengths[a]]
            flat[middle : middle + self.lengths[b]] = flat[starts[b] : starts[b] + self.lengths[b]]
        return flat, starts

    def expand(self, symbols: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        flat, starts = table
        lengths = self.lengths[symbols]
        ends = np.cumsum(lengths)
        shift = np.repeat(starts[symbols] - (ends - lengths), lengths)
        return flat[shift + np.arange(len(shift))]

    def token(self, symbols: np.ndarray, at: int) -> int:
        """The id at one place, by descending the rules."""
        ends = np.cumsum(self.lengths[symbols])
        k = int(np.searchsorted(ends, at, "right"))
        symbol, at = int(symbols[k]), at - int(ends[k] - self.lengths[symbols[k]])
        while symbol >= self.width:
            left = int(self.left[symbol - self.width])
            if at < self.lengths[left]:
                symbol = left
            else:
                symbol, at = int(self.right[symbol - self.width]), at - int(self.lengths[left])
        return symbol


def compress(ids: np.ndarray, last: np.ndarray, width: int, min_count: int = MIN_COUNT) -> tuple[Grammar, np.ndarray, np.ndarray]:
    """Grammar, symbols, and which symbols end a document. ``last`` marks the ids that
    do; no pair reaches over them."""
    symbols, last = ids.astype(np.uint32), last.copy()
    lefts, rights, rules, top = [], [], 0, None
    # Places whose pair may be frequent: a pair that is not becomes no more frequent later.
    live = np.flatnonzero(~last[:-1]) if len(symbols) else np.empty(0, np.int64)
    while len(live):
        slots = np.empty(len(live), np.intp)
        for k in range(0, len(live), BLOCK):
            part = live[k : k + BLOCK]
            slots[k : k + BLOCK] = _slots(symbols[part], symbols[part + 1])
        counts = np.bincount(slots, minlength=1 << SLOT_BITS)
        # No slot holds more of one pair than of all its pairs: whatever is frequent is in a frequent slot.
        bound = int(counts.max())
        if bound < min_count:
            break
        top = min(bound, top or bound)
        least = max(min_count, top // PASS_SHARE)
        # By slot, 0 if it is rare, 1 if it may be frequent, 2 if a pair of this pass may be in it.
        grade = ((counts >= min_count).astype(np.uint8) + (counts >= least))[slots]
        at = live[grade == 2]
        live = live[grade > 0]
        slots = slots[grade == 2]
        keys = symbols[at].astype(np.uint64) << np.uint64(32) | symbols[at + 1]
        pairs, times = _counted(keys)
        chosen = _apart(pairs, times, least)
        if not len(chosen):
            if least == min_count:
                break
            top = least - 1
            continue
        place, rule = _places(keys, slots, pairs[chosen])
        taken = at[place]
        # Only a pair of two equal symbols overlaps itself; of a run every other one is replaced.
        if (symbols[taken] == symbols[taken + 1]).any():
            begins = np.concatenate(([True], np.diff(taken) != 1))
            place = np.arange(len(taken))
            keep = (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0
            taken, rule = taken[keep], rule[keep]
        lefts.append((pairs[chosen] >> np.uint64(32)).astype(np.int64))
        rights.append((pairs[chosen] & np.uint64(0xFFFFFFFF)).astype(np.int64))
        top = int(times[chosen].max())
        symbols[taken] = (width + rules + rule).astype(np.uint32)
        last[taken] = last[taken + 1]
        rules += len(chosen)
        # The new symbols and what stands before them make new pairs.
        mark = np.zeros(len(symbols), bool)
        mark[live] = mark[taken] = True
        left = np.ones(len(symbols), bool)
        left[taken + 1] = False
        left = np.flatnonzero(left)
        symbols, last, mark = symbols[left], last[left], mark[left]
        made = taken - np.arange(len(taken))
        mark[made[made > 0] - 1] = True
        live = np.flatnonzero(mark[:-1] > last[:-1])
    join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return Grammar(width, join(lefts), join(rights)), symbols.astype(np.int64), last


def _slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A slot for each pair."""
    mixed = left * np.uint32(0x9E3779B1)
    mixed += right
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x85EBCA77)
    mixed >>= np.uint32(32 - SLOT_BITS)
    return mixed


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs in ascending order and how often each is there."""
    ordered = np.sort(keys)
    begins = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return ordered[begins], np.diff(begins, append=len(ordered))


def _places(keys: np.ndarray, slots: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where one of the chosen pairs is, ascending, and which. They are met by their
    slots; of those that share one, each is looked for by itself."""
    own = _slots((chosen >> np.uint64(32)).astype(np.uint32), chosen.astype(np.uint32))
    owner = np.full(1 << SLOT_BITS, -1, np.int32)
    owner[own] = np.arange(len(chosen))
    which = owner[slots]
    near = np.flatnonzero(which >= 0)
    which = which[near]
    same = chosen[which] == keys[near]
    lost = np.flatnonzero(owner[own] != np.arange(len(chosen)))
    if len(lost):
        rest = np.flatnonzero(~same)
        order = lost[np.argsort(chosen[lost])]
        found = order[np.minimum(np.searchsorted(chosen[order], keys[near[rest]]), len(order) - 1)]
        met = chosen[found] == keys[near[rest]]
        which[rest[met]], same[rest[met]] = found[met], True
    return near[same], which[same].astype(np.int64)


def _apart(pairs: np.ndarray, times: np.ndarray, least: int) -> np.ndarray:
    """The pairs of a pass, most frequent first, equally frequent ones by their symbols:
    none whose left symbol is another's right one."""
    often = np.flatnonzero(times >= least)
    order = often[np.argsort(-times[often], kind="stable")]
    lefts: set[int] = set()
    rights: set[int] = set()
    chosen = []
    for k, a, b in zip(order.tolist(), (pairs[order] >> np.uint64(32)).tolist(), (pairs[order] & np.uint64(0xFFFFFFFF)).tolist()):
        if a in rights or b in lefts or (a == b and (a in lefts or b in rights)):
            continue
        lefts.add(a)
        rights.add(b)
        chosen.append(k)
    return np.array(chosen, np.int64)


def pack_shard(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    """A shard's bytes: head; left and right parts and expansion lengths of the rules;
    per document its id, whether it has one, its number of ids and the end of its
    symbols; the symbols."""
    last = np.zeros(len(ids), bool)
    ends = np.cumsum(lengths)
    last[ends[lengths > 0] - 1] = True
    grammar, symbols, ended = compress(ids, last, width)
    symbol_ends = np.zeros(len(lengths), np.int64)
    symbol_ends[lengths > 0] = np.flatnonzero(ended) + 1
    symbol_ends = np.maximum.accumulate(symbol_ends) if len(symbol_ends) else symbol_ends
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], np.int64)
    head = HEAD.pack(MAGIC, width, len(grammar.left), len(doc_ids), len(symbols), len(ids))
    parts = [
        grammar.left.astype("<u4"), grammar.right.astype("<u4"), grammar.lengths[width:].astype("<u4"),
        numbers.astype("<i8"), known, lengths.astype("<u4"), symbol_ends.astype("<u8"), symbols.astype("<u4"),
    ]
    return head + b"".join(p.tobytes() for p in parts)


class Shard:
    """A shard read back; ``ids(k)`` and ``token(k, at)`` decode one document or id."""

    def __init__(self, raw: bytes):
        magic, width, rules, docs, symbols, self.tokens = HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            values = np.frombuffer(raw, kind, n, at)
            at += values.nbytes
            return values

        left, right, lengths = take("<u4", rules), take("<u4", rules), take("<u4", rules)
        self.grammar = Grammar.__new__(Grammar)
        self.grammar.width, self.grammar.left, self.grammar.right = width, left.astype(np.int64), right.astype(np.int64)
        self.grammar.lengths = np.concatenate((np.ones(width, np.int64), lengths.astype(np.int64)))
        self.doc_ids, self.known, self.lengths = take("<i8", docs), take("u1", docs), take("<u4", docs).astype(np.int64)
        self.ends = take("<u8", docs).astype(np.int64)
        self.symbols = take("<u4", symbols).astype(np.int64)
        self.table = None

    def of(self, k: int) -> np.ndarray:
        return self.symbols[self.ends[k - 1] if k else 0 : self.ends[k]]

    def ids(self, k: int) -> np.ndarray:
        self.table = self.table or self.grammar.table()
        return self.grammar.expand(self.of(k), self.table)

    def each(self) -> Iterator[np.ndarray]:
        """The ids of every document in turn; those of small ones are decoded together."""
        self.table = self.table or self.grammar.table()
        stops, k = np.cumsum(self.lengths), 0
        while k < len(stops):
            stop = max(k + 1, int(np.searchsorted(stops, stops[k] - self.lengths[k] + TOGETHER, "right")))
            flat = self.grammar.expand(self.symbols[self.ends[k - 1] if k else 0 : self.ends[stop - 1]], self.table)
            yield from np.split(flat, np.cumsum(self.lengths[k : stop - 1]))
            k = stop

    def token(self, k: int, at: int) -> int:
        return self.grammar.token(self.of(k), at)


class LibraryEncoder:
    """Ids by the tokenizers library. Pieces between white space, which no token
    crosses, are given to it once each, and remembered up to a bound.

    Most pieces are a word of plain letters with punctuation behind. The library's
    normalizer and patterns would only lower its case and cut it in two; such parts go
    to its BPE model at once, every other piece through all of the library.
    """

    def __init__(self, vocabulary: str, cached: int = CACHED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.of_piece = Known(self.piece, cached)
        self.of_part = Known(self.part, cached)

    @property
    def width(self) -> int:
        return self.tokenizer.get_vocab_size()

    def part(self, text: str) -> bytes:
        """Ids of one lower-case word or run of punctuation."""
        raw = text if text.isascii() else "".join(map(self.letters.__getitem__, text.encode()))
        return packed([t.id for t in self.model.tokenize(raw)])

    def piece(self, text: str) -> bytes:
        word = text.rstrip(PUNCTUATION)
        if word.isalpha() and (word.isascii() or max(word) < PLAIN) and (low := word.lower()).isalpha():
            ids = self.of_part[low]
            return ids + self.of_part[text[len(word) :]] if len(word) < len(text) else ids
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids of a text; none for null."""
        return b"".join(b"".join(map(self.of_piece.__getitem__, pieces(part))) for part in chunks(text or ""))


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> LibraryEncoder:
    """One encoder for each vocabulary in a worker."""
    return LibraryEncoder(vocabulary)


def write_shards(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int, shard_tokens: int = SHARD_TOKENS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Write the ids of every text, ``end_id`` behind each, in ascending order of the
    documents, and return the manifest ``(part, shard, file, docs, tokens)``.

    Null texts are empty, null ids come first, repeated ids in the order of their
    texts' hashes. Ids are dealt out by range, so shards follow each other.
    """
    make_folder(folder)
    texts = keyed_texts(docs, id_column, text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    tie = F.xxhash64("text")
    ordered = texts.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        encoder = _encoder(vocabulary)
        width = max(encoder.width, end_id + 1)
        held_ids, held, tokens = [], [], 0

        def save() -> pa.RecordBatch:
            nonlocal held_ids, held, tokens, shard
            lengths = np.array([len(x) // 4 for x in held], np.int64)
            raw = pack_shard(held_ids, lengths, np.frombuffer(b"".join(held), "<u4"), width)
            name = task_file(folder, shard, ".ids")
            store, path = store_of(name)
            with store.open_output_stream(path, compression=None) as file:
                file.write(raw)
            row = [[part], [shard], [name], [len(held)], [tokens]]
            held_ids, held, tokens, shard = [], [], 0, shard + 1
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], ["part", "shard", "file", "docs", "tokens"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                raw = encoder.encode(text.as_py())
                held_ids.append(doc_id)
                held.append(raw + end)
                tokens += len(raw) // 4 + 1
                if tokens >= shard_tokens:
                    yield save()
        if held:
            yield save()

    manifest = map_batches(ordered, run, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document of the shards: ``(doc_id, start, n_tokens, ids_crc32)``. The ids
    before a shard are summed over the tasks that wrote (a row of each reaches the
    driver) and over the shards of its own."""
    parts = sorted((r["part"], r["tokens"]) for r in manifest.groupBy("part").agg(F.sum("tokens").alias("tokens")).collect())
    sums = np.concatenate(([0], np.cumsum([n for _, n in parts], dtype=np.int64)))
    begins = manifest.sparkSession.createDataFrame([(p, int(n)) for (p, _), n in zip(parts, sums)], "part int, begin bigint")
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.join(F.broadcast(begins), "part")
    placed = placed.select("file", (F.col("begin") + F.coalesce(F.sum("tokens").over(before), F.lit(0))).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                store, path = store_of(name)
                with store.open_input_stream(path, compression=None) as file:
                    shard = Shard(file.read())
                starts = start + np.concatenate(([0], np.cumsum(shard.lengths)))[:-1]
                checks = [zlib.crc32(ids.astype("<u4")) for ids in shard.each()]
                ids = pa.array(shard.doc_ids, pa.int64(), mask=shard.known == 0)
                columns = [ids, pa.array(starts, pa.int64()), pa.array(shard.lengths, pa.int64()), pa.array(checks, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_batches(spread(placed, "file"), run, READ)


def store(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write all documents to a new folder and read them back."""
    return read_shards(write_shards(docs, new_folder(spark, "ids"), vocabulary, end_id))
