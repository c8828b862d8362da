"""Token counts of whole texts with a public tokenizer, without their tokens.

Texts are encoded in Arrow functions that return numbers only. A batch given to the
tokenizer holds pieces of about ``BATCH_BYTES`` together, whatever the number of rows: short
texts are put together, long ones are cut at safe boundaries, so that a task holds the
tokens of one batch at a time, however long its texts are.

A boundary is safe where the tokenizer cuts on its own. The byte-level pattern never
has white space behind anything else within one piece and looks ahead only within
white space, so every place before white space that follows something else is safe,
unless a special token has it inside. A text without such a place is not cut, and neither
are the texts of other kinds of tokenizers, for which nothing is known of the kind.
The same boundaries part a batch into words, each of which is encoded once per batch, or
once per worker if it is short.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sieveline.llm.common import keyed_texts, map_batches

#: Bytes of text that the tokenizer gets at once; a piece of a long text has as many at most,
#: unless there is no safe place in them.
BATCH_BYTES = 1 << 20
LIMIT = 512

#: Words whose counts a worker remembers, and their longest length in characters.
KNOWN_WORDS, KNOWN_LENGTH = 400_000, 64

_SPACE = re.compile(rb"[ \n]")
# White space and what follows it: every one of these begins at a safe boundary.
_WORD = re.compile(r"\s*\S+|\s+\Z")
# White space of several bytes; a place behind it is not safe.
_WIDE_SPACE = "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _is_safe(raw: bytes, place: int, start: int, tokens: list[bytes]) -> bool:
    """Whether something that is no white space stands before the place, and the place
    is in no special token."""
    if not 0x20 < raw[place - 1] != 0x7F:
        return False
    first = place - 1
    while first > start and raw[first] & 0xC0 == 0x80:
        first -= 1
    if raw[first:place].decode("utf-8", "replace") in _WIDE_SPACE:
        return False
    return all(raw.find(t, max(start, place - len(t) + 1), place + len(t) - 1) < 0 for t in tokens)


def safe_end(raw: bytes, start: int, most: int, tokens: list[bytes]) -> int:
    """The last safe place in ``raw[start : start + most]`` behind its first byte, else
    the first one behind; the end if there is none."""
    if len(raw) - start <= most:
        return len(raw)
    place = start + most
    while (place := max(raw.rfind(b" ", start + 1, place), raw.rfind(b"\n", start + 1, place))) > 0:
        if _is_safe(raw, place, start, tokens):
            return place
    for found in _SPACE.finditer(raw, start + most):
        if _is_safe(raw, found.start(), start, tokens):
            return found.start()
    return len(raw)


def pieces(raw: bytes, most: int, tokens: list[bytes]) -> Iterator[bytes]:
    """The text in pieces whose token counts add up to its own."""
    start = 0
    while start < len(raw):
        end = safe_end(raw, start, most, tokens)
        yield raw[start:end]
        start = end


class Counter:
    """Counts the tokens of texts with a public tokenizer's own library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        self.special: list[bytes] = []
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.cuts = False
            self.count = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        self.cuts = _cuts_at_spaces(tokenizer)
        encode = tokenizer.encode_batch_fast
        self.encode = lambda texts: [len(e) for e in encode(texts, add_special_tokens=False)]
        self.known: dict[str, int] = {}
        self.count = self.by_words if self.cuts else self.encode

    def by_words(self, texts: list[str]) -> list[int]:
        """The tokens of each text as the sum of its words'."""
        words = [_WORD.findall(t) for t in texts]
        distinct = set().union(*words)
        new = list(distinct - self.known.keys())
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known.clear()
            new = list(distinct)
        self.known.update(zip(new, self.encode(new)))
        counts = [sum(map(self.known.__getitem__, w)) for w in words]
        for word in new:
            if len(word) > KNOWN_LENGTH:
                del self.known[word]
        return counts

    @staticmethod
    @cache
    def of(path: str) -> Counter:
        return Counter(path)


def _cuts_at_spaces(tokenizer) -> bool:
    """Whether the tokenizer is a byte-level one without a normalizer, whose pattern cuts
    before white space, and has no token that spaces beside it belong to."""
    parts = json.loads(tokenizer.to_str())
    cutter = parts["pre_tokenizer"] or {}
    plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space")
    beside = any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"])
    return bool(plain and not parts["normalizer"] and not parts["post_processor"] and not beside)


def batched_counts(counter: Counter, texts: Iterator[bytes], most: int) -> Iterator[int]:
    """The number of tokens of each text. The tokenizer gets batches of about ``most``
    bytes; a text may lie in several of them."""
    waiting: list[str] = []
    owners: list[int] = []
    totals: dict[int, int] = {}
    size, done = 0, 0

    def encode() -> None:
        for owner, n in zip(owners, counter.count(waiting)):
            totals[owner] += n
        waiting.clear()
        owners.clear()

    for index, raw in enumerate(texts):
        totals[index] = 0
        for piece in pieces(raw, most, counter.special) if counter.cuts else [raw] if raw else []:
            if size and size + len(piece) > most:
                encode()
                size = 0
            waiting.append(piece.decode("utf-8", "replace"))
            owners.append(index)
            size += len(piece)
        if not size:  # nothing is waiting: all texts so far are whole
            while done <= index:
                yield totals.pop(done)
                done += 1
    if waiting:
        encode()
    while done in totals:
        yield totals.pop(done)
        done += 1


def count(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = LIMIT,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row for each row: the bytes of
    the text in UTF-8, its tokens as the library of the file ``tokenizer`` counts them
    (``tokenizers`` for ``.json``, ``sentencepiece`` for ``.model``) without tokens added at
    its ends, and whether they are more than ``limit``.

    A special token's string inside a text is what the library makes of it by default. A
    null text is an empty one and has no tokens. Repeated rows and ids are counted row by
    row, a null id stays null, an empty table gives an empty one, and other columns are
    left behind. Nothing is shuffled: a lost task counts its rows again.
    """
    texts = keyed_texts(docs, id_column, text_column)
    names = ["doc_id", "n_bytes", "n_tokens"]
    doc_type = to_arrow_type(texts.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(tokenizer)
        for batch in batches:
            column = batch.column("text").cast(pa.large_binary())
            raw = (column[i].as_py() or b"" for i in range(batch.num_rows))
            counts = pa.array(list(batched_counts(counter, raw, batch_bytes)), pa.int64())
            sizes = pa.compute.coalesce(pa.compute.binary_length(column).cast(pa.int64()), pa.scalar(0, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(doc_type), sizes, counts], names)

    kind = texts.schema["doc_id"].dataType.simpleString()
    counted = map_batches(texts, run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
