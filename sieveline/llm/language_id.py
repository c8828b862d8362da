"""Language of texts and of the spans of mixed ones.

Every word gets a score per language from its letter trigrams. The script of a word
(by code point ranges) narrows the languages it can have. Viterbi over the words, with
a penalty for each switch of language, labels the spans. Words of a whole batch are
scored at once; the search runs only over texts in which a switch could pay at all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.predicates import quoted
from sieveline.llm.common import map_batches

#: Texts per language the scores are fitted on, about; twice as many at most.
SAMPLE = 1500
#: Log-odds a switch of language costs; the weight of a trigram (they overlap).
SWITCH = 12.0
WEIGHT = 0.5
#: Characters of the texts whose words are held at once, unless one text has more.
PIECE = 500_000
#: Buckets of the trigram tables, a power of two, and the smoothing count.
BUCKETS = 1 << 16
SMOOTH = 0.5
#: Share of its letters a language must have in a script to be a candidate.
SCRIPT_SHARE = 0.005
IMPOSSIBLE = -1000.0
UNDETERMINED = "und"

# First and last code point of the blocks of each script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}


@lru_cache(maxsize=1)
def script_table() -> np.ndarray:
    """By code point: 0 for no letter, else 1 + the number of its script; letters of
    no listed script come last."""
    table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000).astype(np.uint8) * (len(SCRIPTS) + 1)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            part = table[first : last + 1]
            part[part > 0] = number
    return table


def few_at_once(texts: Iterable[str], most: int = PIECE) -> Iterator[list[str]]:
    """Texts in lists of about ``most`` characters together, at least one in each."""
    held: list[str] = []
    size = 0
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


@dataclass
class Words:
    """The words of several texts: where each begins and ends in the joined code
    points, the text it is of, its script, and its trigrams' buckets (by letter)."""

    start: np.ndarray
    stop: np.ndarray
    text: np.ndarray
    script: np.ndarray
    grams: np.ndarray
    first: np.ndarray  # of each word among the letters
    offsets: np.ndarray  # of the texts in the joined code points


def words_of(texts: list[str]) -> Words:
    """Maximal runs of letters. Lower case is taken letter by letter, so places are
    those of the text itself."""
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    joined = "\n".join([*texts, ""])
    lowered = joined.lower()
    if len(lowered) != len(joined):
        lowered = "".join(low if len(low := c.lower()) == 1 else c for c in joined)
    points = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)
    scripts = script_table()[points]
    letter = scripts > 0
    edges = np.diff(letter.astype(np.int8), prepend=0, append=0)
    start, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    masked = np.where(letter, points, 0).astype(np.uint64)
    before = np.concatenate(([0], masked[:-1])).astype(np.uint64)
    after = np.concatenate((masked[1:], [0])).astype(np.uint64)
    mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (masked * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (after * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    grams = (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1))[letter].astype(np.int64)
    text = np.searchsorted(offsets, start, "right") - 1
    first = np.concatenate(([0], np.cumsum(stop - start)))
    return Words(start, stop, text, scripts[start], grams, first, offsets)


@dataclass
class Model:
    """Log shares of the trigram buckets and candidates by script, per language."""

    languages: list[str]
    grams: np.ndarray  # buckets x languages
    candidates: np.ndarray  # scripts x languages

    def score(self, words: Words) -> np.ndarray:
        """Words x languages. A word of a script without a candidate says nothing."""
        if not len(words.start):
            return np.zeros((0, len(self.languages)), np.float32)
        scores = np.add.reduceat(self.grams[words.grams], words.first[:-1], axis=0) * np.float32(WEIGHT)
        possible = self.candidates[words.script]
        some = possible.any(axis=1)
        scores[~some] = 0
        scores[some[:, None] & ~possible] = IMPOSSIBLE
        return scores


def path(scores: np.ndarray, switch: float) -> np.ndarray:
    """The best label of each word: highest sum of scores less the switches' cost.
    Ties go to the language that comes first."""
    total = scores.sum(axis=0)
    best = int(total.argmax())
    # Not leaving ``best`` is optimal if no run of words gains over half a switch in any
    # other language: a path with m runs elsewhere has at least m / 2 switches.
    gain = np.zeros((len(scores) + 1, scores.shape[1]))
    np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64, out=gain[1:])
    if (gain - np.minimum.accumulate(gain, axis=0)).max() <= switch / 2:
        return np.full(len(scores), best)
    rows, n = scores.tolist(), scores.shape[1]
    value, back = list(rows[0]), []
    for row in rows[1:]:
        top = max(value)
        came, floor = value.index(top), top - switch
        back.append([k if value[k] >= floor else came for k in range(n)])
        value = [(v if v >= floor else floor) + s for v, s in zip(value, row)]
    labels = np.empty(len(scores), np.int64)
    at = value.index(max(value))
    for i in range(len(scores) - 1, 0, -1):
        labels[i] = at
        at = back[i - 1][at]
    labels[0] = at
    return labels


def label(texts: list[str], model: Model, switch: float = SWITCH) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
    """For each text its language, a score and its spans ``(language, start, stop)``.

    The language is the one with the most letters. The score is its share of the
    letters times the certainty within its words against the best other language.
    """
    words = words_of(texts)
    scores = model.score(words)
    bounds = np.searchsorted(words.text, np.arange(len(texts) + 1))
    letters = words.stop - words.start
    found = []
    for k in range(len(texts)):
        lo, hi = bounds[k], bounds[k + 1]
        if lo == hi or not model.languages:
            found.append((UNDETERMINED, 0.0, []))
            continue
        mine = scores[lo:hi]
        labels = path(mine, switch)
        sizes = np.bincount(labels, letters[lo:hi], len(model.languages))
        top = int(sizes.argmax())
        sums = mine[labels == top].sum(axis=0, dtype=np.float64)
        odds = np.exp(np.clip(sums - sums[top], -700, 700))
        certain = 1.0 / odds.sum()
        cuts = np.flatnonzero(np.diff(labels)) + 1
        first, last = np.concatenate(([0], cuts)) + lo, np.concatenate((cuts, [hi - lo])) + lo - 1
        base = words.offsets[k]
        spans = [(model.languages[labels[a - lo]], int(words.start[a] - base), int(words.stop[b] - base)) for a, b in zip(first, last)]
        found.append((model.languages[top], float(sizes[top] / sizes.sum() * certain), spans))
    return found


def held_out(id_column: str) -> Column:
    """Documents whose label is never learned from."""
    return F.coalesce(F.crc32(quoted(id_column).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", sample: int = SAMPLE) -> Model:
    """The scores, from about ``sample`` labelled texts of each language that are not
    held out, chosen by the hash of the text. The trigrams are counted in the tasks
    and summed by language and bucket, a table of bounded size."""
    labelled = docs.where(~held_out(id_column) & quoted(lang_column).isNotNull()).select(
        quoted(lang_column).cast("string").alias("lang"), quoted(text_column).cast("string").alias("text")
    ).where("text is not null")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS) + 2, 0), bool))
    # A text's share of the hash range is its language's sampling rate.
    steps = 1 << 20
    rate = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, sample / n) * steps) + 1)])
    chosen = labelled.where(F.pmod(F.xxhash64("text"), F.lit(steps)) < rate[F.col("lang")]).limit(2 * sample * len(sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                counts = np.zeros(BUCKETS + len(SCRIPTS) + 2, np.int64)
                for some in few_at_once(texts):
                    words = words_of(some)
                    counts[:BUCKETS] += np.bincount(words.grams, minlength=BUCKETS)
                    counts[BUCKETS:] += np.bincount(words.script, words.stop - words.start, len(SCRIPTS) + 2).astype(np.int64)
                places = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(places)), pa.array(places, pa.int32()), pa.array(counts[places], pa.int64())], ["lang", "place", "n"]
                )

    counted = map_batches(chosen, run, "lang string, place int, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    languages = sorted(sizes)
    table = np.zeros((BUCKETS + len(SCRIPTS) + 2, len(languages)))
    number = {lang: k for k, lang in enumerate(languages)}
    for r in counted.collect():
        table[r["place"], number[r["lang"]]] = r["n"]
    letters = table[BUCKETS:]
    keep = letters.sum(axis=0) > 0
    grams = table[:BUCKETS, keep] + SMOOTH
    shares = letters[:, keep] / letters[:, keep].sum(axis=0)
    names = [lang for lang, k in zip(languages, keep) if k]
    return Model(names, np.log(grams / grams.sum(axis=0)).astype(np.float32), shares >= SCRIPT_SHARE)


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", switch: float = SWITCH, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, spans)``, one row for each row, and the
    columns named in ``keep``. Only the text is an input of the prediction.

    Null texts and texts without letters are ``und`` with score 0 and no spans, as is
    every text if nothing was learned. Other columns are left behind.
    """
    taken = {"doc_id", "held_out", "lang_pred", "score", "spans", "__text"}
    if clash := [c for c in keep if c in taken]:
        raise ValueError(f"columns {clash} are results and cannot be kept")
    # The text travels once, under its own name if it is kept.
    source = text_column if text_column in keep and dict(docs.dtypes)[text_column] == "string" else "__text"
    texts = [] if source == text_column else [quoted(text_column).cast("string").alias(source)]
    rows = docs.select(quoted(id_column).alias("doc_id"), held_out(id_column).alias("held_out"), *texts, *map(quoted, keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = 0
            for texts in few_at_once(value.as_py() or "" for value in whole.column(source)):
                batch = whole.slice(at, len(texts))
                at += len(texts)
                found = label(texts, model, switch)
                spans = pa.array([[{"lang": a, "start": b, "stop": c} for a, b, c in s] for _, _, s in found], SPANS)
                columns = [batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), spans]
                yield pa.RecordBatch.from_arrays([*columns, *[batch.column(c) for c in keep]], ["doc_id", "held_out", "lang_pred", "score", "spans", *keep])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"doc_id {kinds['doc_id']}, held_out boolean, lang_pred string, score double, spans array<struct<lang:string,start:int,stop:int>>"
    schema += "".join(f", `{c.replace('`', '``')}` {kinds[c]}" for c in keep)
    return map_batches(rows, run, schema)


SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))


def predict(docs: DataFrame, **columns: str) -> DataFrame:
    """Fit on the labelled documents that are not held out, then identify all."""
    names = {k: v for k, v in columns.items() if k in ("id_column", "text_column")}
    return identify(docs, fit(docs, **columns), **names)
