"""Benchmark items in texts, also with some edits.

Random walks of Chakraborty, Goldenberg and Koucky embed edit distance into Hamming
distance: a walk reads a character per step and goes on to the next one or stays, as a
coin of the step and the character says, so two sequences that differ by an edit fall into
step again soon behind it. Of each embedding some steps are sampled as a key of a locality
sensitive hash: windows of an item and of an edited copy agree in all of them with a
probability that ``WALKS`` independent walks raise to the target recall.

Windows start between words (in scripts without spaces, and far into very long words, at
every character), in texts and items alike, and have as many steps as the item's class of
size asks for: long items have more windows, so theirs may be longer and meet by chance
more rarely. A key that is met says where the item would begin. Places where too few of
the item's runs of three characters stand to be within the limit are left out, which
loses none, and the exact edit distance of the whole item to the text around decides.

Items too short for walks are met by seeds at each of their characters, as long as one
with all allowed edits still holds unedited.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from sieveline.functions.predicates import quoted
from sieveline.llm.common import kept, map_batches
from sieveline.shared import written

#: Edits an occurrence may have, as a share of the item's characters.
EDITS = 0.2
#: Walks, and by the least characters of an item the steps of a walk and how many of them
#: are sampled. Measured: 12 walks meet more than 0.95 of items with edits at the limit.
WALKS = 12
CLASSES = ((45, 24, 10), (80, 30, 12), (240, 36, 14), (1000, 48, 16))
#: Steps that are looked up at once, and bits of a character's class.
STEPS, BITS = 3, 5
#: Characters of a seed of a short item at most; the probability with which a longer seed than
#: the sure one stays unedited in an item with all its edits.
SEED, RECALL = 8, 0.99
#: Characters of the runs that are counted around a place. An edit changes as many of them.
RUN = 3
#: Characters on either side of a window's start that are compared run by run, how far edits
#: move them there, and the share of the item's runs that has to be found. Edits at the
#: limit leave 0.5 of them, and 0.4 if they are as far apart as can be.
BESIDE, MOVED, FOUND = 48, 6, 0.27
#: Characters below which an item has to stand between words.
BOUNDED = 45
#: Letters of a word behind which every character starts a window.
LONG_WORD = 24
#: Characters of normalized text that are searched at once; places around tries that are looked at together.
CHUNK, AROUND = 1 << 18, 1 << 19
#: Bytes of items that are searched for in one pass; more items take more passes.
ITEM_BYTES = 1 << 22
#: Windows whose walks go on together.
WINDOWS = 1 << 16
#: Hits that are compared at once.
HITS = 1 << 12


def normalize(text: str | None) -> str:
    """Lower case, one space between words."""
    return " ".join((text or "").lower().split())


def best_match(item: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of ``item`` to any part of ``text`` and where the first such
    part ends, None if it is over ``most``. Bit-parallel over the item."""
    if (at := text.find(item)) >= 0:
        return 0, at + len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    size = len(item)
    full, last = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score, best, end = full, 0, size, size, 0
    for place, c in enumerate(text):
        same = masks.get(c, 0)
        vertical = same | minus
        horizontal = (((same & plus) + plus) ^ plus) | same
        up, down = minus | ~(horizontal | plus) & full, plus & horizontal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
            if score < best:
                best, end = score, place + 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
    return (best, end) if best <= most else None


def unspaced(c: str) -> bool:
    """Whether ``c`` belongs to a script written without spaces between words."""
    return "\u0e00" <= c <= "\u0eff" or "\u1000" <= c <= "\u109f" or "\u1780" <= c <= "\u17ff" or "\u2e80" <= c <= "\u9fff" or "\uf900" <= c <= "\ufaff" or c >= "\U00020000"


def boundary(text: str, at: int) -> bool:
    """Whether no word runs over the place: of the characters beside it one is neither a
    letter nor a digit, or belongs to a script without spaces."""
    return not 0 < at < len(text) or not (text[at - 1].isalnum() and text[at].isalnum()) or unspaced(text[at - 1]) or unspaced(text[at])


def bounded_match(item: str, text: str, most: int, lo: int, hi: int) -> tuple[int, int, int] | None:
    """Like ``best_match`` for the parts of ``text[lo:hi]`` that begin and end between
    words: distance, start and end.
    Where one edit is allowed it may not be a space: a joined pair of words is another word."""
    size, best = len(item), None
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, last = (1 << size) - 1, 1 << (size - 1)
    for start in range(lo, hi):
        if not boundary(text, start):
            continue
        plus, minus, score = full, 0, size
        for place in range(start, min(hi, start + size + most)):
            same = masks.get(text[place], 0)
            vertical = same | minus
            horizontal = (((same & plus) + plus) ^ plus) | same
            up, down = minus | ~(horizontal | plus) & full, plus & horizontal
            score += bool(up & last) - bool(down & last)
            up, down = (up << 1 | 1) & full, down << 1 & full
            plus, minus = down | ~(vertical | up) & full, up & vertical
            if score <= most and (best is None or score < best[0]) and boundary(text, place + 1):
                if most > 1 or text.count(" ", start, place + 1) == item.count(" "):
                    best = score, start, place + 1
    return best


def seed_length(size: int, most: int, edits: float) -> int:
    """Characters of the seeds of an item: as many as one of the runs between ``most``
    edits surely has, or more if with random edits one has them with ``RECALL``."""
    sure = -(-(size - most) // (most + 1))
    for q in range(SEED, sure, -1):
        if (1 - (1 - edits) ** q) ** (most + 1) <= 1 - RECALL:
            return q
    return min(sure, SEED)


def seeds_of(points: np.ndarray, q: int) -> np.ndarray:
    """A hash of the ``q`` characters from each place."""
    n = max(0, len(points) - q + 1)
    hashes = np.zeros(n, np.uint64)
    for k in range(q):
        hashes *= np.uint64(0x9E3779B97F4A7C15)
        hashes += points[k : k + n]
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    return hashes


def fewest(size: int, most: int) -> int:
    """Runs of characters that an occurrence shares with the item at least."""
    return size - RUN + 1 - RUN * most


def runs_of(points: np.ndarray) -> np.ndarray:
    """The runs of characters, as small numbers that are not zero."""
    return np.maximum(seeds_of(points, RUN) >> np.uint64(48), np.uint64(1)).astype(np.uint16)


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@kept
@cache
def _kinds() -> np.ndarray:
    """For each code point 0 if it is between words, 1 if it is part of one, 2 if its script
    has no spaces."""
    return np.fromiter(((2 if unspaced(c) else 1) if (c := chr(i)).isalnum() else 0 for i in range(0x110000)), np.uint8, 0x110000)


def window_starts(points: np.ndarray) -> np.ndarray:
    """Where windows start: at the first character of a word, at every character of
    scripts without spaces, and at every one far into a very long word."""
    kinds = _kinds()[points]
    inside = kinds != 0
    first = inside & ~np.concatenate(([False], inside[:-1]))
    since = np.arange(len(points)) - np.maximum.accumulate(np.where(first, np.arange(len(points)), 0))
    return np.flatnonzero(first | (kinds == 2) | (inside & (since >= LONG_WORD))).astype(np.int32)


def step_codes(points: np.ndarray) -> np.ndarray:
    """For each place the classes of the next characters, as many as a lookup can read."""
    classes = ((points.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint16)
    classes = np.concatenate((classes, np.zeros(SPAN + STEPS, np.uint16)))
    codes = np.zeros(len(classes) - STEPS + 1, np.uint16)
    for k in range(STEPS):
        codes |= classes[k : k + len(codes)] << np.uint16(BITS * k)
    return codes


#: Characters a walk can read.
SPAN = max(steps for _, steps, _ in CLASSES)


class Walk:
    """One random walk, as tables over the classes of the next characters: the sampled
    steps' share of the key, and how far the walk goes on (the last two bits)."""

    def __init__(self, number: int):
        rng = np.random.default_rng(number)
        codes = np.arange(1 << (BITS * STEPS))
        ahead = np.stack([(codes >> (BITS * k)) & ((1 << BITS) - 1) for k in range(STEPS)])
        coins = rng.integers(0, 2, (SPAN, 1 << BITS))
        sampled, before = np.zeros(SPAN, bool), (0, 0)
        for _, steps, samples in CLASSES:
            sampled[before[0] + rng.choice(steps - before[0], samples - before[1], replace=False)] = True
            before = steps, samples
        values = rng.integers(0, 1 << 30, (SPAN, 1 << BITS))
        self.tables = []
        for begin in range(0, SPAN, STEPS):
            place, share = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
            for step in range(begin, begin + STEPS):
                read = np.take_along_axis(ahead, np.minimum(place, STEPS - 1)[None], 0)[0]
                if sampled[step]:
                    share += values[step][read]
                place += coins[step][read]
            self.tables.append(((share & ((1 << 30) - 1)) << 2 | place).astype(np.uint32))

    def keys(self, codes: np.ndarray, starts: np.ndarray, steps: set[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """After each number of ``steps`` the windows' keys, and where their walks are."""
        places, keys = starts.copy(), np.zeros(len(starts), np.uint32)
        for n, table in enumerate(self.tables[: max(steps) // STEPS], 1):
            share = table[codes[places]]
            keys += share >> np.uint32(2)
            places += (share & np.uint32(3)).view(np.int32)
            if n * STEPS in steps:
                yield n * STEPS, (keys * np.uint32(0x9E3779B1)).copy(), places


@kept
@cache
def walks() -> list[Walk]:
    return [Walk(n) for n in range(WALKS)]


def steps_of(size: int) -> int | None:
    """Steps of the windows of an item; None for one that seeds are to meet."""
    return next((steps for least, steps, _ in reversed(CLASSES) if size >= least), None)


class Table:
    """Hashes of one kind, sorted: of which item and at which place."""

    def __init__(self, hashes: list[np.ndarray], numbers: list[int], places: list[np.ndarray]):
        every = np.concatenate(hashes)
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.items = np.repeat(np.array(numbers, np.int32), [len(h) for h in hashes])[order]
        self.places = np.concatenate(places).astype(np.int32)[order]
        bits = min(26, len(every).bit_length() + 5)
        self.shift = every.dtype.type(8 * every.itemsize - bits)
        self.known = np.zeros(1 << bits, bool)
        self.known[every >> self.shift] = True

    def hits(self, hashes: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each hash that is met its item, its place, and where the item would begin."""
        met = np.flatnonzero(self.known[hashes >> self.shift])
        low = np.searchsorted(self.hashes, hashes[met], "left")
        times = np.searchsorted(self.hashes, hashes[met], "right") - low
        entries = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
        places = np.repeat(met if starts is None else starts[met].astype(np.int64), times)
        return self.items[entries].astype(np.int64), places, places - self.places[entries]


class Index:
    """The items with the keys of their windows, and the seeds of short ones."""

    def __init__(self, items: list[tuple[int, str]], edits: float = EDITS):
        self.items = items
        self.sizes = np.array([len(t) for _, t in items], np.int64)
        self.most = np.array([int(edits * len(t)) for _, t in items], np.int64)
        points = [points_of(t) for _, t in items]
        self.runs = [runs_of(p) for p in points]
        # All items' runs in a row, far enough apart; zero is no run.
        gap = np.zeros(2 * BESIDE, np.uint16)
        self.row = np.concatenate([gap, *[x for r in self.runs for x in (r, gap)]])
        self.bases = np.cumsum([len(gap), *[len(r) + len(gap) for r in self.runs[:-1]]])[: len(items)]
        self.seeds: dict[int, Table] = {}
        self.windows: dict[tuple[int, int], Table] = {}  # by walk and steps
        short: dict[int, list[int]] = {}
        long: dict[int, list[int]] = {}
        for number, size in enumerate(self.sizes.tolist()):
            if steps := steps_of(size):
                long.setdefault(steps, []).append(number)
            elif size:
                short.setdefault(seed_length(size, int(self.most[number]), edits), []).append(number)
        for q, numbers in sorted(short.items()):
            hashes = [seeds_of(points[n], q) for n in numbers]
            self.seeds[q] = Table(hashes, numbers, [np.arange(len(h)) for h in hashes])
        self.steps = set(long)
        for steps, numbers in sorted(long.items()):
            starts = [window_starts(points[n]) for n in numbers]
            codes = [step_codes(points[n]) for n in numbers]
            for walk, made in enumerate(walks()):
                found = [next(iter(made.keys(c, s, {steps}))) for c, s in zip(codes, starts)]
                # A walk that leaves the item reads what stands behind it.
                inside = [ends <= len(points[n]) for n, (_, _, ends) in zip(numbers, found)]
                kept = [(keys[i], s[i]) for (_, keys, _), i, s in zip(found, inside, starts)]
                self.windows[walk, steps] = Table([k for k, _ in kept], numbers, [s for _, s in kept])

    def tries(self, joined: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items, places where a window or seed of one is met, and where it would begin."""
        found = [table.hits(seeds_of(joined, q)) for q, table in self.seeds.items()]
        if self.steps:
            codes, starts = step_codes(joined), window_starts(joined)
            for at in range(0, len(starts), WINDOWS):
                some = starts[at : at + WINDOWS]
                for number, walk in enumerate(walks()):
                    found += [self.beside(*self.windows[number, steps].hits(keys, some), grams) for steps, keys, _ in walk.keys(codes, some, self.steps)]
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3

    def beside(self, numbers: np.ndarray, places: np.ndarray, begins: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hits around which enough of the item's runs stand about where they should."""
        kept = np.zeros(len(numbers), bool)
        for at in range(0, len(numbers), HITS):
            part = slice(at, at + HITS)
            mine = self.row[(self.bases[numbers[part]] + places[part] - begins[part])[:, None] + np.arange(-BESIDE, BESIDE)]
            near = grams[np.clip(places[part][:, None] + np.arange(-BESIDE - MOVED, BESIDE + MOVED), 0, len(grams) - 1)]
            met = np.zeros(mine.shape, bool)
            for moved in range(2 * MOVED + 1):
                met |= mine == near[:, moved : moved + 2 * BESIDE]
            kept[part] = met.sum(axis=1) >= FOUND * (mine != 0).sum(axis=1)
        return numbers[kept], places[kept], begins[kept]

    def search(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """For each normalized text its items: ``(item, distance, start, stop)``, the
        closest occurrence of each, places in characters of the normalized text."""
        gap = "\n" * SPAN  # no window reads two texts
        offsets = np.concatenate(([0], np.cumsum([len(t) + SPAN for t in texts]))).astype(np.int64)
        joined = points_of(gap.join([*texts, ""]))
        grams = runs_of(np.concatenate((joined, np.zeros(RUN, np.uint32))))
        hits: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        numbers, places, begins = self.tries(joined, grams)
        # One try for all windows and seeds of a text that mean about the same place.
        owners = np.searchsorted(offsets, places, "right") - 1
        firsts = (begins - offsets[owners]) // (self.most[numbers] + 1)
        low = int(firsts.min(initial=0))
        wide = int(firsts.max(initial=0)) - low + 1
        tries = np.unique((numbers * len(texts) + owners) * wide + firsts - low)
        pairs, firsts = tries // wide, tries % wide + low
        numbers, owners = pairs // len(texts), pairs % len(texts)
        cuts = np.flatnonzero(np.diff(numbers, prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(numbers)]):
            number = int(numbers[a])
            step = int(self.most[number]) + 1
            dense = self.dense(grams, number, firsts[a:b] * step + offsets[owners[a:b]])
            # Neighbouring tries of a text are verified together.
            run: list[int] | None = None
            for text, first in [*zip(owners[a:b][dense].tolist(), firsts[a:b][dense].tolist()), (-1, 0)]:
                if run and (text, first) == (run[0], run[2] + 1):
                    run[2] = first
                    continue
                if run:
                    self._verify(texts[run[0]], number, run[1] * step, run[2] * step, hits[run[0]])
                run = [text, first, first]
        return [[(number, *hit) for number, hit in sorted(found.items())] for found in hits]

    def dense(self, grams: np.ndarray, number: int, begins: np.ndarray) -> np.ndarray:
        """Around which places enough of the item's runs of characters stand: of its set
        of them in some span as long as an occurrence, and each where edits can have
        moved it."""
        size, most = int(self.sizes[number]), int(self.most[number])
        least, mine = fewest(size, most), self.runs[number]
        if least <= 0:
            return np.ones(len(begins), bool)
        own = np.zeros(1 << 16, bool)
        own[mine] = True
        span, width = size + most, size + 4 * most + 2
        kept = []
        for at in range(0, len(begins), max(1, AROUND // width)):
            some = begins[at : at + max(1, AROUND // width)]
            window = np.clip(some[:, None] + np.arange(-most - 1, width - most), 0, len(grams) - 1)
            sums = np.cumsum(own[grams[window]], axis=1, dtype=np.int32)
            most_of = (sums[:, span:] - sums[:, :-span]).max(axis=1)
            kept.append(np.maximum(most_of, sums[:, span - 1]) >= least)
        dense = np.concatenate(kept)
        places = np.flatnonzero(dense)
        # A try stands for the places up to ``most`` behind it.
        reach = 3 * most + 3
        for i in places.tolist():
            near = grams.take(np.arange(begins[i] - most - 1, begins[i] - most - 2 + len(mine) + reach), mode="clip")
            found = (np.ndarray((len(mine), reach), near.dtype, near, strides=(2, 2)) == mine[:, None]).any(axis=1)
            dense[i] = np.count_nonzero(found) >= least
        return dense

    def _verify(self, text: str, number: int, first: int, last: int, hits: dict) -> None:
        if number in hits and hits[number][0] == 0:
            return
        item, most = self.items[number][1], int(self.most[number])
        lo, hi = max(0, first - most - 2), min(len(text), max(0, last + len(item) + 3 * most + 3))
        if len(item) < BOUNDED:
            match = bounded_match(item, text, most, lo, hi)
        else:
            found = best_match(item, text[lo:hi], most)
            match = found and (found[0], max(0, lo + found[1] - len(item)), lo + found[1])
        if match and (number not in hits or match[0] < hits[number][0]):
            hits[number] = match


@kept
@lru_cache(1)
def _index(items: tuple[tuple[object, str], ...], edits: float) -> Index:
    """The index of a part of the items, made once in each worker."""
    return Index(list(items), edits)


def item_parts(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text") -> Iterator[list[tuple[object, str]]]:
    """The items, normalized, in parts of a bounded size, of which one is on the driver at
    a time. Null and empty items are nowhere."""
    items = benchmark.select(quoted(id_column).alias("item_id"), quoted(text_column).cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = -(-total // ITEM_BYTES)
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        pairs = sorted({(r["item_id"], normalize(r["text"])) for r in mine.toLocalIterator()}, key=str)
        if pairs := [(i, t) for i, t in pairs if t]:
            yield pairs


def scan(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", edits: float = EDITS) -> DataFrame:
    """``docs`` with ``hits``, an array of ``(item_id, distance, start, stop)``: the
    closest occurrence of each item within ``edits``, places in the normalized text.

    One row for each row. Null and empty texts have none. Items of fewer than
    ``BOUNDED`` characters have to begin and end between words. A column of ``docs`` called ``hits``
    is replaced. A benchmark of more than ``ITEM_BYTES`` takes several passes, each stored
    before the next part of it is read.
    """
    docs = docs.drop("hits")
    kinds = {f.name.lower(): f.dataType.simpleString() for f in benchmark.schema.fields}
    result, last = docs, None
    for items in item_parts(benchmark):
        if last is not None:
            result = written(last, "scanned")
        last = _scan_once(result, items, edits, text_column, kinds["item_id"], docs.schema, "hits" in result.columns)
    if last is None:
        empty = f"array<struct<item_id:{kinds['item_id']},distance:int,start:int,stop:int>>"
        return docs.withColumn("hits", F.array().cast(empty))
    return last


def _scan_once(
    docs: DataFrame, items: list[tuple[object, str]], edits: float, text_column: str, id_kind: str, schema: StructType, more: bool
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(tuple(items), edits)
        ids = [i for i, _ in index.items]
        kind = pa.list_(pa.struct([("item_id", item_kind), ("distance", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))
        for whole in batches:
            place, at = whole.schema.get_field_index(text_column), 0
            # Only the texts of a chunk are held as Python strings, and go on when it is searched.
            while at < whole.num_rows:
                texts, size = [], 0
                while at + len(texts) < whole.num_rows and size < CHUNK:
                    texts.append(normalize(whole.column(place)[at + len(texts)].as_py()))
                    size += max(1, len(texts[-1]))
                part, at = whole.slice(at, len(texts)), at + len(texts)
                rows = [[{"item_id": ids[n], "distance": d, "start": a, "stop": b} for n, d, a, b in found] for found in index.search(texts)]
                if more:
                    earlier = part.column(part.num_columns - 1).to_pylist()
                    rows = [a + b for a, b in zip(earlier, rows)]
                    part = part.select(part.schema.names[:-1])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, kind)], [*part.schema.names, "hits"])

    out = StructType.fromDDL(f"hits array<struct<item_id:{id_kind},distance:int,start:int,stop:int>>")
    item_kind = to_arrow_type(out["hits"].dataType.elementType["item_id"].dataType)
    return map_batches(docs, run, StructType([*schema.fields, *out.fields]))


def find(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", edits: float = EDITS) -> DataFrame:
    """``(doc_id, item_id, distance, start, stop)``: a row for each text and each item it
    holds. Other columns are left behind."""
    texts = docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    return scan(texts, benchmark, "text", edits).select("doc_id", F.inline("hits"))
