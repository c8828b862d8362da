"""BPE encoding and decoding as streaming transducers.

Encoding reads a text piece by piece. Word by word the merges are applied; a word
longer than the buffer is emitted token by token as soon as the tokens are stable,
that is, as soon as the buffer holds the merge list's *sufficient lookahead* after a
token's start: so many bytes decide the first token of any word. The rest of the
word is then encoded as a word of its own, which gives the same tokens, because no
merge has crossed a boundary between two final tokens. Memory is therefore bounded
by the buffer and the (bounded) cache of words, however long a text or word is.

Decoding maps ids to the bytes of their tokens and bytes to text with an incremental
UTF-8 state machine, which keeps the bytes of an unfinished character only.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import batched, chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sieveline.llm.common import kept, keyed_texts, map_batches

#: Words a worker remembers; at this number it forgets them all.
CACHED_WORDS = 300_000
#: Symbols of an unfinished word that are merged at once, besides the lookahead.
BUFFER = 256
#: Characters of a text that are normalized at once, and of the texts whose new words are merged together.
CHUNK = 1 << 16
BATCH = 1 << 20
#: Symbols of a word that is merged together with others, and the step of the widths they are put in.
TOGETHER, WIDTH_STEP = 48, 4
# Between the last two letters of these no word ends, nothing is composed and no pattern looks back.
INSIDE = regex.compile("[a-zA-Z]{5}|[\u4e00-\u9fa5]{5}")
# White space of the vocabulary's patterns, and the pattern of its words.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECES = regex.compile(rf"[{WHITE}]+")
BREAK = "\n"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary: itself
    where it is printable, else the next one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, following = [""] * 256, 256
    for b in range(256):
        if b in own:
            letters[b] = chr(b)
        else:
            letters[b], following = chr(following), following + 1
    return letters


class WordBpe:
    """A vocabulary file of the kind lower-case BPE with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ends = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = [""] * (1 + max([*vocab.values(), *self.specials.values()]))
        for piece, i in [*vocab.items(), *self.specials.items()]:
            self.pieces[i] = piece
        self.word_end = ends
        letters = byte_letters()
        self.path, self.library = path, None
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + ends] for c in letters]
        self.width = len(self.pieces)
        # Rank of a pair, and by rank the token it becomes.
        self.ranks: dict[int, int] = {}
        self.results: list[int] = []
        self.pairs: list[tuple[int, int]] = []
        for left, right in map(lambda m: m if isinstance(m, list) else m.split(" "), model["merges"]):
            a, b = vocab[left], vocab[right]
            self.ranks.setdefault(a * self.width + b, len(self.results))
            self.results.append(vocab[left + right])
            self.pairs.append((a, b))
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.specials)) or r"(?!)")
        self.word_pattern = regex.compile(WORDS)
        self.broken_pattern = regex.compile(f"{WORDS}|{BREAK}")
        # The same as arrays: the pairs in ascending order and their ranks; ids as shared numbers.
        self.numbers = np.array(range(self.width + 1), object)
        self.keys = np.array(sorted(self.ranks), np.int64)
        self.key_ranks = np.array([self.ranks[k] for k in self.keys.tolist()], np.int32)
        self.made = np.array(self.results, np.int32)
        self.symbols = np.array([self.inner, self.final], np.int32)
        self.lookahead = sufficient_lookahead(self.pairs, self.results, {*self.inner, *self.final})

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the merges: lowest rank first, leftmost first among equals."""
        return self._merge_short(symbols) if len(symbols) < 100 else self._merge_long(symbols)

    def _merge_short(self, symbols: list[int]) -> list[int]:
        rank, width, none = self.ranks.get, self.width, len(self.results)
        at = [rank(a * width + b, none) for a, b in zip(symbols, symbols[1:])]
        while at:
            best = min(at)
            if best == none:
                break
            i = at.index(best)
            symbols[i : i + 2] = [self.results[best]]
            del at[i]
            if i:
                at[i - 1] = rank(symbols[i - 1] * width + symbols[i], none)
            if i < len(at):
                at[i] = rank(symbols[i] * width + symbols[i + 1], none)
        return symbols

    def _merge_long(self, symbols: list[int]) -> list[int]:
        rank, width, n = self.ranks.get, self.width, len(symbols)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        for i in range(n - 1):
            if (r := rank(symbols[i] * width + symbols[i + 1])) is not None:
                queue.append((r, i))
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            j = right[i]
            # Stale entries: the pair at this place has become another one.
            if symbols[i] < 0 or j < 0 or rank(symbols[i] * width + symbols[j]) != r:
                continue
            symbols[i], symbols[j] = self.results[r], -1
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (r := rank(symbols[i] * width + symbols[k])) is not None:
                    heapq.heappush(queue, (r, i))
            if (k := left[i]) >= 0 and (r := rank(symbols[k] * width + symbols[i])) is not None:
                heapq.heappush(queue, (r, k))
        return [s for s in symbols if s >= 0]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, the number of merges where there is none."""
        wanted = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.key_ranks[at], np.int32(len(self.made)))

    def merge_together(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of words that are in the buffer to their ends, all of them merged at once: in
        each round every word has its lowest rank applied where it is leftmost."""
        found: list[tuple[int, ...]] = [()] * len(words)
        groups: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) <= TOGETHER:
                groups.setdefault(-(-len(word) // WIDTH_STEP) * WIDTH_STEP, []).append(i)
            else:
                found[i] = tuple(self.merge([*map(self.inner.__getitem__, word[:-1]), self.final[word[-1]]]))
        for width, group in groups.items() if len(self.made) else ():
            lengths = np.array([len(words[i]) for i in group])
            raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in group), np.uint8).reshape(-1, width)
            cells = np.arange(width)
            symbols = np.where(cells < lengths[:, None] - 1, self.symbols[0][raw], self.symbols[1][raw])
            # Behind a word's end stands a symbol that is in no pair.
            symbols[cells >= lengths[:, None]] = self.width
            ranks = np.full((len(group), width), len(self.made), np.int32)
            inside = cells[:-1] < lengths[:, None] - 1
            ranks[:, :-1][inside] = self.ranks_of(symbols[:, :-1][inside], symbols[:, 1:][inside])
            rows = np.arange(len(group))
            while len(rows):
                every = np.arange(len(rows))
                at = ranks.argmin(axis=1)
                best = ranks[every, at]
                go = best < len(self.made)
                if not go.all():
                    done = ~go
                    for row, ids, n in zip(rows[done].tolist(), self.numbers[symbols[done]].tolist(), lengths[done].tolist()):
                        found[group[row]] = tuple(ids[:n])
                    rows, at, best, lengths, symbols, ranks = rows[go], at[go], best[go], lengths[go], symbols[go], ranks[go]
                    every = np.arange(len(rows))
                    if not len(rows):
                        break
                symbols[every, at] = self.made[best]
                # What stands behind the merged two moves one place to the left.
                source = np.arange(symbols.shape[1] - 1)
                source = source + (source > at[:, None])
                symbols = np.take_along_axis(symbols, source, 1)
                ranks = np.take_along_axis(ranks, source, 1)
                lengths = lengths - 1
                before, behind = np.flatnonzero(at > 0), np.flatnonzero(at < lengths - 1)
                ranks[every, at] = len(self.made)
                ranks[before, at[before] - 1] = self.ranks_of(symbols[before, at[before] - 1], symbols[before, at[before]])
                ranks[behind, at[behind]] = self.ranks_of(symbols[behind, at[behind]], symbols[behind, at[behind] + 1])
        return found

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of a word that is at hand as a whole."""
        return tuple(self.stream_word([word]))

    def stream_word(self, parts: Iterable[str], buffer: int = BUFFER) -> Iterator[int]:
        """Ids of one word that arrives in parts, each emitted once it is stable: when the
        lookahead behind it is there, or the word ends."""
        held: list[int] = []
        last = -1
        for part in parts:
            raw = part.encode("utf-8", "surrogatepass")
            for start in range(0, len(raw), buffer):
                piece = raw[start : start + buffer]
                # The last byte so far may end the word, so it is held apart.
                if last >= 0:
                    held.append(self.inner[last])
                held.extend(self.inner[b] for b in piece[:-1])
                last = piece[-1]
                if len(held) >= buffer + self.lookahead:
                    stable, used = [], 0
                    for token in self.merge(held[:]):
                        if used + self.lookahead > len(held):
                            break
                        stable.append(token)
                        used += self.length(token)
                    yield from stable
                    held = held[used:]
        if last >= 0:
            yield from self.merge([*held, self.final[last]])

    def length(self, token: int) -> int:
        """Bytes of a token."""
        piece = self.pieces[token]
        return len(piece) - len(self.word_end) * (len(piece) > len(self.word_end) and piece.endswith(self.word_end))

    def words(self, text: str) -> list[str]:
        """Normalized words of a text without special tokens."""
        if not text.isascii():
            if _unknown().search(text):
                return self.library_words(text)
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.word_pattern.findall(text.lower())

    def words_of_each(self, parts: list[str]) -> Iterator[list[str]]:
        """``words`` of each of several texts without white space, normalized together."""
        text = BREAK.join(parts)
        if not text.isascii():
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            if _unknown_points()[points].any():
                yield from map(self.words, parts)
                return
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        held: list[str] = []
        for word in self.broken_pattern.findall(text.lower()):
            if word == BREAK:
                yield held
                held = []
            else:
                held.append(word)
        yield held

    def library_words(self, text: str) -> list[str]:
        """The same by the library's own tables, for code points that Python does not know."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, word)).decode("utf-8", "surrogatepass") for word, _ in found]

    def stream_piece(self, piece: str) -> Iterator[int]:
        """Ids of text without white space and special tokens, of any length, part by part."""
        cuts, at = [0], CHUNK
        while found := INSIDE.search(piece, at):
            cuts.append(found.end() - 1)
            at = found.end() + CHUNK
        cuts.append(len(piece))

        def parts() -> Iterator[tuple[int, str]]:
            number = 0
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                for place, word in enumerate(self.words(piece[a:b])):
                    number += k == 0 or place > 0  # else it goes on with the last word
                    yield number, word

        for _, word in groupby(parts(), key=itemgetter(0)):
            yield from self.stream_word(part for _, part in word)


class Known(dict):
    """A bounded memory of a function's results, forgotten as a whole when full."""

    def __init__(self, function, size: int, longest: int = 256):
        self.function, self.size, self.longest = function, size, longest

    def __missing__(self, key: str):
        result = self.function(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.clear()
            self[key] = result
        return result


class Encoder:
    """Texts to ids, with a bounded memory of words and of the pieces of text between
    white space. Nothing crosses white space but special tokens do not hold any."""

    def __init__(self, bpe: WordBpe, cached_words: int = CACHED_WORDS):
        self.bpe = bpe
        self.of_word = Known(bpe.word_ids, cached_words)
        self.of_piece = Known(self.piece_ids, cached_words)

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        bpe, of_word = self.bpe, self.of_word
        if not any(s in piece for s in bpe.specials):
            return tuple(chain.from_iterable(map(of_word.__getitem__, bpe.words(piece))))
        ids: list[int] = []
        start = 0
        for found in bpe.special_pattern.finditer(piece):
            ids += self.piece_ids(piece[start : found.start()])
            ids.append(bpe.specials[found.group()])
            start = found.end()
        ids += self.piece_ids(piece[start:])
        return tuple(ids)

    def learn(self, texts: Iterable[str | None]) -> None:
        """Remember the pieces of some texts that are not known yet: their new words, as they
        are in the buffer as a whole, are merged together. Not needed for any result."""
        fresh = set().union(*map(pieces, filter(None, texts)))
        if len(self.of_piece) + len(fresh) > self.of_piece.size:
            fresh = fresh.difference(self.of_piece)
            if len(self.of_piece) + len(fresh) > self.of_piece.size:
                self.of_piece.clear()
        fresh = [p for p in fresh if p not in self.of_piece and len(p) <= self.of_piece.longest]
        if len(fresh) > self.of_piece.size:
            return
        fresh = [p for p in fresh if not any(s in p for s in self.bpe.specials)]
        if not fresh:
            return
        words = list(self.bpe.words_of_each(fresh))
        of_word = self.of_word
        new = [w for w in set(chain.from_iterable(words)) if w not in of_word and len(w) <= of_word.longest]
        if len(of_word) + len(new) > of_word.size:
            of_word.clear()
            new = [w for w in set(chain.from_iterable(words)) if len(w) <= of_word.longest]
        if len(new) <= of_word.size:
            of_word.update(zip(new, self.bpe.merge_together([w.encode("utf-8", "surrogatepass") for w in new])))
        for piece, its in zip(fresh, words):
            # A piece of one word shares its ids.
            self.of_piece[piece] = of_word[its[0]] if len(its) == 1 else tuple(chain.from_iterable(map(of_word.__getitem__, its)))

    def forget(self) -> None:
        """Drop what was remembered. A worker serves tasks of other stages too."""
        self.of_piece.clear()
        self.of_word.clear()

    def stream(self, text: str | None) -> Iterator[list[int]]:
        """Ids of a text in lists of a bounded size; none for null. Strings of special
        tokens are those tokens."""
        for part in chunks(text or ""):
            if len(part) <= CHUNK:
                if len(part) > CHUNK // 4:
                    self.learn([part])
                yield list(chain.from_iterable(map(self.of_piece.__getitem__, pieces(part))))
                continue
            for piece in pieces(part):
                yield from batched(self.long_piece(piece), CHUNK)

    def long_piece(self, piece: str) -> Iterator[int]:
        """Ids of a piece of any length, as they become certain."""
        start = 0
        for found in self.bpe.special_pattern.finditer(piece):
            yield from self.bpe.stream_piece(piece[start : found.start()])
            yield self.bpe.specials[found.group()]
            start = found.end()
        yield from self.bpe.stream_piece(piece[start:])

    def ids(self, text: str | None) -> list[int]:
        """All ids of a text."""
        return list(chain.from_iterable(self.stream(text)))


@lru_cache(maxsize=1)
def _unknown_points() -> np.ndarray:
    """By code point, whether Python's tables do not have it."""
    return np.fromiter((unicodedata.category(chr(i)) == "Cn" for i in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1)
def _unknown() -> regex.Pattern:
    """The code points that Python's tables do not have."""
    edges = np.flatnonzero(np.diff(_unknown_points(), prepend=False, append=False))
    ranges = zip(edges[::2].tolist(), (edges[1::2] - 1).tolist())
    return regex.compile("[" + "".join(f"{regex.escape(chr(a))}-{regex.escape(chr(b))}" for a, b in ranges) + "]")


def chunks(text: str) -> Iterator[str]:
    """A text cut behind white space, into parts of ``CHUNK`` characters at most where
    there is such a place."""
    start = 0
    while len(text) - start > CHUNK:
        cut = max(text.rfind(" ", start, start + CHUNK), text.rfind("\n", start, start + CHUNK))
        if cut < 0:
            following = [i for i in (text.find(" ", start), text.find("\n", start)) if i >= 0]
            cut = min(following, default=len(text) - 1)
        yield text[start : cut + 1]
        start = cut + 1
    yield text[start:] if start else text


def pieces(text: str) -> list[str]:
    """What stands between white space. ``str.split`` also cuts at four control
    characters that are none to the vocabulary."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [p for p in PIECES.split(text) if p]
    return text.split()


class Decoder:
    """Ids to text, id by id. ``joined`` gives the vocabulary's own pieces with a
    space between two of them; otherwise bytes are turned back into characters and
    word ends into spaces. Bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, bpe: WordBpe, joined: bool = True):
        self.joined = joined
        special = set(bpe.specials.values())
        value = {c: b for b, c in enumerate(byte_letters())}
        self.bytes_of: list[bytes] = []
        for i, piece in enumerate(bpe.pieces):
            if joined or i in special:
                self.bytes_of.append(piece.encode())
            else:
                ended = piece.endswith(bpe.word_end) and len(piece) > len(bpe.word_end)
                letters = piece[: -len(bpe.word_end)] if ended else piece
                self.bytes_of.append(bytes(value[c] for c in letters) + b" " * ended)

    def stream(self, ids: Iterable[int], batch: int = 8192) -> Iterator[str]:
        """Text of the ids as it becomes certain."""
        return self.stream_lists(batched(ids, batch))

    def stream_lists(self, lists: Iterable[Sequence[int]]) -> Iterator[str]:
        """The same of ids that come in lists."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        separator, bytes_of, first = (b" " if self.joined else b""), self.bytes_of.__getitem__, True
        for ids in lists:
            if ids:
                yield machine.decode((b"" if first else separator) + separator.join(map(bytes_of, ids)))
                first = False
        yield machine.decode(b"", True)

    def text(self, ids: Iterable[int]) -> str:
        return "".join(self.stream(ids))


def sufficient_lookahead(pairs: list[tuple[int, int]], results: list[int], symbols: set[int]) -> int:
    """So many symbols from its start on decide the first token of any text.

    Whether rule ``(u, v)`` applies depends on what stands to its right only by rules
    of lower rank that take away ``v``, ``u`` or a part of them from the left, and
    these on what they need in turn. Ranks fall along such a chain, so one pass in
    rank order gives each rule's need behind its right end.
    """
    length = dict.fromkeys(symbols, 1)
    need: dict[int, int] = {}  # by token: behind its end, to know that it forms
    reach: dict[int, int] = {}  # by left part: behind it, to know whether a rule takes it
    for (u, v), made in zip(pairs, results):
        length[made] = length[u] + length[v]
        behind_v = max(need.get(v, 0), reach.get(v, 0))
        behind_u = max(need.get(u, 0), reach.get(u, 0)) - length[v]
        mine = max(behind_v, behind_u, 0)
        need[made] = max(need.get(made, 0), mine)
        reach[u] = max(reach.get(u, 0), length[v] + mine)
    return max(length[t] + max(need.get(t, 0), reach.get(t, 0)) for t in length)


def learned(encoder: Encoder, column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, a few at a time, after the encoder has met their words. Long
    ones are met part by part when they are encoded."""
    held: list[str | None] = []
    size = 0
    for value in column:
        held.append(value.as_py())
        size += len(held[-1] or "")
        if size >= BATCH:
            encoder.learn(t for t in held if t and len(t) <= CHUNK)
            yield from held
            held, size = [], 0
    encoder.learn(t for t in held if t and len(t) <= CHUNK)
    yield from held


@kept
@lru_cache(maxsize=2)
def _tools(path: str) -> tuple[Encoder, Decoder]:
    """One encoder and decoder for each vocabulary in a worker."""
    bpe = WordBpe(path)
    return Encoder(bpe), Decoder(bpe)


@kept
@lru_cache(maxsize=2)
def _decimals(n: int) -> list[str]:
    return [str(i) for i in range(n)]


def encode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the ids of each whole text, none for null or empty ones.

    One row for each row, repeated ids included. Other columns are left behind.
    ``vocabulary`` is a path that every executor has.
    """
    texts = keyed_texts(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _tools(vocabulary)
        for batch in batches:
            ids = [encoder.ids(t) for t in learned(encoder, batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        encoder.forget()

    kind = texts.schema["doc_id"].dataType.simpleString()
    return map_batches(texts, run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, joined: bool = False) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(_tools(vocabulary)[0].bpe, joined)
        for batch in batches:
            texts = [decoder.text(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_batches(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode and decode each text in one pass and return digests of both:
    ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``. The digests are of the decimal
    ids joined by a space and of the joined pieces; null counts as empty. Ids and decoded
    text are never held as a whole, however long the text is."""
    texts = keyed_texts(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _tools(vocabulary)
        decimal = _decimals(encoder.bpe.width).__getitem__
        for batch in batches:
            counts, ids_digests, text_digests = [], [], []
            for text in learned(encoder, batch.column("text")):
                count, digest, text_digest = 0, hashlib.sha256(), hashlib.sha256()

                def emitted(text: str | None) -> Iterator[Sequence[int]]:
                    """The ids, counted and digested on their way to the decoder."""
                    nonlocal count
                    for ids in encoder.stream(text):
                        if ids:
                            digest.update((" " * (count > 0) + " ".join(map(decimal, ids))).encode())
                            count += len(ids)
                            yield ids

                for decoded in decoder.stream_lists(emitted(text)):
                    text_digest.update(decoded.encode())
                counts.append(count)
                ids_digests.append(digest.hexdigest())
                text_digests.append(text_digest.hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(text_digests)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        encoder.forget()

    kind = texts.schema["doc_id"].dataType.simpleString()
    return map_batches(texts, run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
