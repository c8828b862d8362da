"""BPE against the tokenizers library; streaming against merging at once."""

import hashlib
import random
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from sieveline.llm import bpe
from sieveline.llm.queries import VOCABULARY
from tests.llm.corpus import frame, texts

LIBRARY = Tokenizer.from_file(VOCABULARY)
BPE = bpe.WordBpe(VOCABULARY)
ALPHABETS = [list("abcdefgh"), list("aeth"), list("aé漢İΣß̈  'sտ\x1c\x85<>|"), ["<|endoftext|>", "a", " ", "ing", "the", "'s", "é", "12", "\n"]]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def symbols(text):
    raw = text.encode()
    return [*[BPE.inner[b] for b in raw[:-1]], BPE.final[raw[-1]]]


@pytest.mark.parametrize("alphabet", ALPHABETS, ids=range(4))
def test_ids_and_pieces_of_the_library(alphabet):
    rng, encoder, decoder = random.Random(1), bpe.Encoder(BPE, cached_words=50), bpe.Decoder(BPE)
    for _ in range(400):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        assert encoder.ids(text) == ids_of(text)
        assert decoder.text(ids_of(text)) == LIBRARY.decode(ids_of(text), skip_special_tokens=False)


@pytest.mark.parametrize("alphabet", ["aeth", "ab", "inthgofer", "abcdefgh"])
def test_streamed_word_is_the_word(alphabet):
    """Tokens that are emitted early are those of the whole word, with the smallest buffer."""
    rng = random.Random(2)
    for _ in range(25):
        word = "".join(rng.choices(alphabet, k=rng.randint(300, 1500)))
        parts = [word[i : i + 37] for i in range(0, len(word), 37)]
        assert list(BPE.stream_word(parts, buffer=16)) == BPE.merge(symbols(word))


def test_stream_holds_no_more_than_buffer_and_lookahead(monkeypatch):
    sizes, merge = [], bpe.WordBpe.merge
    monkeypatch.setattr(bpe.WordBpe, "merge", lambda self, held: sizes.append(len(held)) or merge(self, held))
    count = sum(1 for _ in BPE.stream_word(("ab" * 500 for _ in range(100)), buffer=256))
    assert count > 1000 and max(sizes) <= 2 * (256 + BPE.lookahead)


def test_lookahead_is_sufficient_for_small_lists():
    """The first token is decided by so many symbols, for all texts over three letters."""
    import itertools

    a, b, c = range(3)
    pairs, made = [(b, c), (a, b), (3, a), (4, c)], [3, 4, 5, 6]
    tool = bpe.WordBpe.__new__(bpe.WordBpe)
    tool.width, tool.results = 10, made
    tool.ranks = {x * 10 + y: r for r, (x, y) in enumerate(pairs)}
    need = bpe.sufficient_lookahead(pairs, made, {a, b, c})
    seen = {}
    for n in range(1, 9):
        for text in itertools.product(range(3), repeat=n):
            if n >= need:
                first = tool.merge(list(text))[0]
                assert seen.setdefault(text[:need], first) == first


def test_decoder_turns_bytes_back():
    decoder, encoder = bpe.Decoder(BPE, joined=False), bpe.Encoder(BPE)
    assert decoder.text(encoder.ids("Hello  wörld 漢字")) == "hello wörld 漢字 "
    split = encoder.ids("漢")
    assert len(split) > 1 and list(decoder.stream(split, batch=1))[:-2] == [""] * (len(split) - 1)
    assert decoder.text(split[:-1]) == "�" and decoder.text([]) == ""


def test_round_trip_of_a_corpus(spark):
    rows = texts()
    got = sorted(map(tuple, bpe.round_trip(frame(spark, rows), VOCABULARY).collect()), key=str)
    want = []
    for doc_id, text, _ in rows:
        ids = ids_of(text)
        pieces = LIBRARY.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), pieces)]
        want.append((doc_id, len(ids), *digests))
    assert got == sorted(want, key=str)


def test_encode_and_decode_frames(spark):
    docs = frame(spark, [(1, "Ab  c", None), (2, None, None), (2, "", None)])
    encoded = bpe.encode(docs, VOCABULARY)
    assert sorted((r.doc_id, r.ids) for r in encoded.collect()) == [(1, ids_of("ab c")), (2, []), (2, [])]
    assert sorted((r.doc_id, r.text) for r in bpe.decode(encoded, VOCABULARY).collect()) == [(1, "ab c "), (2, ""), (2, "")]
    assert bpe.round_trip(docs.where("false"), VOCABULARY).count() == 0


def test_code_points_that_python_does_not_know():
    """Word classes and cases are the library's, also of letters newer than Python's tables."""
    rng = random.Random(6)
    newer = [c for c in map(chr, range(0x370, 0x33000)) if unicodedata.category(c) == "Cn" and regex.match(r"[\p{L}\p{N}\p{M}\p{S}\p{P}]", c)]
    named = ["\u0558", "\u088f", "\u0c5c", "\u1c89", "\ua7cb"]
    others = [chr(rng.choice([*range(0x80, 0xD800), *range(0xE000, 0x30000)])) for _ in range(4000)]
    encoder = bpe.Encoder(BPE)
    assert len(newer) > 1000
    for start in range(0, len(newer) + len(others), 50):
        text = " ".join(f"aB{c}Ab {c}{c}'s1" for c in [*named, *newer, *others][start : start + 50])
        assert encoder.ids(text) == ids_of(text)


def test_long_pieces_are_read_in_parts(monkeypatch):
    """Texts without white space: parts end within words of letters, and words go on."""
    monkeypatch.setattr(bpe, "CHUNK", 40)
    monkeypatch.setattr(bpe, "BUFFER", 16)
    rng, parts = random.Random(8), ["abcdefgh", "Letters", "\u6f22\u5b57" * 4, "'s", "'ll", "12", "!?", "\u00e9\u0301", "<|endoftext|>", "don't", "\u039f\u03a3"]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=rng.randint(0, 60))) + rng.choice(["", " x"])
        encoder = bpe.Encoder(BPE, cached_words=10)
        assert encoder.ids(text) == ids_of(text)


def test_memory_does_not_grow_with_the_text():
    """What encoding, digests and decoding hold besides the text itself."""

    def peak(n):
        text = "some words of it, and-" * n
        encoder, decoder = bpe.Encoder(BPE), bpe.Decoder(BPE)
        tracemalloc.start()
        count = sum(len(x) for x in decoder.stream(i for ids in encoder.stream(text.replace(" ", "")) for i in ids))
        size = tracemalloc.get_traced_memory()[1] - len(text)
        tracemalloc.stop()
        return size, count

    (small, some), (large, more) = peak(8_000), peak(40_000)
    assert more > 4.9 * some and large < 1.5 * small + 2_000_000


@pytest.mark.parametrize("alphabet", ALPHABETS, ids=range(4))
def test_words_merged_together_are_those_merged_alone(alphabet):
    rng = random.Random(7)
    words = ["".join(rng.choices(alphabet, k=rng.randint(1, 60))).encode() for _ in range(300)]
    alone = [tuple(BPE.merge([*[BPE.inner[b] for b in w[:-1]], BPE.final[w[-1]]])) for w in words]
    assert BPE.merge_together(words) == alone


@pytest.mark.parametrize("cached", [40, 100_000])
def test_learned_texts_have_the_ids_of_the_library(cached):
    rng, encoder = random.Random(8), bpe.Encoder(BPE, cached_words=cached)
    found = ["".join(rng.choices(a, k=rng.randint(0, 80))) for a in ALPHABETS for _ in range(60)] + [None, "", "\u0378a \u1c89b"]
    ids = [encoder.ids(t) for t in bpe.learned(encoder, pa.array(found, pa.string()))]
    assert ids == [ids_of(t) for t in found]
    encoder.forget()
    assert not encoder.of_piece and not encoder.of_word


def test_learned_words_are_not_merged_one_by_one(monkeypatch):
    """Short words of a few texts are merged in arrays, at once."""
    encoder = bpe.Encoder(BPE)
    monkeypatch.setattr(bpe.WordBpe, "merge", lambda self, held: pytest.fail("merged alone"))
    found = [f"word{k} some other{k}, 'quoted'" for k in range(50)]
    assert [encoder.ids(t) for t in bpe.learned(encoder, pa.array(found))] == [ids_of(t) for t in found]
