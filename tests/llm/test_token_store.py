"""Token shards: ids of the library, exact expansion, random access."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from sieveline.llm import token_store as ts
from sieveline.llm.queries import VOCABULARY
from sieveline.shared import new_folder
from tests.llm.corpus import frame, texts

LIBRARY = Tokenizer.from_file(VOCABULARY)
PARTS = ["ab", "é", "'s", " ", "\n", ",", ".", "<|endoftext|>", "İ", "Σ", "9", "ß", "漢", "...", "!!", "|", "AB", "ﬁ", "ª", "ŉ", "a'", "'ll", "́", "\x1c"]


def ids_of(text, end=2):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, end]


def test_ids_of_the_library():
    rng, encoder = random.Random(2), ts.LibraryEncoder(VOCABULARY, cached=100)
    for _ in range(1500):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 25)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(text)[:-1]


def sequences():
    rng = np.random.default_rng(1)
    phrase = rng.integers(0, 50, 40)
    yield np.concatenate([phrase] * 300)
    yield np.zeros(3000, np.int64)
    yield rng.integers(0, 3, 70_000)
    yield rng.integers(0, 40_000, 500)
    yield np.array([7])
    yield np.empty(0, np.int64)


@pytest.mark.parametrize("ids", list(sequences()), ids=lambda x: str(len(x)))
def test_grammar_expands_to_the_ids(ids):
    rng = np.random.default_rng(2)
    last = rng.random(len(ids)) < 0.01
    if len(ids):
        last[-1] = True
    grammar, symbols, ended = ts.compress(ids, last, 50_000)
    assert np.array_equal(grammar.expand(symbols, grammar.table()), ids)
    # Documents end where they did: no rule reaches over an end.
    assert np.array_equal(np.cumsum(grammar.lengths[symbols])[ended], np.flatnonzero(last) + 1)
    if len(ids) > 10_000 and ids.max() < 100:
        assert len(symbols) < len(ids) / 2


def sequential(ids, ends, width, least):
    """Re-Pair one pair at a time: rules and symbols of the most frequent pair first."""
    parts, rules = [list(p) for p in np.split(ids, np.flatnonzero(ends)[:-1] + 1)], 0
    while True:
        counts = Counter()
        for part in parts:
            before = None
            for k in range(len(part) - 1):
                pair = (part[k], part[k + 1])
                if pair == before and pair[0] == pair[1]:  # a run counts every other one
                    before = None
                    continue
                counts[pair] += 1
                before = pair
        pair, n = min(counts.items(), key=lambda x: (-x[1], x[0]), default=(None, 0))
        if n < least:
            return rules, sum(map(len, parts))
        for i, part in enumerate(parts):
            made, k = [], 0
            while k < len(part):
                if tuple(part[k : k + 2]) == pair:
                    made.append(width + rules)
                    k += 2
                else:
                    made.append(part[k])
                    k += 1
            parts[i] = made
        rules += 1


def small_shards():
    rng = np.random.default_rng(6)
    words = [rng.integers(0, 30, rng.integers(1, 5)) for _ in range(40)]
    yield np.concatenate([words[min(39, int(rng.exponential(9)))] for _ in range(1500)])
    yield np.concatenate([rng.integers(0, 50, 60)] * 25 + [rng.integers(0, 50, 400)])
    yield rng.integers(0, 4, 3000)
    yield np.zeros(700, np.int64)


@pytest.mark.parametrize("ids", list(small_shards()), ids=lambda x: str(len(x)))
def test_grammar_is_that_of_one_pair_at_a_time(ids):
    """In size: passes of pairs that are apart give the same grammar within a few percent."""
    last = np.zeros(len(ids), bool)
    last[::211] = last[-1] = True
    rules, symbols = sequential(ids, last, 50, 16)
    grammar, made, _ = ts.compress(ids, last, 50)
    assert 2 * len(grammar.left) + len(made) <= 1.05 * (2 * rules + symbols) + 8


def test_a_repeated_passage_is_one_symbol():
    ids = np.tile(np.arange(299), 300)
    last = np.zeros(len(ids), bool)
    last[-1] = True
    grammar, symbols, _ = ts.compress(ids, last, 300)
    assert len(grammar.left) <= 310 and len(symbols) <= 25
    assert np.array_equal(grammar.expand(symbols, grammar.table()), ids)


def test_shard_gives_documents_and_single_ids():
    rng = np.random.default_rng(3)
    lengths = np.array([5, 0, 1, 900, 0, 40, 900], np.int64)
    body = rng.integers(0, 9, 900)
    ids = np.concatenate((rng.integers(0, 9, 6), body, rng.integers(0, 9, 40), body))
    shard = ts.Shard(ts.pack_shard([3, 4, None, 9, 9, 10, 11], lengths, ids, 20))
    at = 0
    for k, n in enumerate(lengths):
        assert np.array_equal(shard.ids(k), ids[at : at + n])
        for j in range(0, n, 17):
            assert shard.token(k, j) == ids[at + j]
        at += n
    assert shard.known.tolist() == [1, 1, 0, 1, 1, 1, 1] 
    last = np.zeros(len(ids), bool)
    last[np.cumsum(lengths)[lengths > 0] - 1] = True
    assert len(shard.symbols) <= 1.05 * sequential(ids, last, 20, 16)[1] < len(ids)
    with pytest.raises(ValueError, match="not a shard"):
        ts.Shard(b"something else" * 10)


@pytest.mark.parametrize("shard_tokens", [2000, ts.SHARD_TOKENS])
def test_round_trip_of_a_corpus(spark, shard_tokens):
    rows = texts()
    manifest = ts.write_shards(frame(spark, rows), new_folder(spark, "t"), VOCABULARY, 2, shard_tokens)
    got = [tuple(r) for r in ts.read_shards(manifest).orderBy("start").collect()]
    assert [g[0] for g in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    start, by_id = 0, {}
    for doc_id, text, _ in rows:
        by_id.setdefault(doc_id, []).append((len(ids_of(text)), zlib.crc32(np.array(ids_of(text), "<u4"))))
    for doc_id, at, n, crc in got:
        assert at == start and (n, crc) in by_id[doc_id]
        by_id[doc_id].remove((n, crc))
        start += n
    assert not any(by_id.values())


def test_empty_table(spark):
    assert ts.store(spark, frame(spark, texts()).where("false"), VOCABULARY, 2).count() == 0


def test_slots_made_block_by_block_give_the_same_grammar(monkeypatch):
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 12, 6000).astype("<u4")
    last = rng.random(6000) < 0.02
    last[-1] = True
    whole = ts.compress(ids, last, 50)
    monkeypatch.setattr(ts, "BLOCK", 7)
    parts = ts.compress(ids, last, 50)
    assert len(whole[0].left) > 10 and np.array_equal(whole[0].left, parts[0].left) and np.array_equal(whole[0].right, parts[0].right)
    assert np.array_equal(whole[1], parts[1]) and np.array_equal(whole[2], parts[2])
    assert np.array_equal(parts[0].expand(parts[1], parts[0].table()), ids)


def test_pairs_are_counted_and_met_like_by_a_table():
    """Also where chosen pairs share a slot."""
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 3000, 60_000).astype(np.uint64) << np.uint64(32) | rng.integers(0, 400, 60_000).astype(np.uint64)
    pairs, times = ts._counted(keys)
    plain = Counter(keys.tolist())
    assert dict(zip(pairs.tolist(), times.tolist())) == plain and pairs.tolist() == sorted(plain)
    slots = ts._slots((keys >> np.uint64(32)).astype(np.uint32), keys.astype(np.uint32))
    of_pairs = ts._slots((pairs >> np.uint64(32)).astype(np.uint32), pairs.astype(np.uint32))
    crowded = np.flatnonzero(np.isin(of_pairs, [s for s, n in Counter(of_pairs.tolist()).items() if n > 1]))
    assert len(crowded) > 100
    chosen = pairs[rng.permutation(np.unique(np.concatenate((crowded, np.arange(0, len(pairs), 9)))))]
    place, which = ts._places(keys, slots, chosen)
    number = {p: k for k, p in enumerate(chosen.tolist())}
    assert list(zip(place.tolist(), which.tolist())) == [(i, number[k]) for i, k in enumerate(keys.tolist()) if k in number]


def test_documents_of_a_shard_are_decoded_together(monkeypatch):
    rng = np.random.default_rng(6)
    lengths = np.array([0, 5, 0, 300, 1, 0, 2, 40, 40, 0])
    ids = np.tile(rng.integers(0, 9, 97), 4).astype(np.uint32)
    shard = ts.Shard(ts.pack_shard(list(range(len(lengths))), lengths, ids, 10))
    for together in (1, 41, 1 << 16):
        monkeypatch.setattr(ts, "TOGETHER", together)
        assert [x.tolist() for x in shard.each()] == [shard.ids(k).tolist() for k in range(len(lengths))]
