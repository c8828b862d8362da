"""The similarity join against brute force, with hot groups and hard cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from sieveline.llm import links
from sieveline.llm import ngram_join as nj
from tests.llm.corpus import frame, prose, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(text, n=5):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(rows, percent=80):
    """Smallest id reachable from each row over links, by union-find on the texts."""
    sets = [sets_of(t) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _, _) in enumerate(rows):
        known = [x for x in (least.get(find(i)), doc_id) if x is not None]
        least[find(i)] = min(known, default=None)
    return [(doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _, _) in enumerate(rows)]


@pytest.mark.parametrize("seed", [5, 6])
def test_components_of_a_corpus(spark, seed):
    rows = texts(seed)
    got = nj.link(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_chains_and_thresholds(spark):
    """Texts that are linked over others only; pairs just at and below the threshold."""
    base = [f"w{i}" for i in range(104)]  # 100 n-grams
    rows = []
    for k in range(8):  # each drops some n-grams of the one before
        rows.append((k, " ".join(base[6 * k : 6 * k + 84]), None))
    grams = lambda n, tail: " ".join([*base[: n + 4], *[f"{tail}{i}" for i in range(100 - n)]])
    rows += [(100, grams(100, "x").upper(), None), (101, grams(89, "y"), None), (102, grams(88, "z"), None)]
    got = sorted(tuple(r) for r in nj.link(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect())
    assert got == sorted(brute(rows))


def test_prefix_and_verification_agree_with_sets():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 60)
        a = np.unique(np.array(rng.choices(range(1 << 62), k=n), np.uint64))
        b = np.unique(np.concatenate((rng.sample(list(a), rng.randint(0, len(a))), np.array(rng.choices(range(1 << 62), k=rng.randint(0, 9)), np.uint64))).astype(np.uint64))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        link = 100 * both >= 80 * (len(a) + len(b) - both)
        assert nj.overlap_at_least(a, b) == link
        counts = np.random.default_rng(n).integers(1, 9, (nj.ROWS, nj.CELLS)).astype(np.uint32)
        pa, pb = (s[np.argsort(nj.weights(s, counts), kind="stable")][: nj.prefix_length(len(s))] for s in (a, b))
        assert not link or len(np.intersect1d(pa, pb))


def test_the_sketch_is_at_least_the_count_and_orders_rare_first(spark):
    """Summed over tasks; n-grams of one text alone are told from those of several."""
    rows = texts()
    found = nj.identify(nj.keyed_texts(frame(spark, rows, 5), "doc_id", "text"))
    counts, hashes, true = nj.summed_counts(found), nj.WordHashes(), Counter()
    for _, text, _ in rows:
        true.update(nj.shingles((text or "").encode(), hashes).tolist())
    grams = np.array(list(true), np.uint64)
    got, want = nj.weights(grams, counts), np.array(list(true.values()))
    assert (got >= want).all() and (got == want).mean() > 0.95
    assert nj.summed_counts(found.where("false")).sum() == 0


def test_repeated_and_null_ids_are_rows_of_their_own(spark, monkeypatch):
    """Many rows with one id, or none, make no more rows on any route."""
    sizes = {}

    def keep(df, purpose, write=nj.written):
        stored = write(df, purpose)
        sizes[purpose] = stored.count()
        return stored

    monkeypatch.setattr(nj, "written", keep)
    rng = random.Random(9)
    rows = [(None, prose(rng, 40), None) for _ in range(300)] + [(7, prose(rng, 40), None) for _ in range(300)] + [(8, "the same words again and again", None)] * 300
    got = nj.link(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)
    assert len(got) == 900 and sizes["profiles"] == 601


@pytest.mark.parametrize("rows_broadcast", [0, 1_000_000])
def test_a_large_group_of_near_copies(spark, monkeypatch, rows_broadcast):
    """Copies with edits at many places, of which many pairs are below the threshold: few
    of these become rows."""
    monkeypatch.setattr(links, "BROADCAST_ROWS", rows_broadcast)
    monkeypatch.setattr(links, "BLOCK_BYTES", 1 << 12)
    found, real = [], links.survivors

    def survivors(met, percent, nearest):
        found.append(real(met, percent, nearest).count())
        return real(met, percent, nearest)

    monkeypatch.setattr(links, "survivors", survivors)
    rng = random.Random(10)
    base = prose(rng, 150).split()
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.sample(range(len(words)), rng.randint(1, 14)):
            words[k] = f"q{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(words), None))
    got = nj.link(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)
    # Of 11,175 pairs.
    assert sum(found) < 3000


def test_keep_one(spark):
    rows = texts()
    docs = frame(spark, rows)
    kept = nj.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    want = {}
    for (doc_id, text, _), (_, size, component) in zip(rows, brute(rows)):
        if size == 0 or doc_id is None or component == doc_id:
            want.setdefault((doc_id, text, size == 0 or doc_id is None and len(want)), (doc_id, text))
    assert {x for x in got} == set(want.values()) and len([g for g in got if g[0] is not None]) == len({g for g in got if g[0] is not None})


def test_empty_table(spark):
    assert nj.link(frame(spark, texts()).where("false")).count() == 0
    only_empty = nj.link(frame(spark, [(1, None, None), (2, " ", None)])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in only_empty) == [(1, 0, 1), (2, 0, 2)]
