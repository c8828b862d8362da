"""Fuzzy line dedup against brute force; recall of the bands."""

import random
from functools import cache

import numpy as np

from sieveline.llm import line_dedup as ld
from tests.llm.corpus import frame, near, prose, texts


@cache
def shingles(line):
    text = line.decode()
    return frozenset(text[i : i + 8] for i in range(len(text) - 7)) or frozenset([text])


def similar(a, b):
    """Jaccard over the texts of all shingles of eight characters."""
    x, y = shingles(a), shingles(b)
    return 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y)


def brute(rows):
    """Places that go, by document and text: all pairs of lines are compared."""
    lines = []
    for doc_id, text, _ in rows:
        for place, raw in enumerate((text or "").encode().split(b"\n")):
            if len(norm := ld.normalize(raw)) >= ld.MIN_BYTES:
                lines.append((doc_id is None, doc_id, place, text, norm))
    distinct = list({x[4] for x in lines})
    root = {n: n for n in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if similar(a, b):
                root[find(a)] = find(b)
    groups = {}
    for x in lines:
        groups.setdefault(find(x[4]), []).append(x)
    gone = {}
    for group in groups.values():
        order = lambda x: (x[0], x[1] if x[1] is not None else -1, x[2], _hash(x[3]))
        first = min(group, key=order)
        for x in group:
            if order(x) != order(first):
                gone.setdefault((x[1], x[3]), set()).add(x[2])
    return {k: sorted(v) for k, v in gone.items()}


def _hash(text):
    from sieveline.llm.common import text_hash

    return text_hash(text.encode())


def corpus():
    rng = random.Random(8)
    rows = [r for r in texts() if r[1] is None or len(r[1]) < 20_000]
    license_line = "Use of this text is subject to the terms that are given with it, version "
    rows += [(900 + i, prose(rng, 30) + "\n" + license_line + str(i % 3) + ".0\n" + prose(rng, 20), "en") for i in range(30)]
    long_line = " ".join(prose(rng, 90).split())
    return rows + [(950 + i, near(rng, long_line, i % 4), "en") for i in range(8)]


def test_corpus(spark):
    rows = corpus()
    got = ld.deduplicate(frame(spark, rows)).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    texts_of = {}
    for doc_id, text, _ in rows:
        texts_of.setdefault(doc_id, []).append(text)
    found = 0
    for r in got:
        originals = [t for t in texts_of[r.doc_id] if len((t or "").split("\n")) == r.n_lines or t is None]
        fits = []
        for t in originals:
            gone = want.get((r.doc_id, t), [])
            stays = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
            fits.append((r.text, r.removed, r.n_removed) == (stays, gone, len(gone)))
        assert any(fits), (r.doc_id, r.removed, [want.get((r.doc_id, t)) for t in originals])
        found += r.n_removed
    assert found > 60


def test_bands_reach_the_recall():
    rng = random.Random(3)
    pairs = found = 0
    while pairs < 300:
        a = " ".join(prose(rng, rng.randint(12, 80)).split()).encode()
        b = near(rng, a.decode(), rng.randint(1, 2)).encode()
        if len(a) < 60 or not ld.similar(a, b):
            continue
        pairs += 1
        (x, y), sizes = ld.signatures([a, b])
        assert sizes == [len(ld.grams_of(a)), len(ld.grams_of(b))]
        found += bool((x == y).any())
    assert found >= 0.98 * pairs


def test_unrelated_lines_share_no_band():
    rng = random.Random(4)
    lines = [ld.normalize(" ".join(prose(rng, 30).split()).encode()) for _ in range(300)]
    lines = [x for x in lines if len(x) >= ld.MIN_BYTES]
    keys, _ = ld.signatures(lines)
    assert len(np.unique(keys)) > 0.99 * keys.size


def test_empty_table_and_names(spark):
    docs = frame(spark, texts())
    assert ld.deduplicate(docs.where("false")).count() == 0
    kept = ld.apply_removals(docs, ld.removals(docs))
    assert kept.columns == [*docs.columns, "removed"] and kept.count() == docs.count()


def test_short_lines(spark):
    """Exact copies go at any length, also below a shingle; a copy leaves no remnant."""
    long_line = " ".join(prose(random.Random(5), 30).split())
    whole = f"Menu\n\n{long_line}\n\u4f60\u597d\uff0c\u4e16\u754c\u3002\na\nRead all of it here"
    rows = [(1, whole, "en"), (2, whole, "en"), (3, f"{whole}\nMenus", "en"), (4, "  MENU\nb\n \nb", "en"), (5, "Read all of it here!", "en")]
    got = {r.doc_id: (r.text, r.removed) for r in ld.deduplicate(frame(spark, rows)).collect()}
    assert got == {
        1: (whole, []),
        2: ("", [0, 2, 3, 4, 5]),
        3: ("\nMenus", [0, 2, 3, 4, 5]),
        4: ("b\n ", [0, 3]),
        5: ("", [0]),
    }
    assert brute(rows) == {(i, t): got[i][1] for i, t, _ in rows if got[i][1]}
    assert not ld.similar(b"menu", b"menus") and ld.similar(b"menu", b"menu")


def test_shingles_are_characters(spark):
    """Lines in scripts of several bytes a character; what a byte shingle would join or part."""
    rng = random.Random(14)
    chinese = ["".join(chr(0x4E00 + rng.randrange(4000)) for _ in range(60)) for _ in range(6)]
    for line in [*chinese, "short", "caf\u00e9 " * 9, "\U0001f600" * 12, "na\u00efve text and more of it"]:
        own = line.encode()
        assert len(ld.grams_of(own)) == len(shingles(own))
    rows = []
    for i, line in enumerate(chinese):
        changed = line[:30] + "\u3042" + line[31:]
        rows += [(10 * i, line, None), (10 * i + 1, "x\n" + line + "\u3002", None), (10 * i + 2, changed + "\n" + line[:7], None)]
    got = {r.doc_id: r.removed for r in ld.deduplicate(frame(spark, rows)).collect()}
    want = brute(rows)
    assert got == {i: want.get((i, t), []) for i, t, _ in rows} and sum(map(len, got.values())) >= 11


def test_very_long_lines_and_many_lines(spark, monkeypatch):
    """Lines of a megabyte are compared whole; a text of many lines takes linear time."""
    monkeypatch.setattr(ld, "KEPT_BYTES", 1 << 20)
    rng = random.Random(15)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(150_000)]
    other = words[:74_000] + ["zz"] + words[74_001:]
    lines = [f"line {i} of many" for i in range(30_000)]
    rows = [(1, " ".join(words), None), (2, " ".join(other) + "\nend", None), (3, " ".join(words[:100_000]), None)]
    rows += [(4, "\n".join(lines), None), (5, "\n".join(lines[::-1]) + "\nlast", None)]
    exact = ld.deduplicate(frame(spark, rows), percent=100).collect()
    assert {r.doc_id: (r.n_removed, r.text[-4:]) for r in exact if r.doc_id > 3} == {4: (0, "many"), 5: (30_000, "last")}
    got = {r.doc_id: r.removed for r in ld.deduplicate(frame(spark, rows[:3])).collect()}
    assert got == {1: [], 2: [0], 3: []}
