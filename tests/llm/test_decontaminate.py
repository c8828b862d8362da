"""Benchmark items in texts: all unedited ones, edited ones at the target recall."""

import random
from collections import Counter

import pyarrow.parquet as pq
import pytest

from sieveline.llm import decontaminate as dc
from tests.llm.corpus import frame, near, prose, texts

SF_DIR = "/root/testdata/sf0.01"


def distance(item, text):
    """Least edit distance of the item to any part of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return min(row)


def test_best_match_is_the_table():
    rng = random.Random(1)
    for _ in range(300):
        item = "".join(rng.choices("abc ", k=rng.randint(1, 70)))
        text = "".join(rng.choices("abc ", k=rng.randint(0, 90)))
        least = distance(item, text)
        for most in {max(0, least - 1), least, least + 3}:
            match = dc.best_match(item, text, most)
            assert (match[0] if match else None) == (least if least <= most else None)
            if match:
                assert distance(item, text[: match[1]]) == least


def items(rng, n=40):
    return [(i, prose(rng, rng.randint(16, 60))) for i in range(n)]


def test_unedited_occurrences_are_all_found(spark):
    """At any place of a text, in any case and with other white space."""
    rng = random.Random(2)
    bench = items(rng)
    rows = texts()
    for i, text in bench:
        for k in range(4):
            before = prose(rng, rng.randint(0, 40))
            rows.append((1000 + 10 * i + k, f"{before} {text.upper() if k == 1 else text.replace(' ', '  ', 3)}\n{prose(rng, 9)}", "en"))
    benchmark = spark.createDataFrame([*bench, (99, None), (98, " ")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.distance for r in dc.find(frame(spark, rows), benchmark).collect()}
    assert all(found.get((1000 + 10 * i + k, i)) == 0 for i, _ in bench for k in range(4))
    # Nothing else is flagged that the plain table would not flag.
    plain = dict(bench)
    by_id = {}
    for doc_id, text, _ in rows:
        by_id.setdefault(doc_id, []).append(dc.normalize(text))
    for (doc_id, item), edits in found.items():
        assert min(distance(dc.normalize(plain[item]), t) for t in by_id[doc_id] if len(t) < 5000) == edits


def test_edited_occurrences_reach_the_recall():
    rng = random.Random(3)
    bench = items(rng, 60)
    index = dc.Index([(i, dc.normalize(t)) for i, t in bench])
    for share, recall in ((0.03, 0.98), (0.06, 0.95), (0.12, 0.85)):
        edited = []
        for i, text in bench:
            changed = near(rng, text, max(1, int(share * len(text.split()))))
            if dc.best_match(dc.normalize(text), dc.normalize(changed), int(dc.EDITS * len(text))):
                edited.append((i, dc.normalize(prose(rng, 50) + " " + changed + " " + prose(rng, 50))))
        hits = index.search([t for _, t in edited])
        assert sum(any(h[0] == i for h in found) for found, (i, _) in zip(hits, edited)) >= recall * len(edited)


def test_items_of_many_lengths_and_passes(spark, monkeypatch):
    rng = random.Random(4)
    bench = [(1, "tiny one"), (2, "x"), (3, prose(rng, 30)), (4, prose(rng, 400))]
    rows = [(1, "a Tiny  ONE b", None), (2, "tinyone x1", None), (3, "." + prose(rng, 5) + " " + bench[2][1], None), (4, bench[3][1] + " x", None)]
    benchmark = spark.createDataFrame(bench, "item_id int, text string")
    want = [(1, 1), (3, 3), (4, 2), (4, 4)]
    docs = frame(spark, rows)
    assert sorted((r.doc_id, r.item_id) for r in dc.find(docs, benchmark).collect()) == want
    monkeypatch.setattr(dc, "ITEM_BYTES", 600)
    assert len(list(dc.item_parts(benchmark))) > 1
    assert sorted((r.doc_id, r.item_id) for r in dc.find(docs, benchmark).collect()) == want


def test_hard_cases(spark):
    docs = frame(spark, texts())
    nothing = spark.createDataFrame([], "item_id long, text string")
    scanned = dc.scan(docs, nothing)
    assert scanned.columns == [*[c for c in docs.columns if c != "hits"], "hits"]
    assert scanned.count() == docs.count() and scanned.where("size(hits) > 0").count() == 0
    one = spark.createDataFrame([(1, prose(random.Random(1), 30))], "item_id long, text string")
    assert dc.scan(docs, one).count() == docs.count()
    assert dc.find(docs.where("false"), one).count() == 0


def test_recall_at_the_full_limit():
    """Random edits of single characters, as many as the limit allows; it does not matter
    which texts stand before."""
    rng = random.Random(7)
    bench = items(rng, 60)
    index = dc.Index([(i, dc.normalize(t)) for i, t in bench])
    for share, recall in ((0.12, 0.99), (0.2, 0.95)):
        edited = []
        for i, text in bench:
            changed = list(dc.normalize(text))
            for _ in range(int(share * len(changed))):
                k = rng.randrange(len(changed))
                changed[k : k + rng.randint(0, 1)] = rng.choice(["", "q", "e", "zx"[rng.randint(0, 1)]])
            changed = "".join(changed)
            if dc.best_match(dc.normalize(text), changed, int(dc.EDITS * len(text))):
                edited.append((i, dc.normalize(prose(rng, rng.randint(0, 50)) + " " + changed + " " + prose(rng, 50))))
        hits = index.search([t for _, t in edited])
        assert sum(any(h[0] == i for h in found) for found, (i, _) in zip(hits, edited)) >= recall * len(edited) > 50
        assert hits == [index.search([t])[0] for _, t in edited]


def test_short_items_and_scripts_without_spaces():
    chinese = "".join(chr(0x4E00 + (i * i * 7 + 13 * i) % 5000) for i in range(300))
    bench = [(0, "why is the sky blue"), (1, chinese), (2, chinese[40:52]), (3, "tiny one"), (4, "art")]
    index = dc.Index(bench)
    changed = chinese[:90] + "\u3042" + chinese[91:200] + chinese[230:]
    texts = ['he asked: "why is the sky blue?"', "so whi is teh sky blue.", "why is the sky bluest", f"\u3042\u3044{chinese}\u3046", f"\u3042{changed}\u3046",
             "a tiny ones", "(tiny one)", "tinyone", "party", "art!", ""]
    got = [[(h[0], h[1]) for h in found] for found in index.search(texts)]
    assert got[:4] == [[(0, 0)], [(0, 3)], [(0, 2)] if got[2] else [], [(1, 0), (2, 0)]]
    assert got[4] == [(1, 31), (2, 0)] and got[5:] == [[(3, 1)], [(3, 0)], [], [], [(4, 0)], []]
    (hit,) = index.search(texts[:1])[0]
    assert texts[0][hit[2] : hit[3]] == bench[0][1]


def edited(rng, text, share, even):
    """Substituted, inserted and deleted characters, at random places or at even distances."""
    n, out = int(share * len(text)), list(text)
    places = [int((k + 0.5) / share) for k in range(n)] if even else rng.sample(range(len(text)), n)
    for k in sorted(places, reverse=True):
        out[k : k + rng.choice([0, 1, 1])] = rng.choice(["", "q", "e", " "])
    return "".join(out)


@pytest.mark.parametrize("even", [False, True])
@pytest.mark.parametrize("share", [0.05, 0.1, 0.15, 0.2])
def test_walks_reach_the_recall_on_the_benchmark(share, even):
    """Recall over the given benchmark, up to the limit, also for edits placed so that no
    run of five characters stays."""
    table = pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pydict()
    index = dc.Index([(i, dc.normalize(t)) for i, t in zip(table["item_id"], table["text"])])
    rng, found, there = random.Random(11), 0, 0
    for _ in range(5):
        changed = [edited(rng, t, share, even) for _, t in index.items]
        hits = index.search([dc.normalize(prose(rng, 30) + ". " + c + " " + prose(rng, 30)) for c in changed])
        for number, c in enumerate(changed):
            if dc.best_match(index.items[number][1], dc.normalize(c), int(index.most[number])):
                there += 1
                found += any(h[0] == number for h in hits[number])
    assert there >= 150 and found >= 0.95 * there, (found, there)


def test_equals_the_distance_of_every_item_to_every_text(spark):
    """Brute force over all pairs of a small corpus: nothing else is found, and what walks
    may miss is rare."""
    rng = random.Random(12)
    bench = [(i, prose(rng, rng.randint(10, 70))) for i in range(25)]
    rows = [(i, prose(rng, rng.randint(0, 150)), None) for i in range(60)]
    for i, text in bench:
        for k, share in enumerate((0.0, 0.07, 0.14, 0.19, 0.24)):
            rows.append((1000 + 10 * i + k, f"{prose(rng, 20)} {edited(rng, text, share, False) if share else text}. {prose(rng, 20)}", None))
    rows += [(2000, None, None), (2001, "", None), (None, bench[0][1], None), (2002, bench[1][1], None), (2002, bench[1][1], None)]
    want = []
    for doc_id, text, _ in rows:
        for item, plain in bench:
            goal = dc.normalize(plain)
            if match := dc.best_match(goal, dc.normalize(text), int(dc.EDITS * len(goal))):
                want.append((doc_id, item, match[0]))
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.distance) for r in dc.find(frame(spark, rows), benchmark).collect()]
    assert not Counter(got) - Counter(want) and len(got) >= 0.98 * len(want) > 90


def test_windows_start_in_any_script_and_long_words():
    chinese = "".join(chr(0x4E00 + i) for i in range(30))
    text = "ab, c\u00e9d " + chinese + " " + "x" * 40
    starts = dc.window_starts(dc.points_of(text)).tolist()
    assert starts[:2] == [0, 4] and starts[2:32] == list(range(8, 38)) and starts[32] == 39 and starts[33:] == list(range(39 + dc.LONG_WORD, 79))


def test_a_batch_is_searched_in_parts_that_go_on_at_once(spark, monkeypatch):
    """A task holds the texts of a chunk, not of its batch, and finds the same."""
    rng = random.Random(12)
    bench = items(rng, 5)
    rows = [(k, f"{prose(rng, 60)} {bench[k % 5][1]} {prose(rng, 60)}", "en") for k in range(40)] + [(40, "", "en"), (41, None, "en")]
    docs = frame(spark, rows).drop("hits").coalesce(1)
    made = []
    monkeypatch.setattr(dc, "map_batches", lambda docs, run, schema: made.append(run))
    dc._scan_once(docs, [(i, dc.normalize(t)) for i, t in bench], dc.EDITS, "text", "bigint", docs.schema, False)
    sizes = []
    search = dc.Index.search
    monkeypatch.setattr(dc.Index, "search", lambda index, texts: sizes.append(sum(map(len, texts))) or search(index, texts))
    whole = docs.toArrow().combine_chunks().to_batches()
    monkeypatch.setattr(dc, "CHUNK", 4000)
    parts = list(made[0](iter(whole)))
    longest = max(len(dc.normalize(t)) for _, t, _ in rows)
    assert len(parts) == len(sizes) > 5 and max(sizes) < 4000 + longest
    assert [i for p in parts for i in p.column("doc_id").to_pylist()] == [i for b in whole for i in b.column("doc_id").to_pylist()]
    found = {i: [h["item_id"] for h in hits] for p in parts for i, hits in zip(p.column("doc_id").to_pylist(), p.column("hits").to_pylist())}
    assert len(found) == 42 and all(k % 5 in found[k] for k in range(40)) and found[40] == found[41] == []


def test_a_worker_drops_what_other_operators_left():
    from sieveline.llm import common

    dc._index(((1, "some words of an item that is long enough for walks to meet it"),), dc.EDITS)
    common.forget_others(dc.__name__)
    assert dc._index.cache_info().currsize == 1 and dc.walks.cache_info().currsize == 1
    common.forget_others("sieveline.llm.bpe")
    assert dc._index.cache_info().currsize == dc.walks.cache_info().currsize == dc._kinds.cache_info().currsize == 0
