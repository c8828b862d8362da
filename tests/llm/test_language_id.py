"""Held-out accuracy, scripts, spans of mixed texts, and the search against brute force."""

import itertools
import random

import numpy as np

from sieveline.llm import language_id as lid
from tests.llm.corpus import frame, prose, texts


def cost(scores, labels, switch):
    return sum(scores[i, k] for i, k in enumerate(labels)) - switch * sum(a != b for a, b in zip(labels, labels[1:]))


def test_path_is_the_best_of_all():
    rng = np.random.default_rng(1)
    for _ in range(150):
        scores = rng.normal(0, 4, (rng.integers(1, 7), 3)).astype(np.float32)
        switch = float(rng.uniform(0, 9))
        found = lid.path(scores, switch).tolist()
        best = max(cost(scores, x, switch) for x in itertools.product(range(3), repeat=len(scores)))
        assert abs(cost(scores, found, switch) - best) < 1e-3


def many(seed=3, n=300):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(20, 90), "de" if i % 3 else "en"), "de" if i % 3 else "en") for i in range(n)]
    return [*rows, *[(1000 + i, "мир слово дом река " * 5, "ru") for i in range(20)]]


def test_held_out_accuracy_and_spans(spark):
    rows = many()
    rng = random.Random(9)
    mixed = prose(rng, 40, "en") + "\n" + prose(rng, 40, "de") + "\n" + "дом слово река мир " * 6
    docs = frame(spark, [*rows, (5000, mixed, None)])
    got = {r.doc_id: r for r in lid.predict(docs).collect()}
    held = [(i, lang) for i, _, lang in rows if got[i].held_out]
    assert 50 < len(held) < 120
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.98 * len(held)
    assert [s.lang for s in got[5000].spans] == ["en", "de", "ru"]
    parts = [mixed[s.start : s.stop] for s in got[5000].spans]
    assert abs(len(parts[0]) - mixed.index("\n")) < 30 and parts[2].startswith("дом") and 0 < got[5000].score < 0.7


def test_label_inputs_are_the_text_alone(spark):
    rows = many(n=120)
    model = lid.fit(frame(spark, rows))
    renamed = [(i + 7, t, None) for i, t, _ in rows]
    a = sorted((r.doc_id, r.lang_pred, r.score) for r in lid.identify(frame(spark, rows), model).collect())
    b = sorted((r.doc_id - 7, r.lang_pred, r.score) for r in lid.identify(frame(spark, renamed, 2), model).collect())
    assert a == b


def test_hard_cases(spark):
    rows = texts()
    docs = frame(spark, rows)
    got = lid.predict(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1
    by_text = {t: i for i, t, _ in rows if i}
    pred = {r.doc_id: r for r in got}
    for text in (None, "", " \t\n ", "12 34 !!"):
        r = pred[by_text[text]]
        assert (r.lang_pred, r.score, r.spans) == ("und", 0.0, [])
    assert lid.predict(docs.where("false")).count() == 0
    nothing = lid.predict(frame(spark, [(1, "abc", None)])).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)
    kept = lid.identify(docs, lid.fit(docs), keep=("text", "lang", "node")).columns
    assert kept == ["doc_id", "held_out", "lang_pred", "score", "spans", "text", "lang", "node"]


def test_words_are_held_for_few_texts_at_once():
    """Fitting and labelling take texts in lists of a bounded number of characters."""
    sizes = []
    texts = ["uno dos tres " * 40, "one two three " * 40, "", "x"] * 5
    for some in lid.few_at_once(texts, 1000):
        sizes.append(sum(map(len, some)))
    assert max(sizes) <= 1000 and sum(sizes) == sum(map(len, texts))
    assert [t for some in lid.few_at_once(texts, 100) for t in some] == texts
    assert [len(some) for some in lid.few_at_once(["a" * 300, "b"], 100)] == [1, 1]
