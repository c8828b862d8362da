"""A small corpus with hard cases: nulls, empty and long texts, ties, repeated rows,
columns whose names clash with the operators' own."""

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, hits string, node int, identity string, component string"
SYLLABLES = {"en": "the an er in re on th he ed ing at nd".split(), "de": "sch ein ung ver ge lich keit zu der ß ü ö".split()}


def words(rng: random.Random, n: int, lang: str = "en") -> list[str]:
    return ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n)]


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    out = []
    for i, w in enumerate(words(rng, n, lang)):
        out.append(w.capitalize() if i % 11 == 0 else w)
        if i % 11 == 10:
            out[-1] += rng.choice([".", ".\n", ","])
    return " ".join(out).replace("\n ", "\n")


def near(rng: random.Random, text: str, edits: int) -> str:
    parts = text.split(" ")
    for _ in range(edits):
        parts[rng.randrange(len(parts))] = "xqz" + str(rng.randrange(1000))
    return " ".join(parts)


def texts(seed: int = 5) -> list[tuple[int | None, str | None, str | None]]:
    rng = random.Random(seed)
    rows: list[tuple[int | None, str | None, str | None]] = []
    base = [prose(rng, rng.randint(60, 300), "de" if i % 4 == 0 else "en") for i in range(24)]
    for i, text in enumerate(base):
        rows.append((100 + i, text, "de" if i % 4 == 0 else "en"))
    hot, shared = base[1], prose(rng, 60)
    for i in range(40):  # a hot group of exact copies, a group of near ones, a shared passage
        rows.append((200 + i, hot, "en"))
        rows.append((300 + i, near(rng, base[2], rng.randint(1, 4)), None))
        rows.append((400 + i, prose(rng, 40) + "\n" + shared + "\n" + prose(rng, 40), "en"))
    rows += [
        (1, None, "en"), (2, "", None), (3, " \t\n ", "de"), (4, "12 34 !!", "en"), (5, "one", "en"), (6, "one", None),
        (7, "One two  three\tfour", "en"), (8, "one two three FOUR", "en"), (9, "é" * 5000, "de"), (10, " ".join(words(rng, 20_000)), "en"),
        (11, "a" * 50_000, None), (None, base[3], "en"), (None, None, None), (12, base[4], "de"), (12, base[4], "de"),
        (13, base[5], "en"), (13, base[6], "en"), (14, "\x1c\x85　 x\x00y <|endoftext|> ﬁ İΣ ß漢字", "en"),
    ]
    rng.shuffle(rows)
    return rows


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None, str | None]], parts: int = 4) -> DataFrame:
    full = [(i, t, lang, "src", len(t) if t is not None else None, "h", 1, "x", "y") for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)
