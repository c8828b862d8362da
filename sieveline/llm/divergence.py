"""Quality rules: how far a document's histograms are from its language's.

Two histograms of a document, its character classes and its common words, are compared
with references learned from all documents of its language by the Jensen-Shannon
distance (square root of the divergence in bits, 0 to 1). Documents below the
minimum lengths are not judged by a histogram. Everything is a column expression:
one pass with a pre-aggregated count for the references, one for the documents, which
are not shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.predicates import quoted
from sieveline.llm.common import SPACE
from sieveline.shared import written

#: Character classes in the order in which they are taken out of a text; the rest is the last one.
CLASSES = {
    "small": r"[\p{Ll}\p{Lo}\p{Lm}\p{M}]+",
    "space": f"[{SPACE}]+",
    "capital": r"[\p{Lu}\p{Lt}]+",
    "stop": "[.,;:]+",
    "digit": r"\p{N}+",
}
WHITE = " \t\n\x0b\f\r"
SPACES = list(CLASSES).index("space")
SYMBOLS = "#*$%&|<>"
POOLED = "\x00all"


@dataclass(frozen=True)
class Limits:
    """A word is common if it makes up ``common_share`` of its language's words, so
    there are at most ``1 / common_share`` of them. A language has references of its
    own if it holds ``language_share`` of all words, else the pooled ones.

    The words are too far over ``word_distance``, or over ``bare_share`` of the distance
    that a text without any common word has from the reference (none: no such limit).
    """

    common_share: float = 0.005
    language_share: float = 0.001
    min_words: int = 40
    min_chars: int = 200
    word_distance: float = 0.4
    class_distance: float = 0.25
    bare_share: float | None = 0.9


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda variable."""
    return F.transform(F.array(value), use)[0]


def _sum(values: Column, zero: Column) -> Column:
    return F.aggregate(values, zero, lambda a, x: a + x)


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


def _texts(docs: DataFrame, id_column: str, text_column: str, lang_column: str) -> DataFrame:
    return docs.select(
        quoted(id_column).alias("doc_id"),
        F.coalesce(quoted(lang_column).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(quoted(text_column).cast("string"), F.lit("")).alias("text"),
    )


def _with_classes(texts: DataFrame) -> DataFrame:
    """``classes``: the characters of each class, in the order of ``CLASSES``, then the
    rest, and how many of the rest are ``SYMBOLS``."""

    def strip(rest: Column, patterns: list[str], counts: list[Column]) -> Column:
        if not patterns:
            return F.array(*counts, F.length(rest), F.length(rest) - F.length(F.translate(rest, SYMBOLS, "")))
        return _once(
            F.regexp_replace(rest, patterns[0], ""),
            lambda left: strip(left, patterns[1:], [*counts, F.length(rest) - F.length(left)]),
        )

    return texts.withColumn("classes", strip(F.col("text"), list(CLASSES.values()), []))


def _repeat_words(hashes: Column) -> Column:
    """Words in 5-word windows that occur twice or more, the first time included.
    Windows are compared by a 64-bit hash of their words' ``hashes``."""
    n = F.size(hashes)
    starts = F.sequence(F.lit(0), n - 5)
    windows = F.when(n >= 5, F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(5)])))

    def repeated(ordered: Column) -> Column:
        same = F.filter(
            ordered, lambda x, k: (x.h == F.get(ordered, k - 1).h).eqNullSafe(True) | (x.h == F.get(ordered, k + 1).h).eqNullSafe(True)
        )
        return F.array_sort(F.transform(same, lambda x: x.i))

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(starts, k + 1) - x, F.lit(5))))
        return _sum(steps, F.lit(0))

    def count(h: Column) -> Column:
        # Only a text with a repeated window is sorted.
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            _once(_once(ordered, repeated), covered)
        )

    return F.coalesce(_once(windows, count), F.lit(0)).cast("long")


def references(docs: DataFrame, limits: Limits = Limits(), text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """One row for each language of its own and one pooled: ``ref``, the shares of the
    character ``classes``, and the common words with their shares as a hash table
    (``slots``, ``shares``, ``spread``), ``bare``, the distance of a text without any of
    them, and ``tables``, for the pooled one the tables of all references.

    The counts cover all documents and are pre-aggregated; what reaches the driver is
    bounded by the shares in ``limits``.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(quoted(lang_column).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(quoted(text_column).cast("string"), F.lit("")).alias("text"),
    )
    first = F.col("place") == 0
    counted = (
        _with_classes(texts)
        .select("lang", "classes", F.posexplode(F.concat(F.array(F.lit("")), _words(F.col("text")))).alias("place", "word"))
        .groupBy("lang", "word")
        .agg(
            F.count_if(~first).alias("n"),
            *[F.sum(F.when(first, F.col("classes")[k]).cast("long")).alias(f"c{k}") for k in range(len(CLASSES) + 1)],
        )
    )
    sums = [F.sum(f"c{k}").alias(f"c{k}") for k in range(len(CLASSES) + 1)]
    counted = written(counted, "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"), *sums)
    # Languages below the share are pooled before anything of them reaches the driver.
    (everything,) = totals.agg(F.sum("total")).first()
    large = written(totals.where((F.col("lang") != "") & (F.col("total") >= max(1.0, (everything or 0) * limits.language_share))), "totals")
    pooled = totals.agg(F.sum("total").alias("total"), *sums).select(F.lit(POOLED).alias("lang"), "*")
    least = F.greatest(F.lit(1.0), F.col("total") * limits.common_share)
    of_own = counted.select("lang", "word", "n").join(F.broadcast(large.select("lang", "total")), "lang").where(F.col("n") >= least)
    of_all = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= max(1.0, (everything or 0) * limits.common_share))
    listed = of_own.select("lang", "word", "n").unionByName(of_all.select(F.lit(POOLED).alias("lang"), "word", "n"))
    common: dict[str, list] = {}
    for r in listed.select("*", F.xxhash64("word").alias("h")).collect():
        common.setdefault(r["lang"], []).append(r)
    table = "slots array<string>, shares array<double>, spread int, bare double"
    schema = f"ref string, classes array<double>, {table}, tables array<struct<{table.replace(' array', ': array').replace(' int', ': int').replace(' double', ': double')}>>"
    rows = []
    for row in [*large.collect(), *pooled.collect()]:
        total, mine = row["total"] or 0, common.get(row["lang"], [])
        size = 64
        while len({c["h"] % size for c in mine}) < len(mine):
            size *= 2
        slots, shares = [""] * size, [0.0] * size
        for c in mine:
            slots[c["h"] % size], shares[c["h"] % size] = c["word"], c["n"] / total
        letters = [row[f"c{k}"] or 0 for k in range(len(CLASSES) + 1)]
        rows.append((row["lang"], [c / max(1, sum(letters)) for c in letters], slots, shares, size, _bare(sum(shares))))
    tables = [row[2:] for row in rows]
    return spark.createDataFrame([(*row, tables if row[0] == POOLED else None) for row in rows], schema)


def _bare(share: float) -> float:
    """The distance of a text without common words, which make up ``share`` of the reference."""
    rest = max(0.0, 1 - share)
    return math.sqrt((share + math.log2(2 / (1 + rest)) + (rest * math.log2(2 * rest / (1 + rest)) if rest else 0.0)) / 2)


def _part(p: Column, q: Column) -> Column:
    """One category's share of the divergence, in bits."""
    middle = (p + q) / 2
    left = F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0)
    right = F.when(q > 0, q * F.log2(q / middle)).otherwise(0.0)
    return (left + right) / 2


def _class_distance(classes: Column, shares: Column) -> Column:
    total = _sum(classes, F.lit(0)).cast("double")
    return F.sqrt(F.greatest(F.lit(0.0), _sum(F.zip_with(classes, shares, lambda c, q: _part(c / total, q)), F.lit(0.0))))


def _word_distance(words: Column, hashes: Column, slots: Column, shares: Column, spread: Column) -> Column:
    """Over the common words and, as one category, all others."""
    n = F.size(words).cast("double")

    def slot(word: Column, hashed: Column) -> Column:
        return _once(F.pmod(hashed, spread).cast("int"), lambda k: F.when(F.get(slots, k) == word, k).otherwise(-1))

    known = F.array_remove(F.zip_with(words, hashes, slot), -1)

    def distance(found: Column) -> Column:
        def present(k: Column) -> Column:
            p, q = (F.size(found) - F.size(F.array_remove(found, k))) / n, F.get(shares, k)
            return F.struct(_part(p, q).alias("part"), q.alias("q"))

        seen = F.transform(F.array_distinct(found), present)

        def total(seen: Column) -> Column:
            parts = F.aggregate(seen, F.lit(0.0), lambda a, x: a + x.part)
            seen_share = F.aggregate(seen, F.lit(0.0), lambda a, x: a + x.q)
            all_share = _sum(shares, F.lit(0.0))
            rest = _part((n - F.size(found)) / n, F.greatest(F.lit(0.0), 1 - all_share))
            # A common word the document lacks adds half its share.
            return F.sqrt(F.greatest(F.lit(0.0), parts + (all_share - seen_share) / 2 + rest))

        return _once(seen, total)

    return _once(known, distance)


def judge(
    docs: DataFrame,
    limits: Limits = Limits(),
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, class_distance, word_distance)``, one row for each row.

    Null texts count as empty and fail the base rules; a null language is compared with
    the pooled references, and lacks common words if it lacks those of every reference.
    A distance is null where the text is below the minimum length, which passes. Other
    columns are left behind.
    """
    refs = references(docs, limits, text_column, lang_column)
    owned = F.array(*[F.lit(r["ref"]) for r in refs.select("ref").collect()])
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    measured = _with_classes(_texts(docs, id_column, text_column, lang_column)).select(
        "doc_id",
        F.when(F.array_contains(owned, F.col("lang")), F.col("lang")).otherwise(POOLED).alias("ref"),
        (F.length(text) - F.col("classes")[SPACES]).cast("long").alias("word_chars"),
        F.col("classes")[len(CLASSES) + 1].cast("long").alias("n_symbols"),
        _once(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.length(text).alias("chars"),
        F.slice("classes", 1, len(CLASSES) + 1).alias("own_classes"),
        _words(text).alias("words"),
    )
    measured = measured.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    joined = measured.join(F.broadcast(refs), "ref", "left")
    n = F.size("words")
    judged = joined.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        _repeat_words(F.col("hashes")).alias("n_repeat_words"),
        F.when(F.col("chars") >= limits.min_chars, _class_distance(F.col("own_classes"), F.col("classes"))).alias("class_distance"),
        F.when(n >= limits.min_words, _word_distance(F.col("words"), F.col("hashes"), F.col("slots"), F.col("shares"), F.col("spread"))).alias(
            "word_distance"
        ),
        "words",
        "hashes",
        "bare",
        "tables",
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    far = F.coalesce(F.col("class_distance") > limits.class_distance, F.lit(False)) | F.coalesce(
        F.col("word_distance") > limits.word_distance, F.lit(False)
    )
    if limits.bare_share is not None:
        # A text of unknown language may be in any that has a reference.
        share = lambda distance, bare: F.when(bare > 0, distance / bare)
        nearest = F.array_min(F.transform("tables", lambda t: share(_word_distance(F.col("words"), F.col("hashes"), t.slots, t.shares, t.spread), t.bare)))
        own = share(F.col("word_distance"), F.col("bare"))
        lacking = F.when(F.col("word_distance").isNotNull(), F.when(F.col("tables").isNull(), own).otherwise(nearest))
        far = far | F.coalesce(lacking > limits.bare_share, F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~far).alias("kept"), "class_distance", "word_distance",
    )
