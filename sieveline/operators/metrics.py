"""Row counts of a feed: per rule, raw, good and rejected, in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.predicates import all_of, quoted
from sieveline.operators.integrity import free_name
from sieveline.operators.validate import Flagged, with_flags
from sieveline.plans.ruleset import RuleSet


def named_flags(df: DataFrame, flags: dict[str, Column]) -> dict[str, str]:
    """A free column name for each flag, so that it is computed once and counted
    more than once."""
    names: dict[str, str] = {}
    for i, column in enumerate(flags):
        names[column] = free_name([*df.columns, *names.values()], f"__passed_{i}")
    return names


def counters(names: dict[str, str]) -> list[Column]:
    """Aggregates over frames that hold the flags as columns."""
    valid = all_of([quoted(n) for n in names.values()])
    return [
        F.count("*").alias("raw"),
        F.count_if(valid).alias("good"),
        F.count_if(~valid).alias("rejects"),
        *[F.count_if(quoted(name)).alias(f"passed:{column}") for column, name in names.items()],
    ]


def metrics(
    df: DataFrame,
    rules: RuleSet,
    period: int | Column | None = None,
    parents: Mapping[str, DataFrame] | None = None,
    period_name: str = "ID_PER",
    flagged: Flagged | None = None,
) -> DataFrame:
    """``(metric, rows_ok)``, or ``(ID_PER, metric, rows_ok)`` with a period.

    Metrics are ``raw``, ``good``, ``rejects`` and ``passed:<column>``. One scan,
    one aggregation; only counters leave a task. A frame that already has its
    period can be given it as a column. With ``flagged``, the result of
    ``tag_and_flag``, nothing is measured again and the counts are by its period.
    """
    if flagged is not None:
        return _counted(flagged, [period_name])
    keys: list[str] = []
    if period is not None:
        if period_name in rules:
            raise ValueError(f"column {period_name!r} holds the period and cannot have a rule")
        period = period if isinstance(period, Column) else F.lit(period)
        df = df.select(period.cast("int").alias(period_name), *[quoted(c) for c in df.columns if c != period_name])
        keys = [period_name]
    return _counted(with_flags(df, rules, parents), keys)


def _counted(flagged: Flagged, keys: list[str]) -> DataFrame:
    frame, flags = flagged
    names = named_flags(frame, flags)
    passed = frame.select(*map(quoted, keys), *[flag.alias(names[c]) for c, flag in flags.items()])
    wide = passed.groupBy(*map(quoted, keys)).agg(*counters(names))
    values = [quoted(c) for c in wide.columns if c not in keys]
    return wide.unpivot([quoted(k) for k in keys], values, "metric", "rows_ok")
