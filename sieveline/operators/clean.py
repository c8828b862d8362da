"""Clean-and-split: a feed of text becomes typed good rows and rejects."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from datetime import datetime, timezone
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sieveline.functions.predicates import quoted
from sieveline.operators.metrics import counters, named_flags
from sieveline.operators.validate import Flagged, row_validity, with_flags
from sieveline.plans.ruleset import RuleSet, convert

PERIOD = "ID_PER"
INGESTED = "DINS"
# The two kinds of rows a feed is split into.
GOOD, REJECTS = "good", "rejects"


@dataclass(frozen=True)
class Cleaned:
    """Good rows and rejects as two frames, and as one: ``both`` has the period and
    the columns of either kind in ``good`` or ``rejects``, the other one NULL."""

    good: DataFrame
    rejects: DataFrame
    both: DataFrame

    def __iter__(self) -> Iterator[DataFrame]:
        return iter((self.good, self.rejects))


def now() -> datetime:
    return datetime.now(timezone.utc)


def check_reserved(columns: Iterable[str], *reserved: str) -> None:
    """Refuse column names that Spark could confuse with the ones a run adds."""
    taken = {name.lower() for name in reserved}
    clash = [c for c in columns if c.lower() in taken]
    if clash:
        raise ValueError(f"feed or rule set have reserved column name(s) {clash}")


def tag_and_flag(
    df: DataFrame,
    rules: RuleSet,
    period: int | Column,
    parents: Mapping[str, DataFrame] | None = None,
    period_name: str = PERIOD,
    ingested_name: str = INGESTED,
) -> Flagged:
    """The feed with its period first, and its flags. Both ``clean`` and ``metrics`` take
    it, so that foreign keys are measured once for the two."""
    check_reserved([*df.columns, *rules], period_name, ingested_name)
    period = period if isinstance(period, Column) else F.lit(period)
    return with_flags(df.select(period.cast("int").alias(period_name), *map(quoted, df.columns)), rules, parents)


def clean(
    df: DataFrame,
    rules: RuleSet,
    period: int | Column,
    ingested_at: datetime | None = None,
    *,
    parents: Mapping[str, DataFrame] | None = None,
    period_name: str = PERIOD,
    ingested_name: str = INGESTED,
    observation: Observation | None = None,
    flagged: Flagged | None = None,
) -> Cleaned:
    """Split ``df`` into good rows and rejects; together they are all of its rows.

    Both have the period first, the columns in source order, and the insert
    timestamp last. Numbers and dates of the good rows are converted, rejects stay
    text. ``period`` is a period or run number, or a column such as
    ``file_period()``. ``ingested_at`` is fixed once per call, so that good rows
    and rejects agree whenever they are computed.

    Lazy; only foreign keys start jobs, to measure their keys; none if ``flagged``, the
    result of ``tag_and_flag`` for the same arguments, is given. With ``observation``
    the counts of ``metrics`` are taken while the good rows (or both kinds) are written,
    which saves a pass. They are exact if no shuffle comes after this call in the job.
    """
    flagged, flags = flagged or tag_and_flag(df, rules, period, parents, period_name, ingested_name)
    columns = df.columns
    valid = row_validity(flags)
    if observation is not None:
        names = named_flags(flagged, flags)
        flagged = flagged.select("*", *[flag.alias(names[c]) for c, flag in flags.items()])
        flagged = flagged.observe(observation, *counters(names))
        valid = row_validity({c: quoted(n) for c, n in names.items()})

    id_column, stamp = quoted(period_name), F.lit(ingested_at or now()).alias(ingested_name)
    typed = [convert(quoted(c), rules[c]).alias(c) if c in rules else quoted(c) for c in columns]
    texts = [*map(quoted, columns), stamp]
    both = flagged.select(
        id_column, F.when(valid, F.struct(*typed, stamp)).alias(GOOD), F.when(~valid, F.struct(*texts)).alias(REJECTS)
    )
    return Cleaned(
        flagged.where(valid).select(id_column, *typed, stamp), flagged.where(~valid).select(id_column, *texts), both
    )
