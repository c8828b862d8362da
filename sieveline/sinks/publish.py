"""Load of cleaned rows: project to the target, replace the periods, append."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.predicates import quoted
from sieveline.operators.clean import GOOD, PERIOD, REJECTS, Cleaned
from sieveline.operators.target import to_target
from sieveline.plans.ruleset import RuleSet
from sieveline.sinks.jdbc import check_empty, load_period
from sieveline.sinks.partitions import read_table, replace_both, replace_periods


@dataclass(frozen=True)
class JdbcTarget:
    """``empty_period`` is the owner's own statement that empties a period of the
    table, in the database's dialect; without it a period that has rows is refused."""

    url: str
    table: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    batchsize: int = 10_000
    connections: int = 16
    empty_period: Callable[[int], None] | None = field(default=None, repr=False)


def publish(
    source: DataFrame | Cleaned,
    rules: RuleSet,
    path: str,
    periods: Sequence[int],
    *,
    rename: Mapping[str, str] | None = None,
    jdbc: JdbcTarget | None = None,
    period_name: str = PERIOD,
    rebalance: bool = False,
    additive: bool = False,
) -> dict[int, int]:
    """Publish the good rows of the given periods; returns the rows of each.

    Good rows get the target layout and replace their periods in the table at
    ``path``. If ``source`` is the result of ``clean`` and not only its good rows, the
    rejects, with all columns, replace theirs in the same table, pass and commit
    (``read_table(..., kind="rejects")``). A database target is then loaded period by
    period from the table just written, so that cleaning runs once and in full parallel,
    whatever the number of connections. All periods are prepared in the database, that is
    emptied if it says how, and checked, before the table is touched: if that fails for
    one of them, the table stays as it was. If the table's own write fails after it, the
    periods that were emptied are loaded by running again.
    """
    good = source.good if isinstance(source, Cleaned) else source
    target = to_target(good, rules, rename, period_name)
    spark = good.sparkSession
    where = dict(period_name=period_name, options=jdbc.options) if jdbc else {}
    if jdbc is not None:
        for period in sorted(set(periods)):
            if jdbc.empty_period is not None:
                jdbc.empty_period(period)
            check_empty(spark, jdbc.url, jdbc.table, period, **where)
    if isinstance(source, Cleaned):
        names = {new: old for old, new in (rename or {}).items()}
        fields = [F.col(GOOD)[names.get(c, c)].alias(c) for c in target.columns if c != period_name]
        kept = F.when(F.col(GOOD).isNotNull(), F.struct(*fields))
        both = source.both.select(quoted(period_name), kept.alias(GOOD), F.col(REJECTS))
        rows = {p: n[GOOD] for p, n in replace_both(both, path, periods, period_name, rebalance, additive).items()}
    else:
        rows = replace_periods(target, path, periods, period_name, rebalance, additive)
    if jdbc is not None:
        table = read_table(spark, path, period_name)
        for period in sorted(rows):
            load_period(
                table.where(quoted(period_name) == F.lit(period)),
                jdbc.url,
                jdbc.table,
                period,
                period_name=period_name,
                options=jdbc.options,
                batchsize=jdbc.batchsize,
                connections=jdbc.connections,
            )
    return rows
