"""One feed from files to good rows and rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sieveline.operators.clean import INGESTED, PERIOD, Cleaned, check_reserved, clean, now, tag_and_flag
from sieveline.operators.validate import Flagged
from sieveline.plans.ruleset import RuleSet, feed_rules
from sieveline.sources.csv_feed import check_file_names, file_period, period_of, read_feed


class FeedRun(NamedTuple):
    """``cleaned`` is what ``publish`` takes to store both kinds in one pass, ``flagged``
    what ``metrics`` takes to measure nothing again."""

    raw: DataFrame
    good: DataFrame
    rejects: DataFrame
    rules: RuleSet
    cleaned: Cleaned
    flagged: Flagged


def process_feed(
    spark: SparkSession,
    config: Mapping[str, object],
    feed: str,
    paths: str | Sequence[str],
    period: int | None = None,
    ingested_at: datetime | None = None,
    *,
    columns: Sequence[str] | None = None,
    check_header: bool = True,
    check_month: bool = False,
    parents: Mapping[str, DataFrame] | None = None,
    observation: Observation | None = None,
) -> FeedRun:
    """Scan, validate and split the files of one feed.

    ``config`` and feed name are checked before anything is read. Without
    ``period`` each row gets the period in front of its file's name; the names of all
    files of the scan are checked before any job, so a wrong one fails the run
    whatever rows it has.
    """
    rules = feed_rules(config, feed)
    check_reserved(rules, PERIOD, INGESTED)
    listed = [paths] if isinstance(paths, str) else list(paths)
    if period is None:
        for path in listed:
            if path.endswith(".csv") and not any(ch in path for ch in "*?[{"):
                period_of(path, check_month)
    scan = read_feed(spark, listed, columns, check_header)
    if period is None:
        check_file_names(scan, check_month)
    ingested_at = ingested_at or now()
    source = file_period(check_month) if period is None else period
    flagged = tag_and_flag(scan, rules, source, parents)
    cleaned = clean(scan, rules, source, ingested_at, observation=observation, flagged=flagged)
    raw = scan.withColumn(INGESTED, F.lit(ingested_at))
    return FeedRun(raw, cleaned.good, cleaned.rejects, rules, cleaned, flagged)
