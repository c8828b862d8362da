"""Projection of good rows to the columns of a target table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from sieveline.functions.predicates import quoted
from sieveline.operators.clean import PERIOD
from sieveline.plans.ruleset import RuleSet


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns (exact-case match); every old name must exist and the new
    names must not clash."""
    missing = [old for old in names if old not in df.columns]
    if missing:
        raise ValueError(f"columns to rename are missing: {missing}")
    renamed = [names.get(c, c) for c in df.columns]
    if len({c.lower() for c in renamed}) < len(renamed):
        raise ValueError(f"renaming gives repeated columns: {renamed}")
    return df.select(*[quoted(old).alias(new) for old, new in zip(df.columns, renamed)])


def to_target(
    good: DataFrame, rules: RuleSet, rename: Mapping[str, str] | None = None, period_name: str = PERIOD
) -> DataFrame:
    """Period and configured columns, in rule-set order; other columns are
    dropped. Fails, without a job, if a configured column is missing."""
    df = rename_columns(good, rename or {})
    wanted = [period_name, *rules]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"columns of the rule set are missing in the data: {missing}")
    return df.select(*map(quoted, wanted))
