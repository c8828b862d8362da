"""Rule-driven pass: one boolean column per checked feed column."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame

from sieveline.functions.predicates import all_of, quoted
from sieveline.operators.integrity import ForeignKey, free_name, with_foreign_keys
from sieveline.plans.ruleset import RuleSet, applicable


class Flagged(NamedTuple):
    """A frame and, by column of the feed, the flags that are columns of it."""

    frame: DataFrame
    flags: dict[str, Column]


def with_flags(df: DataFrame, rules: RuleSet, parents: Mapping[str, DataFrame] | None = None) -> Flagged:
    """Flags of the applicable rules, in rule-set order, and the frame they are
    columns of.

    The frame is ``df`` itself unless foreign keys need lookups, whose results are
    then extra columns of the frame; all of them are measured on ``df``, before any is
    joined. A column with several rules passes if all of them do; unchecked columns
    have no flag.
    """
    checks: dict[str, list[Column]] = {}
    keys: list[ForeignKey] = []
    for column, column_rules in applicable(rules, df.columns).items():
        for rule in column_rules:
            if rule.skip:
                continue
            if rule.is_reference:
                if not parents or rule.parent not in parents:
                    raise ValueError(f"column {column!r}: no parent table {rule.parent!r} was given")
                flag = free_name([*df.columns, *[k.flag for k in keys]], f"__{column}_found")
                keys.append(ForeignKey(column, parents[rule.parent], rule.parent_column, flag))
                checks.setdefault(column, []).append(quoted(flag))
            else:
                checks.setdefault(column, []).append(rule.predicate(quoted(column)))
    frame = with_foreign_keys(df, keys) if keys else df
    return Flagged(frame, {column: all_of(found) for column, found in checks.items()})


def row_validity(flags: dict[str, Column]) -> Column:
    """A row is good if every flag is true, and if there are none."""
    return all_of(list(flags.values()))
