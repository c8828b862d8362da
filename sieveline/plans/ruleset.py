"""Rule sets: the declarative description of a feed, checked before any read.

A configuration maps a feed name to ``{"columns": {column: rule}}``. A rule is
``{"type": ...}`` with the options of its type, or a list of such rules that all
have to pass.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column

from sieveline.functions import predicates as p

log = logging.getLogger(__name__)

# Rule type -> (options it takes besides "type" and "skip_validation",
#               type of the column in the good rows or None for text)
RULE_TYPES: dict[str, tuple[frozenset[str], str | None]] = {
    "positive_number": (frozenset(), "double"),
    "number": (frozenset(), "double"),
    "non_negative": (frozenset(), "double"),
    "date": (frozenset({"format"}), "date"),
    "string_no_numbers": (frozenset(), None),
    "email": (frozenset(), None),
    "string_length": (frozenset({"length"}), None),
    "foreign_key": (frozenset({"parent", "parent_column"}), None),
    "string": (frozenset(), None),
}
ISO_FORMAT = "yyyy-MM-dd"


@dataclass(frozen=True)
class Rule:
    type: str
    skip: bool = False
    length: int = 0
    parent: str | None = None
    parent_column: str | None = None

    @property
    def is_reference(self) -> bool:
        return self.type == "foreign_key" and not self.skip

    def predicate(self, c: Column) -> Column:
        """Boolean column of a rule that looks at one value only."""
        match self.type:
            case "positive_number":
                return p.positive_number(c)
            case "number":
                return p.number(c)
            case "non_negative":
                return p.non_negative(c)
            case "date":
                return p.iso_date(c)
            case "string_no_numbers":
                return p.string_no_numbers(c)
            case "email":
                return p.email(c)
            case "string_length":
                return p.string_length(c, self.length)
        raise ValueError(f"rule type {self.type!r} has no predicate on a single value")


RuleSet = dict[str, tuple[Rule, ...]]


def _parse_rule(column: str, spec: object) -> Rule:
    where = f"column {column!r}"
    if not isinstance(spec, Mapping):
        raise ValueError(f"{where}: a rule must be an object, got {spec!r}")
    kind = spec.get("type")
    if not isinstance(kind, str):
        raise ValueError(f"{where}: 'type' must be a string, got {kind!r}")
    if kind not in RULE_TYPES:
        raise ValueError(f"{where}: unknown rule type {kind!r}; known: {sorted(RULE_TYPES)}")
    unknown = set(spec) - RULE_TYPES[kind][0] - {"type", "skip_validation"}
    if unknown:
        raise ValueError(f"{where}: unknown option(s) {sorted(map(str, unknown))} for {kind!r}")

    skip = spec.get("skip_validation", False)
    if not isinstance(skip, bool):
        raise ValueError(f"{where}: 'skip_validation' must be true or false, got {skip!r}")
    if kind == "string" and not skip:
        raise ValueError(f"{where}: type 'string' checks nothing; set 'skip_validation': true")

    length = spec.get("length", 0)
    if isinstance(length, bool) or not isinstance(length, int) or length < 0:
        raise ValueError(f"{where}: 'length' must be a non-negative integer, got {length!r}")
    if spec.get("format", ISO_FORMAT) != ISO_FORMAT:
        log.warning("%s: date format %r is ignored, dates are always %s", where, spec["format"], ISO_FORMAT)

    parent, parent_column = spec.get("parent"), spec.get("parent_column")
    if kind == "foreign_key" and not (isinstance(parent, str) and isinstance(parent_column, str)):
        raise ValueError(f"{where}: 'foreign_key' needs the strings 'parent' and 'parent_column'")
    return Rule(kind, skip, length, parent, parent_column)


def parse_rules(columns: Mapping[str, object]) -> RuleSet:
    """Validate the column rules of one feed; order is kept."""
    if not isinstance(columns, Mapping):
        raise ValueError(f"column rules must be an object, got {columns!r}")
    rules: RuleSet = {}
    for column, spec in columns.items():
        specs = spec if isinstance(spec, list) else [spec]
        if not specs:
            raise ValueError(f"column {column!r}: empty list of rules")
        rules[column] = tuple(_parse_rule(column, one) for one in specs)
        if len(_targets(rules[column])) > 1:
            raise ValueError(f"column {column!r}: rules convert to different types")
    return rules


def feed_rules(config: Mapping[str, object], feed: str) -> RuleSet:
    """Rule set of one feed of a configuration."""
    if feed not in config:
        raise ValueError(f"feed {feed!r} is not in the configuration; known: {sorted(config)}")
    entry = config[feed]
    if not isinstance(entry, Mapping) or set(entry) != {"columns"}:
        raise ValueError(f"feed {feed!r}: expected exactly one key, 'columns'")
    return parse_rules(entry["columns"])


def _targets(rules: tuple[Rule, ...]) -> set[str]:
    return {target for rule in rules if (target := RULE_TYPES[rule.type][1])}


def convert(c: Column, rules: tuple[Rule, ...]) -> Column:
    """Typed value of a column in the good rows. Unchecked columns are converted
    too; text that does not convert becomes NULL."""
    targets = _targets(rules)
    if "double" in targets:
        return p.to_number(c)
    if "date" in targets:
        checked = any(rule.type == "date" and not rule.skip for rule in rules)
        return p.to_date(c) if checked else p.to_iso_date(c)
    return c


def applicable(rules: RuleSet, columns: list[str]) -> RuleSet:
    """Rules of the columns that are present (exact-case match); the others are
    skipped with a warning."""
    missing = [c for c in rules if c not in columns]
    if missing:
        log.warning("columns %s are not in the feed, their rules are skipped", missing)
    return {c: rule for c, rule in rules.items() if c in columns}
