"""Cleaning and validation of tabular text feeds with Spark DataFrames."""

from sieveline.operators.clean import Cleaned, clean, tag_and_flag
from sieveline.operators.combine import filter_equals, union_feeds
from sieveline.operators.integrity import ForeignKey, with_foreign_key, with_foreign_keys
from sieveline.operators.metrics import metrics
from sieveline.operators.target import rename_columns, to_target
from sieveline.operators.validate import Flagged, row_validity, with_flags
from sieveline.plans.feed import FeedRun, process_feed
from sieveline.plans.ruleset import Rule, RuleSet, feed_rules, parse_rules
from sieveline.sinks.jdbc import append_jdbc, load_period
from sieveline.shared import delete_folder, new_folder
from sieveline.sinks.partitions import read_table, replace_both, replace_periods
from sieveline.sinks.publish import JdbcTarget, publish
from sieveline.sources.csv_feed import file_period, period_of, read_feed

__all__ = [
    "Cleaned",
    "FeedRun",
    "Flagged",
    "ForeignKey",
    "JdbcTarget",
    "Rule",
    "RuleSet",
    "append_jdbc",
    "clean",
    "delete_folder",
    "feed_rules",
    "file_period",
    "filter_equals",
    "load_period",
    "metrics",
    "new_folder",
    "parse_rules",
    "period_of",
    "process_feed",
    "publish",
    "read_feed",
    "read_table",
    "rename_columns",
    "replace_both",
    "replace_periods",
    "row_validity",
    "tag_and_flag",
    "to_target",
    "union_feeds",
    "with_flags",
    "with_foreign_key",
    "with_foreign_keys",
]
