"""Several feeds in one frame, and ad-hoc selection."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.predicates import quoted


def union_feeds(feeds: Mapping[str, DataFrame], feed_name: str = "feed") -> DataFrame:
    """All rows of all feeds, matched by column name, with the feed they come
    from; a column a feed lacks is NULL."""
    if not feeds:
        raise ValueError("no feeds to combine")
    for name, df in feeds.items():
        if feed_name.lower() in (c.lower() for c in df.columns):
            raise ValueError(f"feed {name!r} already has a column {feed_name!r}")
    named = [df.select(F.lit(name).alias(feed_name), *map(quoted, df.columns)) for name, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def filter_equals(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column has one value."""
    return df.where(quoted(column) == value)
