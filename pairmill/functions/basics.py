"""Small helpers shared by the other function modules."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def map_literal(entries: Mapping[str, str]) -> Column:
    """A constant map; order is kept, so put frequent keys first."""
    return F.from_json(F.lit(json.dumps(dict(entries))), "map<string,string>")


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator.

    Catalyst pushes filters through a plain projection by copying the projected
    expression into the filter, which would run a regex chain twice. It does not
    push them through a generator.
    """
    packed = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.inline(packed))


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def upper_first(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 2147483647))
