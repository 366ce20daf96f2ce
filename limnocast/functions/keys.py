"""Column helpers for times, keys, labels and text."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR = 3600
DAY = 86400


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Binding through a one-element array keeps the optimizer from copying a costly
    expression into the inside of a per-element lambda.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def epoch(time: Column) -> Column:
    """Whole seconds since 1970 of a timestamp with or without zone (session in UTC)."""
    return F.unix_seconds(time.cast("timestamp"))


def time_like(seconds: Column, df: DataFrame, column: str) -> Column:
    """Back from seconds to the timestamp type ``df`` uses for ``column``."""
    return F.timestamp_seconds(seconds).cast(df.schema[column].dataType)


def horizon_days(reference: Column, valid: Column) -> Column:
    """Day boundaries crossed between issue and valid time."""
    return F.datediff(valid, reference)


def horizon_fraction(reference: Column, valid: Column) -> Column:
    """Elapsed days between issue and valid time, with fraction."""
    return (epoch(valid) - epoch(reference)) / F.lit(float(DAY))


def day_of_year(time: Column) -> Column:
    """Day of year plus the hour as a fraction of the day."""
    return F.dayofyear(time) + F.hour(time) / F.lit(24.0)


def round_to_day(time: Column) -> Column:
    """Nearest midnight, noon going up."""
    return F.date_trunc("day", time + F.expr("INTERVAL 12 HOURS"))


def relabel(column: Column, labels: Mapping[str, str]) -> Column:
    """Replace known values by their label and leave the others alone."""
    if not labels:
        return column
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(table, column), column)


def trace_key(model: Column, parameter: Column) -> Column:
    """One line per model and member."""
    return F.concat_ws("_", model, parameter)


def depth_label(depth: Column, surface: float = 0.5, bottom: float = 5.0) -> Column:
    return F.when(depth == surface, F.lit(f"Surface (depth: {surface:g} m)")).otherwise(
        F.lit(f"Bottom (depth: {bottom:g} m)")
    )


def depth_order(depth: Column, surface: float = 0.5) -> Column:
    """Ordinal of the depth label: surface first."""
    return F.when(depth == surface, F.lit(1)).otherwise(F.lit(2))


def sample_family(family: Column) -> Column:
    """``ensemble`` is scored as ``sample``; every other family keeps its name."""
    return F.when(family == "ensemble", F.lit("sample")).otherwise(family)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def strip(text: Column, prefix: str = "", suffix: str = "") -> Column:
    """Remove a literal prefix and suffix."""
    if prefix:
        text = F.regexp_replace(text, "^" + _quote(prefix), "")
    if suffix:
        text = F.regexp_replace(text, _quote(suffix) + "$", "")
    return text


def split_part(text: Column, delimiter: str, position: int) -> Column:
    """1-based part of a delimited string, null when there are fewer parts."""
    return F.get(F.split(text, _quote(delimiter)), F.lit(position - 1))


def path_value(path: Column, key: str) -> Column:
    """Value of ``key=value`` in a partitioned path."""
    return F.regexp_extract(path, "(?:^|/)" + _quote(key) + "=([^/]*)", 1)


def _quote(literal: str) -> str:
    return "".join(c if c.isalnum() or c in "_/= " else "\\" + c for c in literal)


def existing(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of ``names`` that ``df`` has, in the order given."""
    have = set(df.columns)
    return [n for n in names if n in have]
