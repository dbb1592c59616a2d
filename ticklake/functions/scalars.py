"""Scalar expressions that tape operators share; all are JVM-side columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ms_to_ns(c: str) -> Column:
    """Milliseconds (number or text) to ns; blank is 0."""
    return F.coalesce(F.col(c).try_cast("bigint"), F.lit(0)) * 1_000_000


def floor_ms(ns: str) -> Column:
    """Whole milliseconds of a difference in ns, rounded down (``div`` truncates)."""
    return ((F.col(ns) - F.pmod(F.col(ns), F.lit(1_000_000))) / 1_000_000).cast("bigint")


def hour_key(ns: str) -> Column:
    """``YYYY-MM-DDTHH`` of a stamp by integer arithmetic."""
    return F.date_format(F.timestamp_seconds(F.expr(f"({ns} div 3600000000000) * 3600")), "yyyy-MM-dd'T'HH")


def hour_bounds(ns: str) -> tuple[Column, Column]:
    """First ns of the hour of a stamp, and of the next."""
    start = F.col(ns) - F.pmod(F.col(ns), F.lit(3_600_000_000_000))
    return start, start + 3_600_000_000_000


def number_or_null(c: str) -> Column:
    """Number of a text; blank, unparsable, NaN and infinite ones are null."""
    x = F.nullif(F.col(c), F.lit("")).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def feed_parts(c: str) -> tuple[Column, Column]:
    """Name and argument of a feed like ``book:50``; no argument is null."""
    return F.split(c, ":")[0], F.try_element_at(F.split(c, ":"), F.lit(2))


def path_parts(c: str) -> dict[str, Column]:
    """Day, hour, symbol and member of a segment's path."""
    pattern = r"(\d{4}-\d{2}-\d{2})/(\d{2})/([^/]+)/([^/]+)$"
    return {n: F.regexp_extract(c, pattern, i) for i, n in enumerate(("day", "hour", "symbol", "member"), 1)}


def sorted_json(columns: list[str]) -> Column:
    """Compact JSON with sorted keys, nulls left out."""
    return F.to_json(F.struct(*sorted(columns)))


def safe_ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole))
