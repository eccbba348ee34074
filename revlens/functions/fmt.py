"""Text renderings of the numeric results, in the original output formats.

``format_string`` follows ``java.util.Formatter``: ``%.2f`` rounds half up
on the shortest decimal text of the double, so 3.775 prints as 3.78 (Spark's
``format_number`` and Python/DuckDB ``printf`` print 3.77).  Queries keep
numbers as numbers; these helpers only feed the text sinks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output line formats of the original jobs.
ITEM_LINE = "%.2f (TotalRatings: %d)"
TOP_ITEM_KEY = "TOP_MOVIE"
TOP_ITEM_LINE = "%s (Average: %.2f)"
NO_TOP_ITEM_LINE = "No movie has at least %d ratings."
GENDER_LINE = "Male_Avg: %.2f, Female_Avg: %.2f"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def item_line(avg: Column | str, n: Column | str) -> Column:
    return F.format_string(ITEM_LINE, _col(avg), _col(n))


def top_item_line(title: Column | str, avg: Column | str, min_count: int) -> Column:
    return (F.when(_col(avg).isNull(), F.lit(NO_TOP_ITEM_LINE % min_count))
             .otherwise(F.format_string(TOP_ITEM_LINE, _col(title), _col(avg))))


def gender_line(male: Column | str, female: Column | str) -> Column:
    return F.format_string(GENDER_LINE, _col(male), _col(female))


def bucket_line(labels: Sequence[str], values: Sequence[Column | str]) -> Column:
    """``[0-18: 4.00, 18-35: 0.00, ...]``; an empty group prints 0.00."""
    fmt = "[" + ", ".join(f"{label}: %.2f" for label in labels) + "]"
    return F.format_string(fmt, *[F.coalesce(_col(v), F.lit(0.0)) for v in values])
