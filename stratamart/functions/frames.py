"""Small helpers for one-row check frames."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart import fixed_values as V


def fill(template: str, **values: Column) -> Column:
    """A text with ``{name}`` places taken from columns."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [
        F.lit(part) if i % 2 == 0 else values[part].cast("string")
        for i, part in enumerate(parts)
        if i % 2 or part
    ]
    return F.concat(*pieces)


def tiers(*steps: tuple[Column, object], otherwise: object) -> Column:
    """First matching condition wins."""
    chain = reduce(lambda c, s: c.when(*s), steps[1:], F.when(*steps[0]))
    return chain.otherwise(otherwise)


def verdict(good: Column, bad: str = V.CRITICAL) -> Column:
    """PASS where ``good`` is true; where it is false or NULL, ``bad``."""
    return F.when(good, V.PASS).otherwise(bad)


def one_row(*frames: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Put aggregates with different columns side by side, one row in all or per ``by``.

    Each column is set in one of the frames only, so a union followed by ``max``
    does it: no join, and nothing but the aggregated rows to move.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    measures = [c for c in stacked.columns if c not in by]
    return stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in measures])


def stack_rows(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def listed(*texts: Column) -> Column:
    """Array of the texts that are not NULL."""
    return F.array_compact(F.array(*texts))
