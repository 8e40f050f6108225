"""Expression shapes that stay in code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same rows, with the named columns fixed at this point of the plan.

    A filter on a computed column is pushed below the projection that computes it and repeats the
    whole expression there, once per mention. Rules that build on each other multiply that. Passing
    the columns through a one-element `inline` leaves the filter above and stays in code generation.
    """
    others = [c for c in df.columns if c not in names]
    return df.select(*others, F.inline(F.array(F.struct(*names)))).select(*df.columns)


def present(*texts: Column) -> Column:
    """Array of the non-NULL texts in order. The texts themselves are never empty and hold no unit separator.

    The same as compacting an array, which Spark interprets row by row; joining compiles, and rows
    without any text, nearly all of them, build no array.
    """
    joined = F.concat_ws("\x1f", *texts)
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, "\x1f"))
