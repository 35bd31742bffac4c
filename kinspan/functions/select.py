"""Selection after costly expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_where(df: DataFrame, condition: Column, *columns: Column) -> DataFrame:
    """`columns` of the rows that meet `condition`, where the condition reads a computed column.

    Spark pushes a filter below the projection that computes its input, say the split of a line,
    and then computes that twice. A generator that yields one row or none is left in place.
    """
    return df.select(F.inline(F.when(condition, F.array(F.struct(*columns)))))
