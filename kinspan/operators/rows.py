"""Missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspan.functions.text import null_if_literal


def null_literals(df: DataFrame, cols: Sequence[str], literal: str = "NULL") -> DataFrame:
    """NULL in place of the text `literal`, in any case, in the given columns."""
    return df.withColumns({c: null_if_literal(F.col(c), literal) for c in cols})
