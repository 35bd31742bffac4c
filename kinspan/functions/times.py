"""Record times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_millis(text: Column) -> Column:
    """Epoch milliseconds of `yyyy-MM-dd HH:mm:ss[.fraction]` in the session zone, else NULL."""
    whole = F.substring_index(text, ".", 1)
    return F.unix_millis(F.try_to_timestamp(whole, F.lit(TIME_FORMAT)))
