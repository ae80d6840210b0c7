from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column | str) -> Column:
    """Trim (spaces only, like Spark's ``trim``) and turn the empty string into NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.trim(c), F.lit(""))
