from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from ebbflow.config import HOUR_FORMAT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: Column | str, data_type: DataType | None = None) -> Column:
    """Text → timestamp with bad values as NULL (never an error, whatever the ANSI setting).

    Typed timestamp columns pass through unchanged.
    """
    if data_type is not None and not isinstance(data_type, StringType):
        return _col(c)
    return F.try_to_timestamp(_col(c))


def hour_floor(ts: Column | str) -> Column:
    return F.date_trunc("hour", _col(ts))


def hour_text(ts: Column | str) -> Column:
    """Hour bucket as sortable text 'yyyy-MM-dd HH:00:00' (wall clock of the session zone)."""
    return F.date_format(hour_floor(ts), HOUR_FORMAT)


def day_of(ts: Column | str) -> Column:
    return F.to_date(_col(ts))


def rounded(c: Column | str, digits: int = 6) -> Column:
    return F.round(_col(c).cast("double"), digits)
