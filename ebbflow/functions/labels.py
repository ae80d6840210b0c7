from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def status_label(balance: Column | str, initial: int) -> Column:
    """'below' / 'above' / 'equal' relative to the initial stock."""
    b = _col(balance)
    return F.when(b < initial, "below").when(b > initial, "above").otherwise("equal")


def alert_message(name: Column | str, balance: Column | str) -> Column:
    """One alert line: '<station name> — <balance> bikes'."""
    return F.concat_ws(" ", _col(name), F.lit("—"), _col(balance).cast("string"), F.lit("bikes"))
