"""Guard against clocks that run ahead: one record from the far future would make all others late."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Event time may run ahead of arrival by this: a producer that does not wait between ticks is hours ahead.
TOLERANCE = "1 day"


def hold(records: DataFrame, tolerance: str = TOLERANCE, time: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Records whose event time is at most ``tolerance`` ahead of their arrival, and the others.

    The watermark follows the greatest event time, and stateful operators drop what is behind it. Give them the first
    frame, without a watermark so far; land the second as a table of its own. Every record is in one of the two; those without
    time are in the first. Arrival is the time of a stream's batch, which its offset log keeps, so a batch that is
    repeated is parted alike. On a table it is the time of the query.
    """
    ahead = F.coalesce(F.col(time) > F.current_timestamp() + F.expr(f"INTERVAL {tolerance}"), F.lit(False))
    return records.where(~ahead), records.where(ahead)
