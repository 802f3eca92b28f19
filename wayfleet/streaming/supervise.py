"""Fail-fast supervision of several streaming queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def supervise(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Wait until all queries are done; when one fails, stop the others and raise its error.

    Waiting on a single query would leave the job half alive after another one fails.
    """
    running = list(queries)
    try:
        while running:
            try:
                spark.streams.awaitAnyTermination()
            except StreamingQueryException:
                pass  # may belong to a query of someone else in this session; ours are checked next
            spark.streams.resetTerminated()
            ended = [query for query in running if not query.isActive]
            for query in ended:  # what fails from here on is still active above, so the next turn sees it
                error = query.exception()
                if error is not None:
                    raise error
            running = [query for query in running if query not in ended]
    finally:
        for query in running:
            query.stop()
