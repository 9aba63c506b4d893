"""Matching of a stream of records against a standing source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.plans.pipeline import normalized_records


def match_stream(records: DataFrame, s1: DataFrame, block: Callable[[DataFrame, DataFrame], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Block each micro-batch of target records against s1 (normalized), and hand the pairs and the batch's number to `write`.

    A batch that runs again after a failure has the same number, so `write` can be made to write once.
    """

    def work(batch: DataFrame, number: int) -> None:
        write(block(s1, normalized_records(batch)), number)

    return records.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
