"""Continuous upsert of a bronze stream into a silver table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.dedupe import dedupe_latest
from stratalake.operators.table_merge import upsert_table
from stratalake.sources.staging import stage, staged_for_load
from stratalake.sources.tables import Lakehouse


def start_stream_upsert(
    lake: Lakehouse,
    table: str,
    arrivals: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    checkpoint: str,
    layer: str = "silver",
    newer_by: Sequence[str] = ("imported_date", "source_file"),
) -> StreamingQuery:
    """Merge each micro-batch's newest rows per key; the table sees only new arrivals.

    A row of the table that is newer than the batch's by ``newer_by`` stays, as
    arrival times may come from the data. Columns the table lacks do not decide.
    A batch of new keys is appended; of a table dealt by key only the buckets
    with a key of the batch are rewritten.

    A batch may be offered again after a failure. The table notes the last batch
    of each stream (by the id its checkpoint keeps) when it is merged, and a
    batch that was merged but not noted down changes nothing the second time.
    """

    @cache
    def stream_id() -> str:
        return lake.spark.read.json(f"{checkpoint}/metadata").first()["id"]

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        here = Lakehouse(batch.sparkSession, lake.root, lake.prefix, lake.buckets)
        noted = f"stream.{stream_id()}"
        if int(here.properties(layer, table).get(noted, -1)) >= batch_id:
            return
        with staged_for_load(here.spark):
            newest = stage(dedupe_latest(clean(batch), keys), "stream-upsert")
            columns = here.read_layer(layer, table).columns
            decisive = [c for c in newer_by if c in columns and c in newest.columns]
            upsert_table(here, layer, table, newest, keys, decisive)
        here.set_properties(layer, table, **{noted: batch_id})

    return (
        arrivals.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_upsert(lake: Lakehouse, *args, **kwargs) -> None:
    """``start_stream_upsert``, then wait until the backlog is merged."""
    start_stream_upsert(lake, *args, **kwargs).awaitTermination()
