"""Loading new landing files as they come, with the load the daily run uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import validate
from tallyhouse.plans import daily
from tallyhouse.plans.store import TableStore
from tallyhouse.sources import landing


def load_new_files(
    spark: SparkSession,
    store: TableStore,
    root: str,
    checkpoint: str,
    load_ts: Column | None = None,
) -> None:
    """Load every landing file not loaded before, as one load, then stop.

    ``checkpoint`` remembers the files that were loaded. A load that is repeated after a failure
    adds nothing twice, because facts are inserted only if absent. However many files are new, they
    count in the order of their folders; files that come later are later.

    Files that gave no record go to the store's table ``rejected_files`` with the reason, and the
    load's counters to ``load_counters``, both by ``stream`` (the checkpoint) and ``batch``.
    """
    stamp = F.current_timestamp().cast("timestamp_ntz") if load_ts is None else load_ts
    lines = (
        spark.readStream.option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .text(root)
    )

    def load(batch: DataFrame, number: int) -> None:
        parsed, rejected = landing.parse_files(batch.sparkSession, landing.with_file_columns(batch))
        typed = validate.typed_records(parsed, "retailer", "file_date", "file", "load_seq")
        loaded = daily.load_records(store, typed, stamp, whole_folders=False)
        _keep(store, "rejected_files", rejected, checkpoint, number)
        _keep(store, "load_counters", loaded.counters, checkpoint, number)

    (
        lines.select("value", "_metadata")
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _keep(store: TableStore, table: str, rows: DataFrame, stream: str, batch: int) -> None:
    """Add the rows of a batch, unless an earlier try of it did."""
    before = store.read_if_exists(table)
    if before is not None and not before.where((F.col("stream") == stream) & (F.col("batch") == batch)).isEmpty():
        return
    named = rows.withColumns({"stream": F.lit(stream), "batch": F.lit(batch).cast("long")})
    store.append(table, named)
