"""Continuous form of the idempotent fact load (L2 + L5, partition-scoped).

New normalised files arriving in a directory are picked up by a file-source
stream; each micro-batch is loaded with exactly the batch semantics of
``upsert_fact`` (delete matching natural keys, append), but only the
(source, month) partitions the micro-batch touches are read and rewritten
(``upsert_partitions``), so a micro-batch costs the size of its partitions,
not of the table.

A small marker file records the last loaded batch id and, before a batch is
written, the range of keys it is about to hand out. A micro-batch replayed after
it was loaded is skipped; one replayed after a failure gets the same keys again
and first removes what the failed attempt may have written, also rows with a
missing key part, which the upsert by key would not match. New keys continue
from the larger of the marker and the largest key that loads have noted beside
the table, so stream and batch loads can alternate and no load scans the table
for it.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratus import storage
from stratus.operators.load import (
    PARTITIONS,
    assign_keys,
    largest_key,
    recover_partitions,
    to_fact_rows,
    upsert_partitions,
    with_partitions,
)
from stratus.schemas import NATURAL_KEY, TALL

MARKER = "_LOADED"


def fact_path(root: str) -> str:
    return os.path.join(root, "fact")


def _read_marker(spark: SparkSession, root: str) -> dict:
    text = storage.read_text(spark, os.path.join(root, MARKER))
    return {"batch_id": -1, "max_key": 0, "pending": None} if text is None else json.loads(text)


def _write_marker(spark: SparkSession, root: str, **marker) -> None:
    storage.replace_text(spark, os.path.join(root, MARKER), json.dumps(marker))


def load_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """foreachBatch body: upsert one micro-batch of tall rows into ``root/fact``."""
    spark = batch.sparkSession
    marker = _read_marker(spark, root)
    if batch_id <= marker["batch_id"]:
        return  # replay of a batch that was already loaded
    table = fact_path(root)
    rows = with_partitions(to_fact_rows(batch))
    n = rows.count()
    pending, drop = marker["pending"], None
    if pending and pending["batch_id"] == batch_id:
        start = pending["start"]
        drop = F.col("measurement_pk").between(start + 1, start + pending["n"])
    else:
        start = marker["max_key"]
        recover_partitions(spark, table, len(PARTITIONS))
        start = max(start, largest_key(spark, table))
        _write_marker(spark, root, batch_id=marker["batch_id"], max_key=start, pending={"batch_id": batch_id, "start": start, "n": n})
    if n:
        keyed = assign_keys(rows, NATURAL_KEY, start=start).withColumn("created_at", F.current_timestamp().cast("timestamp_ntz"))
        upsert_partitions(spark, table, keyed, PARTITIONS, drop=drop)
    _write_marker(spark, root, batch_id=batch_id, max_key=start + n, pending=None)


def load_stream(
    spark: SparkSession,
    source_dir: str,
    table_root: str,
    checkpoint: str,
    pattern: str = "*.parquet",
    max_files_per_trigger: int = 100,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the continuous load of normalised tall files from ``source_dir``."""
    stream = (
        spark.readStream.schema(TALL)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source_dir)
    )
    w = stream.writeStream.foreachBatch(lambda df, bid: load_batch(df, bid, table_root)).option(
        "checkpointLocation", checkpoint
    )
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
