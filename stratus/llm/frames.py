"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that further columns of any name cannot clash."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name in df.columns:
        name += "_"
    return name


_last_task: list[str] = []
_kept: list[dict] = []


def task_cache() -> dict:
    """A dictionary of a module for what its tasks make once for each Python worker; see :func:`begin_task`."""
    cache: dict = {}
    _kept.append(cache)
    return cache


def begin_task(name: str) -> None:
    """Called by a task before its first batch: what tasks of another kind have left in this worker is freed.

    Python workers live on between the stages of a job. Their caches and the memory that their allocators hold
    back would otherwise add up over the stages of a pipeline.
    """
    if _last_task and _last_task[0] != name:
        for cache in _kept:
            cache.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass
    _last_task[:] = [name]


PART_BYTES = 4 << 20


_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``PART_BYTES`` in this session (a longer row alone), unless it asks for smaller ones.

    The default of 64 MB is held several times for each task, beside the JVM's heap.
    """
    now = int(spark.conf.get(_BATCH_CONF).rstrip("b"))
    if not 0 < now <= PART_BYTES:
        spark.conf.set(_BATCH_CONF, PART_BYTES)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``PART_BYTES`` (a longer row alone)."""
    for batch in batches:
        step = max(1, batch.num_rows * PART_BYTES // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at least ``least`` bytes, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= least:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def with_results(
    df: DataFrame, added: list[tuple[str, T.DataType]], per_batch: Callable[[pa.RecordBatch], dict[str, object]], gather: int = 0
) -> DataFrame:
    """``df`` with the columns that ``per_batch`` computes for each Arrow batch.

    An input column that has the name of an added one is replaced. No shuffle:
    each task streams its batches, and a lost task is simply run again. Large
    batches are taken in parts of about ``PART_BYTES``, which bounds what a
    worker holds besides the batch; with ``gather`` they are put together to
    so many bytes instead, for work that has a price per batch.
    """
    bound_batches(df.sparkSession)
    names = [n for n, _ in added]
    keep = [f for f in df.schema.fields if f.name not in names]
    out = T.StructType([*keep, *[T.StructField(n, t) for n, t in added]])

    whole = getattr(per_batch, "func", per_batch)
    name = f"{whole.__module__}.{whole.__qualname__}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(name)
        for batch in gathered(batches, gather) if gather else parts(batches):
            new = per_batch(batch)
            cols = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            made = [x if isinstance(x, pa.Array) else pa.array(x) for x in (new[n] for n in names)]
            yield pa.RecordBatch.from_arrays([*cols, *made], names=[f.name for f in out.fields])

    return df.mapInArrow(run, out)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A folder set with ``setCheckpointDir`` counts as well. Only a local session
    that names none gets a scratch folder of its own; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="stratus-")
    spark.sparkContext.setCheckpointDir(own)
    return own


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs no more than its tasks."""

    def __init__(self, spark: SparkSession) -> None:
        bound_batches(spark)
        self.spark = spark
        self.path = f"{shared_folder(spark)}/stratus-{uuid.uuid4().hex}"
        self.count = 0
        self.tables: dict[str, DataFrame] = {}

    def store(self, df: DataFrame, compression: str = "snappy", **options: object) -> DataFrame:
        """``df`` as a written table, read again: its lineage ends here."""
        self.count += 1
        path = f"{self.path}/{self.count}"
        df.write.options(compression=compression, **options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.tables[path] = out
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes stored tables that nothing reads any more."""
        for path in [p for p, t in self.tables.items() if any(t is x for x in tables)]:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
            del self.tables[path]

    def drop_all(self, but: list[DataFrame]) -> None:
        self.drop(*[t for t in self.tables.values() if not any(t is x for x in but)])


def small_side(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most_rows`` rows; else Spark's own choice holds.

    For narrow rows of fixed width, whose number bounds their size. ``df`` is a stored table: it is counted here.
    """
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


FAN_IN = 16


def down_to_one(df: DataFrame, scratch: Scratch, group: Callable, schema: str) -> dict:
    """Partial results of partitions, one row each, as one row: ``group`` joins at most ``FAN_IN`` in a task.

    ``df`` has a column ``part`` that numbers the partitions; ``group`` takes (key, table) and gives one row.
    """
    df = scratch.store(df)
    while df.count() > 1:
        df = scratch.store(df.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("part").applyInArrow(group, schema))
    return df.first().asDict()
