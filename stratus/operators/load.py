"""Star-schema load: dimension merge/upsert, idempotent fact load, keys.

Loads are expressed as set algebra over DataFrames and written beside the
table, never in place: a plan that reads the current rows and writes the next
ones cannot corrupt what it reads, and a failed or lost job leaves the table
untouched. ``publish`` flips a small pointer file, ``upsert_partitions`` renames
whole partition folders, and only after the new rows are completely written.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus import storage
from stratus.functions import to_fact_value
from stratus.schemas import NATURAL_KEY

DIM_ATTRS = ["station_code", "station_name", "location_type", "description"]


# ---------------------------------------------------------------------- L1


def merge_dim(existing: DataFrame, new: DataFrame, key: str = "station_pk") -> DataFrame:
    """L1: existing rows plus the new batch, the batch winning per key.

    Inside the batch the first row of a key wins (the batch is de-duplicated
    before it is merged); between the two, the batch replaces the existing
    row. A min over a (batch, position, attributes) struct per key picks the
    winner with a map-side combinable aggregate.
    """
    cols = [key] + DIM_ATTRS
    # batch rows rank before existing ones (__b), inside the batch the input order (__i)
    e = existing.select(*cols).withColumn("__b", F.lit(1)).withColumn("__i", F.lit(0).cast("long"))
    n = new.select(*cols).withColumn("__b", F.lit(0)).withColumn("__i", F.monotonically_increasing_id())
    both = e.unionByName(n)
    packed = F.struct(F.col("__b"), F.col("__i"), *[F.col(c) for c in DIM_ATTRS])
    first = both.groupBy(key).agg(F.min(packed).alias("__r"))
    return first.select(key, *[F.col(f"__r.{c}").alias(c) for c in DIM_ATTRS]).orderBy(key)


# ---------------------------------------------------------------------- L6


def seed_dim(stations: DataFrame, now: Column) -> DataFrame:
    """Initial dimension rows with the warehouse defaults."""
    return stations.select(
        F.col("station_pk").cast("int").alias("station_pk"),
        "station_code",
        "station_name",
        "location_type",
        F.lit(None).cast("decimal(10,6)").alias("latitude"),
        F.lit(None).cast("decimal(10,6)").alias("longitude"),
        F.lit(None).cast("decimal(8,2)").alias("elevation"),
        "description",
        F.lit(True).alias("is_active"),
        now.cast("timestamp_ntz").alias("created_at"),
        now.cast("timestamp_ntz").alias("updated_at"),
    )


# ---------------------------------------------------------------------- L3


def upsert_dim(current: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """L3: update attributes (and ``updated_at``) of known keys, insert new keys
    with defaults, keep the others unchanged. Output has a ``__change``
    column: 'updated', 'inserted' or 'unchanged' (see ``dim_load_stats``).

    A key that the batch holds several times is applied once, with its last
    row. A side is present or not by a flag of its own, whatever its attributes."""
    at = F.struct(F.monotonically_increasing_id().alias("__i"), *[F.col(c).alias(f"__n_{c}") for c in DIM_ATTRS])
    last = batch.select(F.col("station_pk").cast("int").alias("station_pk"), at.alias("__r")).groupBy("station_pk").agg(F.max("__r").alias("__r"))
    b = last.select("station_pk", *[F.col(f"__r.__n_{c}").alias(f"__n_{c}") for c in DIM_ATTRS], F.lit(True).alias("__new"))
    j = current.withColumn("__cur", F.lit(True)).join(b, "station_pk", "full_outer")
    in_cur, in_new = F.col("__cur").isNotNull(), F.col("__new").isNotNull()
    change = (
        F.when(in_cur & in_new, F.lit("updated")).when(in_new, F.lit("inserted")).otherwise(F.lit("unchanged"))
    )
    j = j.withColumn("__change", change)
    is_new = F.col("__change") != "unchanged"
    nowc = now.cast("timestamp_ntz")
    out = j.select(
        "station_pk",
        *[F.when(is_new, F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c) for c in ["station_code", "station_name", "location_type"]],
        "latitude",
        "longitude",
        "elevation",
        F.when(is_new, F.col("__n_description")).otherwise(F.col("description")).alias("description"),
        F.when(F.col("__change") == "inserted", F.lit(True)).otherwise(F.col("is_active")).alias("is_active"),
        F.when(F.col("__change") == "inserted", nowc).otherwise(F.col("created_at")).alias("created_at"),
        F.when(is_new, nowc).otherwise(F.col("updated_at")).alias("updated_at"),
        "__change",
    )
    return out


def dim_load_stats(upserted: DataFrame, batch: DataFrame) -> DataFrame:
    """L4 (dimension): inserted, updated and total stations of the batch."""
    c = upserted.agg(
        F.count(F.when(F.col("__change") == "inserted", 1)).alias("stations_inserted"),
        F.count(F.when(F.col("__change") == "updated", 1)).alias("stations_updated"),
    )
    return c.select("*", batch.agg(F.count(F.lit(1))).scalar().alias("total_stations"))


# ---------------------------------------------------------------- L2, J6, L4


def to_fact_rows(tall: DataFrame) -> DataFrame:
    """Tall rows -> warehouse fact columns (P17 on the value)."""
    return tall.select(
        F.col("station_pk").cast("int").alias("station_fk"),
        F.col("datetime").cast("timestamp_ntz").alias("timestamp"),
        "metric",
        to_fact_value(F.col("value")).alias("value"),
        "unit",
        "source",
        "quality_flag",
    )


#: Folders of the fact table: a load rewrites the months it touches.
PARTITIONS = ("source", "year", "month")


def with_partitions(rows: DataFrame) -> DataFrame:
    """Fact rows with the ``year`` and ``month`` (text) that their folder is named by."""
    return rows.withColumns({"year": F.year("timestamp").cast("string"), "month": F.month("timestamp").cast("string")})


def batch_keys(batch: DataFrame, keys=NATURAL_KEY) -> DataFrame:
    """U4: distinct natural keys of a batch."""
    return batch.select(*keys).distinct()


def _key_match(left: DataFrame, right: DataFrame, keys) -> Column:
    # plain equality: a NULL in any key part never matches (row-value IN semantics)
    cond = None
    for k in keys:
        c = left[k] == right[k]
        cond = c if cond is None else cond & c
    return cond


#: Bits of the key filter: its table has 2**(FILTER_BITS - 6) rows of 16 bytes at most, 2 MB, whatever the batch.
FILTER_BITS = 23


def _slot(df: DataFrame, keys, types: dict) -> Column:
    """Place of a row's key in the filter; NULL for a key with a missing part, which matches nothing."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & df[k].isNotNull()
    hashed = F.xxhash64(*[df[k].cast(types[k]) for k in keys])
    return F.when(whole, hashed.bitwiseAND(F.lit((1 << FILTER_BITS) - 1)))


def key_filter(batch: DataFrame, keys=NATURAL_KEY, types: dict | None = None) -> DataFrame:
    """A Bloom filter of the batch's keys as a table (``__word``, ``__bits``) of bounded size."""
    types = types or {k: batch.schema[k].dataType for k in keys}
    slots = batch.select(_slot(batch, keys, types).alias("__slot")).filter(F.col("__slot").isNotNull())
    return slots.groupBy(F.shiftright("__slot", 6).alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(__slot & 63 AS INT))")).alias("__bits")
    )


def may_be_replaced(current: DataFrame, batch: DataFrame, keys=NATURAL_KEY) -> DataFrame:
    """``current`` with ``__hit``: false where the key is certainly not in the batch.

    The filter is broadcast, so rows that a load leaves alone are recognised where they are read and never
    shuffled; about one in ``2**FILTER_BITS / keys in the batch`` of them is a false hit.
    """
    types = {k: current.schema[k].dataType for k in keys}
    flagged = current.withColumn("__slot", _slot(current, keys, types)).withColumn("__w", F.shiftright("__slot", 6))
    table = F.broadcast(key_filter(batch, keys, types))
    flagged = flagged.join(table, flagged["__w"] == table["__word"], "left")
    hit = F.coalesce(F.getbit("__bits", F.col("__slot").bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(False))
    return flagged.withColumn("__hit", hit).select(*current.columns, "__hit")


def replaced_rows(current: DataFrame, batch: DataFrame, keys=NATURAL_KEY) -> DataFrame:
    """Current rows whose natural key occurs in the batch (to be deleted)."""
    bk = batch_keys(batch, keys)
    hits = may_be_replaced(current, batch, keys).filter("__hit").drop("__hit")
    return hits.join(bk, _key_match(hits, bk, keys), "left_semi")


def upsert_fact(current: DataFrame, batch: DataFrame, keys=NATURAL_KEY) -> DataFrame:
    """L2: remove current rows whose natural key is in the batch, append the batch.

    Only rows that a Bloom filter of the batch's keys lets through are shuffled
    to the exact anti join; all others are kept as they are read. Duplicates
    inside the batch are kept (the duplicate check reports them), and rows with
    a NULL key part are never matched, so re-loading them adds them again - both
    as in the original load.
    """
    bk = batch_keys(batch, keys)
    flagged = may_be_replaced(current, batch, keys)
    others = flagged.filter(~F.col("__hit")).drop("__hit")
    hits = flagged.filter("__hit").drop("__hit")
    kept = hits.join(bk, _key_match(hits, bk, keys), "left_anti")
    return others.unionByName(kept).unionByName(batch.select(*current.columns))


def fact_load_stats(current: DataFrame, batch: DataFrame, keys=NATURAL_KEY) -> DataFrame:
    """L4 (fact): deleted, inserted and resulting total rows of one load.

    Each side is read once: rows are counted per key on both sides together.
    """
    both = current.select(*keys, F.lit(1).alias("__c"), F.lit(0).alias("__b")).unionByName(
        batch.select(*keys, F.lit(0).alias("__c"), F.lit(1).alias("__b"))
    )
    per_key = both.groupBy(*keys).agg(F.sum("__c").alias("__c"), F.sum("__b").alias("__b"))
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return per_key.agg(
        count(F.when(whole & (F.col("__b") > 0), F.col("__c"))).alias("deleted"),
        count(F.col("__b")).alias("inserted"),
        count(F.col("__c")).alias("__current"),
    ).select("deleted", "inserted", (F.col("__current") - F.col("deleted") + F.col("inserted")).alias("total"))


def rows_per_file(df: DataFrame, file_col: str = "file") -> DataFrame:
    """L4: rows per source file (``file`` from ``with_source``)."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows")).orderBy(file_col)


# ---------------------------------------------------------------------- L7


def replace_range(current: DataFrame, batch: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Remove current rows inside the batch's [min, max] time range, append the batch.

    The range is a one-row aggregate used as two scalar subqueries.
    """
    lo = batch.agg(F.min(ts)).scalar()
    hi = batch.agg(F.max(ts)).scalar()
    kept = current.filter(~F.col(ts).between(lo, hi) | F.col(ts).isNull())
    return kept.unionByName(batch.select(*current.columns))


# ---------------------------------------------------------------------- L5


#: Rows of the sample that the bounds of the ranges are taken from, and how many ranges there are at most.
KEY_SAMPLE, KEY_RANGES = 4096, 512


def range_bounds(df: DataFrame, names: list[str], ranges: int, sample_rows: int = KEY_SAMPLE) -> list[tuple]:
    """Values that cut the rows, in the order of ``names``, into about equal ranges.

    They come from a uniform sample of ``sample_rows`` rows, which only decides how even the ranges are.
    """
    rows = [tuple(r) for r in df.select(*names).orderBy(F.rand(17)).limit(sample_rows).collect()]
    rows.sort(key=lambda r: [(v is None, v != v, 0 if v is None or v != v else v) for v in r])
    return list(dict.fromkeys(rows[len(rows) * i // ranges] for i in range(1, ranges))) if rows else []


def short_bounds(bounds: list[tuple]) -> list[tuple]:
    """Each bound cut to the shortest beginning that tells it from the bounds beside it.

    A bound moves to where the rows of its beginning start, which is still after the bound before it: no range
    takes in more than two. Comparisons become few, mostly one column each.
    """
    out = []
    for i, bound in enumerate(bounds):
        beside = bounds[max(i - 1, 0) : i] + bounds[i + 1 : i + 2]
        n = next((n for n in range(1, len(bound)) if all(b[:n] != bound[:n] for b in beside)), len(bound))
        out.append(bound[:n])
    return out


def range_of(df: DataFrame, names: list[str], bounds: list[tuple]) -> Column:
    """Number of the range a row lies in, by a tree of comparisons with the bounds (ascending, NULLs last).

    A row is compared column by column, as far as it takes: building a struct of all columns for each comparison
    was most of the work of :func:`assign_keys`.
    """
    bounds = short_bounds(bounds)

    def below(bound: tuple) -> Column:
        out = F.lit(False)
        for n, v in reversed(list(zip(names, bound))):
            c, x = F.col(n), F.lit(v).cast(df.schema[n].dataType)
            out = c.isNotNull() | out if v is None else (c < x) | ((c == x) & out)  # a NULL is not below a value
        return F.coalesce(out, F.lit(False))

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(below(bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds))


def assign_keys(
    df: DataFrame,
    order: list[str | Column],
    start: int | Column = 0,
    key: str = "measurement_pk",
    partitions: int | None = None,
) -> DataFrame:
    """Dense surrogate keys ``start + 1, start + 2, ...`` in ``order`` (columns, ascending, NULLs last).

    Rows are dealt to ranges of the order by bounds that are literals of the
    plan, counted per range, and numbered inside their range after the rows of
    the ranges before. No global window and nothing stored: which range a row is
    in depends on the row alone, so counts and numbers agree however often a
    task is run again. The bounds come from a sample taken when the query is
    built (:func:`range_bounds`). Rows that tie on every order column are
    interchangeable, so the result is deterministic as a set.
    """
    names = df.select(*order).columns
    ranges = min(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), KEY_RANGES)
    part = range_of(df, names, range_bounds(df, names, ranges))
    ranged = df.withColumn("__p", part)
    counts = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__p").alias("__q"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy("__p").orderBy(*[F.asc_nulls_last(n) for n in names])
    numbered = ranged.withColumn("__pos", F.row_number().over(inside))
    base = start if isinstance(start, Column) else F.lit(start)
    # one row for each range, KEY_RANGES at most
    out = numbered.join(F.broadcast(offsets), numbered["__p"] == F.col("__q")).withColumn(
        key, (base.cast("long") + F.col("__off") + F.col("__pos")).cast("long")
    )
    return out.drop("__p", "__q", "__pos", "__off")


def next_key_start(current: DataFrame, key: str = "measurement_pk") -> Column:
    """Largest existing key (0 for an empty table) as a scalar subquery."""
    return current.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()


# ------------------------------------------------------------- publishing


def new_version_path(root: str) -> str:
    return os.path.join(root, f"v-{uuid.uuid4().hex}")


def publish(df: DataFrame, root: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write ``df`` as a new version under ``root`` and point ``_CURRENT`` at it."""
    path = new_version_path(root)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    storage.replace_text(df.sparkSession, os.path.join(root, "_CURRENT"), json.dumps({"path": path}))
    return path


def current_version(spark: SparkSession, root: str) -> str | None:
    text = storage.read_text(spark, os.path.join(root, "_CURRENT"))
    return None if text is None else json.loads(text)["path"]


def read_current(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    path = current_version(spark, root)
    if path is None:
        return None
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(path)


# ------------------------------------------------- partition-scoped upsert


SWAP = "_swap-"


def upsert_partitions(
    spark: SparkSession,
    table_dir: str,
    batch: DataFrame,
    partition_cols: tuple[str, ...] = ("source", "year"),
    keys=NATURAL_KEY,
    drop: Column | None = None,
    gate: Callable[[DataFrame], None] | None = None,
) -> list[tuple]:
    """L2 at scale: rewrite only the table partitions the batch touches.

    The table is Parquet partitioned by ``partition_cols``. The batch's
    partition values become a literal filter, so the scan of the current table
    is pruned to the touched partitions. Their next rows are written to a hidden
    folder of the table; ``gate`` may look at them and raise, which leaves the
    table as it was. Then each old partition folder is renamed away and the new
    one renamed into its place. A load that dies between two renames is
    finished or undone by the next one (``recover_partitions``). Untouched
    partitions are neither read nor rewritten. ``drop`` marks current rows to
    leave out (those of an attempt that is repeated). Returns the touched
    partition values.
    """
    recover_partitions(spark, table_dir, len(partition_cols))
    touched = [tuple(r) for r in batch.select(*partition_cols).distinct().toLocalIterator()]
    if not touched:
        return []
    new_rows = batch
    if current_table_exists(spark, table_dir):
        cond = F.lit(False)
        for values in touched:
            one = F.lit(True)
            for c, v in zip(partition_cols, values):
                one = one & (F.col(c).isNull() if v is None else (F.col(c) == F.lit(v)))
            cond = cond | one
        current = spark.read.parquet(table_dir).filter(cond)
        # folder names are read as numbers where they look like some
        current = current.withColumns({c: F.col(c).cast(batch.schema[c].dataType) for c in partition_cols})
        if drop is not None:
            current = current.filter(~F.coalesce(drop, F.lit(False)))
        new_rows = upsert_fact(current, batch.select(*current.columns), keys)
    swap = os.path.join(table_dir, f"{SWAP}{uuid.uuid4().hex}")
    fresh = os.path.join(swap, "new")
    new_rows.write.partitionBy(*partition_cols).parquet(fresh)
    if gate is not None:
        try:
            gate(spark.read.parquet(fresh))
        except BaseException:
            storage.remove(spark, swap)
            raise
    largest = None
    if "measurement_pk" in batch.columns:  # noted beside the table, so that the next load need not look for it
        largest = spark.read.parquet(fresh).agg(F.max("measurement_pk")).first()[0]
    known = largest_key(spark, table_dir) if largest is not None else None
    storage.replace_text(spark, os.path.join(swap, "_READY"), "")  # from here on the load goes through
    if largest is not None:
        storage.replace_text(spark, os.path.join(table_dir, MAX_KEY), str(max(largest, known or 0)))
    _swap_in(spark, table_dir, swap, len(partition_cols))
    return touched


#: File in a table's folder that names a key no smaller than any in the table.
MAX_KEY = "_MAX_KEY"


def largest_key(spark: SparkSession, table_dir: str) -> int:
    """The key that new ones follow: as noted by the last load, else the largest in the table; 0 for none."""
    noted = storage.read_text(spark, os.path.join(table_dir, MAX_KEY))
    if noted is not None:
        return int(noted)
    if not current_table_exists(spark, table_dir):
        return 0
    return spark.read.parquet(table_dir).agg(F.coalesce(F.max("measurement_pk"), F.lit(0)).cast("long")).first()[0]


def _partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    found = [""]
    for _ in range(depth):
        found = [os.path.join(f, x) for f in found for x in storage.folders(spark, os.path.join(path, f)) if "=" in x]
    return found


def _swap_in(spark: SparkSession, table_dir: str, swap: str, depth: int) -> None:
    for part in _partition_folders(spark, os.path.join(swap, "new"), depth):
        live, old = os.path.join(table_dir, part), os.path.join(swap, "old", part)
        if storage.exists(spark, live) and not storage.exists(spark, old):
            storage.move(spark, live, old)
        storage.move(spark, os.path.join(swap, "new", part), live)
    storage.remove(spark, swap)


def recover_partitions(spark: SparkSession, table_dir: str, depth: int) -> None:
    """Finishes loads that were completely written, and removes what others left."""
    for name in storage.folders(spark, table_dir):
        if name.startswith(SWAP):
            swap = os.path.join(table_dir, name)
            if storage.exists(spark, os.path.join(swap, "_READY")):
                _swap_in(spark, table_dir, swap, depth)
            else:
                storage.remove(spark, swap)


def current_table_exists(spark: SparkSession, table_dir: str) -> bool:
    return storage.holds_data(spark, table_dir)


class IntegrityError(ValueError):
    """Rows that a load must not publish."""


def integrity_gate(dim: DataFrame, keys=NATURAL_KEY) -> Callable[[DataFrame], None]:
    """A check for ``upsert_partitions``: raises on orphans, repeated keys or missing key parts."""

    def check(rows: DataFrame) -> None:
        missing = rows.agg(*[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys]).first().asDict()
        orphans = rows.join(dim, rows["station_fk"] == dim["station_pk"], "left_anti").where("station_fk IS NOT NULL")
        found = missing | {
            "orphans": orphans.count(),
            "duplicate_keys": rows.groupBy(*keys).count().where("count > 1").count(),
        }
        if any(found.values()):
            raise IntegrityError(f"load stopped, table unchanged: {found}")

    return check
