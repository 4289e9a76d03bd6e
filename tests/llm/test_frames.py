"""Helpers: what Python workers keep between tasks, batch sizes, partial results joined step by step."""

import numpy as np
import pyarrow as pa

from stratus.llm import frames


def test_tasks_of_another_kind_free_the_caches():
    cache = frames.task_cache()
    frames.begin_task("one")
    cache["x"] = 1
    frames.begin_task("one")
    assert cache == {"x": 1}
    frames.begin_task("two")
    assert cache == {}


def test_batches_are_split_and_gathered():
    batch = pa.record_batch({"t": ["x" * 1000] * 9000})
    split = list(frames.parts(iter([batch])))
    assert sum(b.num_rows for b in split) == 9000 and all(b.nbytes < 1.2 * frames.PART_BYTES for b in split) and len(split) > 1
    back = list(frames.gathered(iter(split), 6 << 20))
    assert sum(b.num_rows for b in back) == 9000 and all(b.nbytes >= 6 << 20 for b in back[:-1])
    assert list(frames.gathered(iter([]), 10)) == []


def test_batch_bound_is_kept_or_lowered(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, 1 << 20)
        frames.bound_batches(spark)
        assert spark.conf.get(key).rstrip("b") == str(1 << 20)
        spark.conf.set(key, 64 << 20)
        frames.bound_batches(spark)
        assert spark.conf.get(key).rstrip("b") == str(frames.PART_BYTES)
    finally:
        spark.conf.set(key, before)


def test_partial_results_come_down_to_one(spark):
    def add(key, table):
        assert table.num_rows <= frames.FAN_IN
        return pa.table({"part": [key[0].as_py()], "x": [int(np.sum(table.column("x").to_numpy()))]})

    for n in (1, 16, 17, 300):
        df = spark.range(n).selectExpr("id AS part", "id + 1 AS x")
        got = frames.down_to_one(df, frames.Scratch(spark), add, "part long, x long")
        assert got["x"] == n * (n + 1) // 2
