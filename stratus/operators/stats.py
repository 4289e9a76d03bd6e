"""Exact quantiles without gathering a group in one task, in two passes over the input.

``percentile`` keeps every distinct value of a group in one hash map that is
finally merged by a single task, so a metric holding a third of all readings
would be one huge task. Here the order statistics are found by selection:

1. one aggregate gives each group's size and a mergeable KLL sketch of its
   values (a few thousand numbers, however large the group). For a wanted rank
   the sketch names a band of values that holds it: the ranks on either side are
   taken ``MARGIN`` apart, four times the sketch's 99 % rank error;
2. a second pass counts the values inside the bands by value, and all values
   between two bands as one row. These rows (``banded``) are a small weighted
   copy of the group in which every wanted rank falls on an exact value;
3. running counts over buckets of that copy leave a few values to sort, so no
   task sorts a hot group. Buckets are cut by a logarithmic scale and, between
   the group's least and greatest value, by a linear one: long tails and values
   that lie close together are both taken apart;
4. the values at the ranks are interpolated linearly
   (``lo + (hi - lo) * (h - floor(h))``, the PERCENTILE_CONT definition).

The result is exact or none: should a rank fall between the bands (by the
sketch's error bound less than once in 10^20 groups), the query fails instead of
answering. Everything is lazy and nothing is stored: building a query runs no
job. NULL and NaN values are ignored; a group without values gets no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets per factor e, and between the least and the greatest value of a group.
COARSE, PARTS = 4096, 1 << 16
#: Size of a sketch; its rank error (99 %) is 2.296 / k^0.9021 by the sketch's documentation.
SKETCH_K = 1024
MARGIN = 4 * 2.296 / SKETCH_K**0.9021


def number(value: str | Column) -> Column:
    """The value as a double, NaN as NULL."""
    c = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def coarse_bucket(v: Column) -> Column:
    """A number that never falls as ``v`` grows; infinities come first and last."""
    # 750 more than the logarithm is positive for every double; zero has no logarithm and lies between the signs
    x = F.coalesce(F.signum(v) * (F.ln(F.abs(v)) + F.lit(750.0)), F.lit(0.0))
    return F.floor(F.greatest(F.least(x, F.lit(1e6)), F.lit(-1e6)) * COARSE).cast("long")


def part_of_range(v: Column, lo: Column, hi: Column) -> Column:
    """Part of [lo, hi] that ``v`` lies in, never falling as ``v`` grows; a range of one value or without end has one part."""
    wide = hi - lo
    return F.when((wide > 0) & (wide < F.lit(float("inf"))), F.floor((v - lo) / wide * F.lit(float(PARTS - 1))).cast("int")).otherwise(F.lit(0))


def _ranks(n: Column, probs: list[float]) -> list[tuple[Column, Column]]:
    h = [(n - 1).cast("double") * F.lit(float(p)) for p in probs]
    return [(F.floor(x), F.ceil(x)) for x in h]


def _holding(counts: DataFrame, within: list[str], by: list[str], start: Column, n: Column, probs: list[float]) -> DataFrame:
    """``counts`` with the ranks [__start, __end) of each row and the group size ``__n``; only rows that hold a wanted rank."""
    before = Window.partitionBy(*within).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    out = counts.withColumns({"__start": start + F.coalesce(F.sum("__c").over(before), F.lit(0)), "__n": n})
    out = out.withColumn("__end", F.col("__start") + F.col("__c"))
    wanted = F.lit(False)
    for lo, hi in _ranks(F.col("__n"), probs):
        for r in (lo, hi):
            wanted = wanted | ((F.col("__start") <= r) & (r < F.col("__end")))
    return out.filter(wanted)


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where NULL equals NULL; keeps the left copies."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = None
    for c in on:
        one = left[c].eqNullSafe(renamed[f"__r_{c}"])
        cond = one if cond is None else cond & one
    return left.join(renamed, cond, how).drop(*[f"__r_{c}" for c in on])


def sketched(df: DataFrame, keys: list[str], value: str | Column, probs: list[float], *more: Column) -> DataFrame:
    """First pass: one row per group with its size ``__n``, ``__min`` and ``__max``, a band ``__lo<i>``..``__hi<i>`` for each
    probability, and whatever ``more`` aggregates."""
    v = number(value)
    g = df.groupBy(*keys).agg(
        F.count(v).alias("__n"), F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias("__k"), F.min(v).alias("__min"), F.max(v).alias("__max"), *more
    )
    ends = [e for p in probs for e in (p - MARGIN - 2 / SKETCH_K, p + MARGIN + 2 / SKETCH_K)]
    ranks = F.array(*[F.lit(min(max(e, 0.0), 1.0)) for e in ends])
    # a small group is all band, and beyond the first and last rank a band is open
    g = g.withColumn("__q", F.when(F.col("__n") > SKETCH_K, F.kll_sketch_get_quantile_double("__k", ranks)))
    far = [float("-inf"), float("inf")]
    bands = {}
    for i, e in enumerate(ends):
        found = F.col("__q")[i] if 0 < e < 1 else F.lit(None).cast("double")
        bands[f"__{'hi' if i % 2 else 'lo'}{i // 2}"] = F.coalesce(found, F.lit(far[i % 2]))
    return g.withColumns(bands).drop("__k", "__q")


def banded(df: DataFrame, keys: list[str], value: str | Column, bounds: DataFrame, n_bands: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """Second pass: the weighted copy of each group (``__v`` or, between bands, the ends ``__v``..``__top``; ``__c`` rows).

    ``bounds`` has the columns of :func:`sketched`. Rows between bands carry ``__open``; rows without a value
    are one row with a NULL ``__v``. Every row has its group's size and the ``carried`` columns of ``bounds``:
    as grouping keys, so that all readers of the copy share one shuffle whichever columns they need.
    """
    base = df.select(*keys, number(value).alias("__x"))
    carried = ("__n", "__min", "__max", *carried)
    named = bounds.select(*keys, *carried, *[f"__{e}{i}" for i in range(n_bands) for e in ("lo", "hi")])
    x, inside, passed = F.col("__x"), F.lit(False), F.lit(0)
    for i in range(n_bands):
        inside = inside | x.between(F.col(f"__lo{i}"), F.col(f"__hi{i}"))
        passed = passed + (F.col(f"__hi{i}") < x).cast("int")
    rows = null_safe_join(base, named, keys)
    at, gap = F.when(inside, x).alias("__at"), F.when(~inside, passed).alias("__gap")
    rows = rows.groupBy(*keys, *carried, at, gap).agg(F.min(x).alias("__v"), F.max(x).alias("__top"), F.count(F.lit(1)).alias("__c"))
    # true of every row: it names all columns, so that each reader of the copy asks for the same shuffle
    rows = rows.filter((F.col("__c") > 0) & (F.col("__v").isNull() | (F.col("__v") <= F.col("__top"))))
    return rows.select(*keys, *carried, "__v", "__top", "__c", F.col("__gap").isNotNull().alias("__open"))


def quantiles_of(copy: DataFrame, keys: list[str], probs: list[float], names: list[str]) -> DataFrame:
    """Third step: the quantiles of the groups whose weighted copy is ``copy``."""
    bucket = {"__b": coarse_bucket(F.col("__v")), "__f": part_of_range(F.col("__v"), F.col("__min"), F.col("__max"))}
    base = copy.filter(F.col("__v").isNotNull()).select(*keys, "__v", "__top", "__c", "__n", "__open", *[c.alias(n) for n, c in bucket.items()])
    counts = base.groupBy(*keys, *bucket).agg(F.sum("__c").alias("__c"), F.first("__n").alias("__n"))
    first = _holding(counts, keys, list(bucket), F.lit(0), F.col("__n"), probs).select(*keys, *bucket, F.col("__start").alias("__s"))

    values = null_safe_join(base, first, [*keys, *bucket])
    ranked = _holding(values, [*keys, *bucket], ["__v"], F.col("__s"), F.col("__n"), probs)
    sure = F.when(F.col("__open"), F.raise_error(F.lit("a quantile lies outside of its sketched band; run the query again"))).otherwise(F.col("__v"))

    aggs = [F.first("__n").alias("__n")]
    for i, (lo, hi) in enumerate(_ranks(F.col("__n"), probs)):
        for end, r in (("lo", lo), ("hi", hi)):
            aggs.append(F.max(F.when((F.col("__start") <= r) & (r < F.col("__end")), sure)).alias(f"__{end}{i}"))
    picked = ranked.groupBy(*keys).agg(*aggs)

    out = []
    for i, p in enumerate(probs):
        h = (F.col("__n") - 1).cast("double") * F.lit(float(p))
        frac = h - F.floor(h)
        lo_v, hi_v = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        out.append(F.when(frac == 0, lo_v).otherwise(lo_v + (hi_v - lo_v) * frac).alias(names[i]))
    return picked.select(*keys, *out)


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str | Column,
    probs: list[float],
    names: list[str] | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """One row per group of ``keys`` with one exact, interpolated quantile column
    per probability (named ``names`` or ``q0, q1, ...``)."""
    names = names or [f"q{i}" for i in range(len(probs))]
    first = sketched(df, keys, value, probs)
    copy = banded(df, keys, value, F.broadcast(first) if few_groups else first, len(probs))
    return quantiles_of(copy, keys, probs, names)


def with_quantiles(
    df: DataFrame, keys: list[str], value: str | Column, probs: list[float], names: list[str], *more: Column, few_groups: bool = False
) -> DataFrame:
    """The groups with ``__rows``, ``__n`` (values), ``__min``, ``__max``, the aggregates ``more`` and the
    quantiles, in two passes over ``df``; a group without values has NULLs.

    ``few_groups`` says that the keys come from a list of fixed length (metrics, columns): the bands are then
    broadcast, otherwise their join is left to the planner's size check. All figures are read off the weighted copy.
    """
    first = sketched(df, keys, value, probs, *more)
    carried = tuple(c for c in first.columns if c not in keys and not c.startswith("__"))
    copy = banded(df, keys, value, F.broadcast(first) if few_groups else first, len(probs), carried)
    found = quantiles_of(copy, keys, probs, names)
    groups = copy.groupBy(*keys, "__n", "__min", "__max", *carried).agg(F.sum("__c").alias("__rows"))
    found = F.broadcast(found) if few_groups else found
    return null_safe_join(groups, found, keys, "left")


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float], names: list[str] | None = None) -> DataFrame:
    """Exact quantiles of several columns at once: the columns are stacked into
    (column, value) rows and the column name becomes the group key."""
    stacked = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    return exact_quantiles(stacked, ["column"], "value", probs, names, few_groups=True)


# ------------------------------------------------------------------ moments


def moments(v: Column) -> list[Column]:
    """Aggregates ``__n``, ``__mean`` and ``__m2`` (sum of squared deviations from the mean) of a group.

    Such triples of parts can be combined to those of the whole (:func:`combined_moments`).
    """
    n = F.count(v)
    return [n.alias("__n"), F.avg(v).alias("__mean"), (F.var_pop(v) * n).alias("__m2")]


def combined_moments(parts: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """``__n``, ``__mean`` and sample deviation ``__std`` per group of ``keys``, from the moments of its parts.

    The squared deviations of a group are those within its parts plus those of the parts' means from the
    group's mean, so nothing is lost to cancellation. ``parts`` has few rows per group.
    """
    n, mean = F.col("__n"), F.col("__mean")
    group = Window.partitionBy(*keys)
    whole = F.sum(n * mean).over(group) / F.sum(n).over(group)
    g = parts.withColumn("__d", mean - whole).groupBy(*keys).agg(
        F.sum(n).alias("__n"),
        (F.sum(n * mean) / F.sum(n)).alias("__mean"),
        F.sum(F.col("__m2") + n * F.col("__d") * F.col("__d")).alias("__m2"),
        *more,
    )
    return g.withColumn("__std", F.when(F.col("__n") > 1, F.sqrt(F.col("__m2") / (F.col("__n") - 1))))
