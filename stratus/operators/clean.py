"""Raw grid -> clean measurements.

Input is the cell model of a spreadsheet (``stratus.schemas.CELLS``: one row
per non-empty cell with its absolute sheet row and column). Header parsing
only ever touches the first rows of each file (a few cells per column), so the
per-file windows it uses are small; the result is a small mapping frame
``(file, col) -> (station_pk, metric)`` that is broadcast onto the data cells.
Data cells take their row's timestamp by a window over (file, sheet_row), are
cleaned with column expressions and never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from stratus.functions import (
    count_if,
    metric_from_param,
    normalise_station,
    null_sentinels,
    python_strip,
    to_number,
    to_ts,
)
from stratus.schemas import AIR_SENTINELS, POLLUTANT_INDICATORS, STATION_INDICATORS, WIND_SENTINELS

# Timestamp text formats. Air sheets are day-first; wind sheets are read in
# this order (ISO first; ambiguous slash dates month-first).
AIR_TS_FORMATS = ["d/M/yyyy H:mm"]
WIND_TS_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy/MM/dd HH:mm",
    "M/d/yyyy H:mm",
    "yyyy-MM-dd",
]
ISO_TS_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd"]

# Range rules (P11): metric -> (min, max); None means unbounded.
WIND_RANGE_RULES = {"wind_direction": (0.0, 360.0), "wind_speed": (0.0, None)}


def _contains_any(col: Column, needles: list[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | col.contains(n)
    return out


# ----------------------------------------------------------------------- P1


def wind_header(cells: DataFrame, offset: int = 0) -> DataFrame:
    """(file, col, station, param, unit) of a wind sheet.

    Frame rows 2/3/4 hold station / parameter / unit (``offset`` converts
    frame rows to sheet rows: 0 for sheets read without a header row). A blank
    station cell inherits the last station to its left; a column enters the
    mapping when it has a parameter and some station is known.
    """
    h = cells.filter(F.col("sheet_row").between(2 + offset, 4 + offset) & (F.col("col") >= 1))
    txt = F.coalesce(F.col("text"), F.lit(""))
    g = h.groupBy("file", "col").agg(
        F.max(F.when(F.col("sheet_row") == 2 + offset, python_strip(txt))).alias("st"),
        F.max(F.when(F.col("sheet_row") == 3 + offset, python_strip(txt))).alias("param"),
        F.max(F.when(F.col("sheet_row") == 4 + offset, python_strip(txt))).alias("unit"),
    )
    w = Window.partitionBy("file").orderBy("col").rowsBetween(Window.unboundedPreceding, 0)
    st = F.when(F.col("st") != "", normalise_station("st"))
    carried = g.withColumn("station", F.last(st, ignorenulls=True).over(w))
    return carried.filter(
        F.col("param").isNotNull() & (F.col("param") != "") & F.col("station").isNotNull()
    ).select("file", "col", "station", "param", F.coalesce("unit", F.lit("")).alias("unit"))


# ------------------------------------------------------------------ P2, P3


#: Frame rows among which a fallback header is looked for.
FALLBACK_ROWS = 8


def _layout_counts(offset: int) -> list[Column]:
    """What decides the layout of a file, as aggregates of its cells that add up (``rows``, ``width``: the greatest)."""
    frow = F.col("sheet_row") - offset
    txt = F.coalesce(F.col("text"), F.lit(""))
    station_like = _contains_any(txt, STATION_INDICATORS)
    beside = F.col("col") >= 1
    return [
        F.max("sheet_row").alias("rows"),
        F.max("col").alias("width"),
        count_if((frow == 2) & beside & station_like).alias("st_hits"),
        count_if((frow == 3) & beside & F.upper(txt).isin(POLLUTANT_INDICATORS)).alias("pol_hits"),
        *[count_if((frow == r) & station_like).alias(f"score{r}") for r in range(FALLBACK_ROWS)],
    ]


def _with_layout(files: DataFrame, offset: int) -> DataFrame:
    """``files`` (rows with the counts of their file) with ``layout``, ``best_row`` and ``data_start``."""
    scores = F.array(*[F.col(f"score{r}") for r in range(FALLBACK_ROWS)])
    best = F.array_max(scores)
    standard = (F.col("rows") - offset + 1 >= 5) & (F.col("st_hits") >= 2) & (F.col("pol_hits") >= 1)
    layout = F.when(standard, "standard").when(best >= 2, "fallback").otherwise("synthetic")
    row = F.when(F.col("layout") == "fallback", F.array_position(scores, best).cast("int") - 1)
    start = F.when(F.col("layout") == "standard", 5).when(F.col("layout") == "fallback", F.col("best_row") + 1).otherwise(1)
    out = files.withColumn("layout", layout).withColumn("best_row", row)
    return out.withColumn("data_start", (start + offset).cast("int"))


def air_layouts(cells: DataFrame, offset: int = 1) -> DataFrame:
    """P2 + P3: one row per file: ``layout`` (standard, fallback or synthetic), ``best_row``, ``width``, ``data_start``.

    A file of at least five frame rows with two station-like cells in frame row 2 and a pollutant in row 3 has
    the standard layout. Otherwise the frame row among the first 8 with most station-like cells (at least 2; the
    earliest wins ties) is its header. All of this is one aggregate per file: the rows are scored by counters of
    their own, and the first greatest counter names the row.
    """
    files = cells.groupBy("file").agg(*_layout_counts(offset))
    return _with_layout(files, offset).select("file", "layout", "best_row", "width", "data_start")


def air_header(cells: DataFrame, offset: int = 1) -> DataFrame:
    """P2 + P3: (file, col, station, param, unit, data_start, layout) of an air sheet.

    Standard layout: frame rows 2/3/4 = stations / pollutants / units, data from frame row 5. Fallback: the best
    row names the stations, parameters and units are 'Unknown', and data starts on the next row. Files without
    either get a synthetic station name per column, which no register knows, and data from frame row 1.
    ``offset`` is the number of sheet rows consumed as the frame's column header.

    The cells are read once: counts and header texts are aggregated per column, and a file's columns add up its
    counts to the layout (:func:`air_layouts` by the same rules). A file without a header is made up by its first column.
    """
    frow = F.col("sheet_row") - offset
    txt = F.coalesce(F.col("text"), F.lit(""))
    texts = [F.max(F.when(frow == r, txt)).alias(f"r{r}") for r in range(FALLBACK_ROWS)]
    columns = cells.groupBy("file", "col").agg(*_layout_counts(offset), *texts)
    of_file = Window.partitionBy("file")
    sums = ["st_hits", "pol_hits", *[f"score{r}" for r in range(FALLBACK_ROWS)]]
    whole = {c: F.max(c).over(of_file) for c in ("rows", "width")} | {c: F.sum(c).over(of_file) for c in sums}
    g = _with_layout(columns.withColumns({**whole, "first": F.col("col").eqNullSafe(F.min("col").over(of_file))}), offset)
    row = F.array(*[F.col(f"r{r}") for r in range(FALLBACK_ROWS)])
    synthetic, standard = F.col("layout") == "synthetic", F.col("layout") == "standard"
    headed = F.col("file").isNotNull() & (F.col("col") >= 1) & F.coalesce(*[F.col(f"r{r}") for r in range(FALLBACK_ROWS)]).isNotNull()
    made = F.when(F.col("first") & (F.col("width") >= 1), F.sequence(F.lit(1), "width"))
    at = F.explode(F.when(synthetic, made).otherwise(F.when(headed, F.array("col"))))

    def of(r: int) -> Column:
        return F.when(standard, F.coalesce(F.col(f"r{r}"), F.lit(""))).otherwise(F.lit("Unknown"))

    found = F.coalesce(F.when(standard, F.col("r2")).otherwise(F.get(row, F.col("best_row"))), F.lit(""))
    out = g.select("file", at.alias("at"), found.alias("found"), of(3).alias("param"), of(4).alias("unit"), "data_start", "layout")
    name = F.concat(F.lit("Unknown_Station_"), (F.col("at") - 1).cast("string"))
    return out.select(
        "file", F.col("at").alias("col"), F.when(synthetic, name).otherwise(F.col("found")).alias("station"), "param", "unit", "data_start", "layout"
    )


# ------------------------------------------------------------------ J7


def resolve_stations(header: DataFrame, aliases: DataFrame) -> DataFrame:
    """Header station text -> station through the alias list (left join;
    ``station_pk`` is NULL for names that match no alias)."""
    a = aliases.select(F.col("alias"), F.col("station_pk").cast("long").alias("station_pk"))
    h = header.withColumn("__name", normalise_station("station"))
    return h.join(a, h["__name"] == a["alias"], "left").drop("alias", "__name")


def unknown_stations(header: DataFrame, aliases: DataFrame) -> DataFrame:
    """Distinct header names that match no station alias."""
    h = header.select("file", normalise_station("station").alias("station")).distinct()
    a = aliases.select("alias")
    return h.join(a, h["station"] == a["alias"], "left_anti")


# ------------------------------------------------------------------ P7-P11


def apply_range_rules(metric: Column, value: Column, rules: dict[str, tuple[float | None, float | None]]) -> Column:
    """Values outside their metric's range become NULL."""
    out = value
    for m, (lo, hi) in rules.items():
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (value < F.lit(lo))
        if hi is not None:
            bad = bad | (value > F.lit(hi))
        out = F.when((metric == F.lit(m)) & bad, F.lit(None).cast("double")).otherwise(out)
    return out


def clean_values(
    df: DataFrame,
    text_col: str,
    sentinels: list[str],
    metric_col: str | None = None,
    rules: dict | None = None,
    out_col: str = "value",
) -> DataFrame:
    """P7 + P8 (+ P11): sentinel tokens -> NULL, guarded numeric parse, range rules."""
    v = to_number(null_sentinels(F.col(text_col), sentinels))
    if rules and metric_col:
        v = apply_range_rules(F.col(metric_col), v, rules)
    return df.withColumn(out_col, v)


def _timestamp_of(text: Column, kind: Column, formats: list[str]) -> Column:
    """Typed date cells are ISO text; text cells use the given formats."""
    return F.when(kind == F.lit("d"), to_ts(text, ISO_TS_FORMATS)).otherwise(to_ts(text, formats))


def file_date_formats(stamps: DataFrame, formats: list[str], start_col: str | int = 0) -> DataFrame:
    """P9 (wind): one text format per file, inferred like a column parser does:
    the first text timestamp of the file (from the data start) that any of
    ``formats`` reads decides, and the earliest format in the list wins, so an
    ambiguous ``1/2/2019`` is read month-first when that format comes first.
    Result: (file, __fmt) with the index into ``formats``; one row per file."""
    text = F.col("text")
    idx = None
    for i, f in enumerate(formats):
        hit = F.try_to_timestamp(text, F.lit(f)).isNotNull()
        idx = F.when(hit, F.lit(i)) if idx is None else idx.when(hit, F.lit(i))
    start = F.col(start_col) if isinstance(start_col, str) else F.lit(start_col)
    typed = stamps.filter((F.col("kind") != "d") & (F.col("sheet_row") >= start)).withColumn("__i", idx)
    return typed.filter(F.col("__i").isNotNull()).groupBy("file").agg(
        F.min_by("__i", "sheet_row").alias("__fmt")
    )


def _parse_with(text: Column, fmt_index: Column, formats: list[str]) -> Column:
    out = None
    for i, f in enumerate(formats):
        parsed = to_ts(text, [f])
        out = F.when(fmt_index == F.lit(i), parsed) if out is None else out.when(fmt_index == F.lit(i), parsed)
    return out


def _data_cells(
    cells: DataFrame, mapping: DataFrame, start_col: str | int, formats: list[str], infer: bool = False
) -> DataFrame:
    """Readings of mapped columns with their row's timestamp (rows without one are dropped).

    One row for each timed row and mapped column; ``text`` is NULL where the sheet has no cell.

    ``infer``: text timestamps of a file are read with the single format
    inferred for that file (``file_date_formats``) instead of trying every
    format per cell; typed date cells are always taken as they are.
    """
    if not isinstance(start_col, str):  # rows above the data give no readings
        cells = cells.filter(F.col("sheet_row") >= start_col)
    cells = cells.filter(F.col("col") >= 0)
    if infer:
        stamps = cells.filter(F.col("col") == 0)
        if isinstance(start_col, str):
            starts = mapping.select("file", start_col).distinct()
            stamps = stamps.join(starts, "file", "inner")
        cells = cells.join(file_date_formats(stamps, formats, start_col), "file", "left")
        text_ts = _parse_with(F.col("text"), F.col("__fmt"), formats)
        ts = F.when(F.col("kind") == F.lit("d"), to_ts(F.col("text"), ISO_TS_FORMATS)).otherwise(text_ts)
    else:
        ts = _timestamp_of(F.col("text"), F.col("kind"), formats)
    # a cell stands for its own column and for the blank ones up to the next cell of its row, so the readings need
    # no join of cells by row and column, and a timed row has a cell left of all of them
    timed = cells.select("file", "sheet_row", F.col("col").alias("__at"), "text", "kind", F.when(F.col("col") == 0, ts).alias("__ts"))
    row = Window.partitionBy("file", "sheet_row").orderBy("__at")
    whole = row.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    timed = timed.withColumns({"__next": F.lead("__at").over(row), "__stamps": F.collect_list("__ts").over(whole)}).drop("__ts")
    timed = timed.filter(F.size("__stamps") > 0)
    m = mapping.filter(F.col("col") >= 1).withColumnRenamed("file", "__file")
    start = F.col(start_col) if isinstance(start_col, str) else F.lit(start_col)
    own = F.col("col") == F.col("__at")
    blank = (F.col("col") > F.col("__at")) & (F.col("__next").isNull() | (F.col("col") < F.col("__next")))
    read = timed.join(m, (F.col("file") == F.col("__file")) & (own | blank) & (F.col("sheet_row") >= start))
    read = read.withColumns({"text": F.when(own, F.col("text")), "kind": F.when(own, F.col("kind")), "datetime": F.explode("__stamps")})
    return read.drop("__file", "__at", "__next", "__stamps")


def stage_wind(cells: DataFrame, aliases: DataFrame, offset: int = 0) -> DataFrame:
    """Wind sheet cells -> clean long rows (file, datetime, station_pk, metric, value).

    Unknown stations are not part of the output (``unknown_stations`` reports
    them); columns without a parameter are ignored instead of failing the file.
    """
    hdr = resolve_stations(wind_header(cells, offset), aliases).filter(F.col("station_pk").isNotNull())
    mapping = hdr.select(
        "file", "col", "station_pk", metric_from_param(F.col("param")).alias("metric"), "unit"
    )
    d = _data_cells(cells, mapping, 5 + offset, WIND_TS_FORMATS, infer=True)
    d = clean_values(d, "text", WIND_SENTINELS, "metric", WIND_RANGE_RULES)
    return d.select("file", "datetime", "station_pk", "metric", "value", F.col("sheet_row"), F.col("col"))


def stage_air(cells: DataFrame, aliases: DataFrame, pollutant: Column, offset: int = 1) -> DataFrame:
    """Air sheet cells -> clean long rows; metric is the file's pollutant.

    No range rule applies (negative readings survive). When two columns
    resolve to the same station the right-most one wins, as a later
    assignment of the same column name would.
    """
    hdr = resolve_stations(air_header(cells, offset), aliases).filter(F.col("station_pk").isNotNull())
    w = Window.partitionBy("file", "station_pk").orderBy(F.desc("col"))
    hdr = hdr.withColumn("__rk", F.row_number().over(w)).filter(F.col("__rk") == 1)
    mapping = hdr.select("file", "col", "station_pk", "data_start", "unit")
    d = _data_cells(cells, mapping, "data_start", AIR_TS_FORMATS)
    d = d.withColumn("metric", pollutant)
    d = clean_values(d, "text", AIR_SENTINELS)
    return d.select("file", "datetime", "station_pk", "metric", "value", F.col("sheet_row"), F.col("col"))


def staged_columns(long: DataFrame) -> DataFrame:
    """Column name of each staged value: ``station_<pk>_<metric>``."""
    return long.withColumn(
        "col_name", F.concat(F.lit("station_"), F.col("station_pk").cast("string"), F.lit("_"), F.col("metric"))
    )


# ------------------------------------------------------------------ P16


REQUIRED = ("datetime", "station_pk", "metric")


def tagged_rows(df: DataFrame, ranges: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Every row with ``__error__``, its reasons for rejection (NULL for a valid row).

    Rules: every required column present; value inside its metric's valid
    range (``metric``, ``valid_min``, ``valid_max``; an open end is NULL).
    """
    r = ranges.select(F.col("metric").alias("__m"), "valid_min", "valid_max")
    j = df.join(r, df["metric"] == r["__m"], "left")
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in required]
    v = F.col("value").cast("double")
    outside = F.coalesce(v < F.col("valid_min"), F.lit(False)) | F.coalesce(v > F.col("valid_max"), F.lit(False))
    checks.append(F.when(outside, F.lit("out_of_range")))
    err = F.array_join(F.array_compact(F.array(*checks)), ";")
    return j.withColumn("__error__", F.when(err == "", F.lit(None)).otherwise(err)).drop("__m", "valid_min", "valid_max")


def split_valid(df: DataFrame, ranges: DataFrame, required: tuple[str, ...] = REQUIRED):
    """(ok, rejects) with an ``__error__`` reason on each reject.

    ``ok`` and ``rejects`` partition the input: each row goes to exactly one
    side. Two frames, so using both computes the input twice; to write them, use
    ``write_split``, which does so once.
    """
    tagged = tagged_rows(df, ranges, required)
    ok = tagged.filter(F.col("__error__").isNull()).drop("__error__")
    return ok, tagged.filter(F.col("__error__").isNotNull())


def rejection_counts(df: DataFrame, ranges: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """P16 as a report: rows per reason (``ok`` for valid rows), one pass."""
    reason = F.coalesce("__error__", F.lit("ok")).alias("reason")
    return tagged_rows(df, ranges, required).groupBy(reason).agg(F.count(F.lit(1)).alias("rows")).orderBy("reason")


def write_split(df: DataFrame, ranges: DataFrame, directory: str, required: tuple[str, ...] = REQUIRED) -> dict[str, int]:
    """P16 sink: valid and rejected rows in one write, a folder per reason; returns the observed numbers.

    The input is computed once: rows go to ``reason=ok`` or to the quarantine folder of their reason, and the
    numbers of rows are observed while they pass. Rerunning replaces the folders that it writes.
    """
    tagged = tagged_rows(df, ranges, required).withColumn("reason", F.coalesce("__error__", F.lit("ok"))).drop("__error__")
    seen = Observation("split")
    rows = tagged.observe(seen, F.count(F.lit(1)).alias("rows"), count_if(F.col("reason") == "ok").alias("ok"), count_if(F.col("reason") != "ok").alias("rejected"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("reason").parquet(directory)
    return dict(seen.get)


# ------------------------------------------------------------------ P18


def valid_only(fact: DataFrame) -> DataFrame:
    return fact.filter((F.col("quality_flag") == "VALID") & F.col("value").isNotNull())


def for_source(fact: DataFrame, source: str) -> DataFrame:
    return fact.filter(F.col("source") == source)


def metrics_in(fact: DataFrame, metrics: list[str]) -> DataFrame:
    return fact.filter(F.col("metric").isin(list(metrics)))


def value_between(fact: DataFrame, lo: float, hi: float) -> DataFrame:
    return fact.filter(F.col("value").between(lo, hi))
