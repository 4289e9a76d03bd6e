"""Raw sheets made from the benchmark tables: one wind and one air-quality sheet per order.

The benchmark data holds no spreadsheets, so the header and cleaning operators
read cells (``stratus.schemas.CELLS``) that are derived from the whole tables: an
order is a sheet, its line items are columns, suppliers are stations, part types
give the parameters, and discounts and taxes decide which cells are missing or
hold something that is no reading. All branches of header parsing occur: blank
station cells, stations that nobody registered, missing parameters, standard
layouts, shifted ones, ties between rows and sheets without any header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.sources.drivertables import table

#: Parameter header of a column by part type; others have none, MEDIUM has the part's name.
WIND_PARAMS = {"ECONOMY": "Wind Dir V", "LARGE": " Wind Speed V ", "STANDARD": "Wind Speed V", "SMALL": ""}
#: Pollutant header of a column by return flag; only the first two are pollutants.
AIR_PARAMS = {"A": "NO2", "N": "o3", "R": "pollen"}
#: Cell text by hundredths of discount, where it is not the plain quantity.
WIND_TOKENS = {0: "NoData", 1: "InVld", 2: "NaN", 3: "inf", 4: "1d", 8: "1e2"}
AIR_TOKENS = {0: "<Samp", 1: "Down", 2: "RS232", 3: "Zero", 4: "Calib", 5: "NaN", 8: "1e3", 9: " "}
NEGATIVE, TENFOLD, BLANK = 5, 6, 7
#: Nation whose stations are written with a hyphen in sheets and without in the register.
HYPHEN_NATION = 6
#: Lines in a part of the deal by sheet.
DEALT = 500_000
_LINE = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def lines(spark: SparkSession, sf_dir: str, kind: str, of_part: Column | None = None) -> DataFrame:
    """One row per order and line number (of several the least by its columns) with supplier, part and order.

    The parts come first, one row for each key (``of_part``: an aggregate of the key's rows, a column of that name),
    so lines need no shuffle by part after they have been dealt by their sheet (``file``, named by ``kind`` and the
    order). Orders join them there, and all later steps work within a sheet, so they find their rows together: neither the cells,
    six times as many, nor the header cells are shuffled again. The parts of this deal hold some ``DEALT`` lines
    each, as the cells of a part are sorted in memory and take many times the bytes that were shuffled.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_LINE)
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    p = table(spark, sf_dir, "part").filter(F.col("p_partkey").isNotNull())
    p = p.select("p_partkey").distinct() if of_part is None else p.groupBy("p_partkey").agg(of_part.alias("of_part"))
    o = table(spark, sf_dir, "orders").select(_file(kind, "o_orderkey").alias("file"), "o_orderkey", "o_orderstatus")
    kept = [*_LINE, F.col("p_partkey").isNotNull().alias("has_part"), *p.columns[1:]]
    sold = li.join(p, li["l_partkey"] == p["p_partkey"], "left").select(_file(kind, "l_orderkey").alias("file"), "l_linenumber", *kept)
    deal = max(spark.sparkContext.defaultParallelism, -(-li.count() // DEALT))
    least = F.min(F.struct(*sold.columns[2:])).alias("x")  # a part's columns decide nothing: equal keys have equal ones
    one = sold.repartition(deal, "file").groupBy("file", "l_linenumber").agg(least).select("file", "l_linenumber", "x.*").filter("has_part")
    return one.join(s, one["l_suppkey"] == s["s_suppkey"]).join(o, "file")


def _file(kind: str, order: str) -> Column:
    return F.concat(F.lit(f"{kind}_"), F.col(order).cast("string"), F.lit(".xlsx"))


def _case(col: Column, values: dict, otherwise: Column | None = None) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    return out if otherwise is None else out.otherwise(otherwise)


def _station(hyphen: str) -> Column:
    return F.when(
        F.col("s_nationkey") == HYPHEN_NATION, F.concat(F.lit(f"Somerset{hyphen}West AQM Site "), F.col("s_suppkey").cast("string"))
    ).otherwise(F.concat("s_name", F.lit(" AQM Site")))


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station register (alias, station_pk): suppliers with a non-negative balance."""
    s = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") >= 0)
    return s.select(_station(" ").alias("alias"), F.col("s_suppkey").alias("station_pk"))


def _hundredths(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("int")


def _value_text(tokens: dict[int, str], tenfold: bool) -> Column:
    q, d = F.col("l_quantity"), _hundredths("l_discount")
    out = F.when(d == BLANK, F.lit(None).cast("string"))
    if NEGATIVE not in tokens:
        out = out.when(d == NEGATIVE, F.concat(F.lit("-"), q.cast("string")))
    if tenfold:
        out = out.when(d == TENFOLD, (q * 10).cast("string"))
    return out.otherwise(_case(d, tokens, q.cast("string")))


def _cells(df: DataFrame, cells: list[tuple[Column | int, Column | int, Column]]) -> DataFrame:
    """The cells of each line; cells without text are absent, and one that several lines give has the greatest text."""
    items = [
        F.struct(*[(c if isinstance(c, Column) else F.lit(c)).cast("int").alias(n) for n, c in (("sheet_row", r), ("col", k))], t.alias("text"))
        for r, k, t in cells
    ]
    out = df.select("file", F.explode(F.array(*items)).alias("c")).select("file", "c.*").filter(F.col("text").isNotNull())
    # in this order of keys the cells are sorted by column, as the headers need them
    out = out.groupBy("file", "col", "sheet_row").agg(F.max("text").alias("text"))
    return out.select("file", "sheet_row", "col", "text", F.lit("s").alias("kind"))


def wind_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header rows 2-4; a dated row per line from row 6 on, dates in one of two forms by sheet, some of them none."""
    param = F.when(F.col("p_type") == "MEDIUM", F.col("p_name")).otherwise(_case(F.col("p_type"), WIND_PARAMS))
    df, n = lines(spark, sf_dir, "wind", F.max(param)), F.col("l_linenumber")
    station = F.when(F.col("l_returnflag") == "A", F.concat(F.lit(" "), _station("-"))).when(F.col("l_returnflag") == "R", F.lit("  "))
    iso, us = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm"), F.date_format("l_shipdate", "M/d/yyyy H:mm")
    even, tax = F.col("o_orderkey") % 2 == 0, _hundredths("l_tax")
    # one tax rate has no date, one a word, one the other form of the date
    date = F.when(tax == 7, F.lit(None).cast("string")).when(tax == 8, "Minimum").when((tax == 6) == even, us).otherwise(iso)
    return _cells(
        df,
        [
            (2, n, station), (3, n, F.col("of_part")), (4, n, F.when(F.col("l_linestatus") == "O", F.lit(" m/s"))),
            (n + 5, 0, date), (n + 5, n, _value_text(WIND_TOKENS, tenfold=True)),
        ],
    )


def air_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header rows by the order's status (standard, shifted, stations twice); dated rows from row 8 on, days first."""
    df, n = lines(spark, sf_dir, "air"), F.col("l_linenumber")
    registered = F.col("l_returnflag") != "R"
    station = F.when(registered, _station("-")).otherwise(F.col("s_name"))
    param = _case(F.col("l_returnflag"), AIR_PARAMS)
    status, tax = F.col("o_orderstatus"), _hundredths("l_tax")
    date = F.date_format("l_shipdate", "d/M/yyyy H:mm")
    date = F.when(tax == 7, F.lit(None).cast("string")).when(tax == 8, F.date_format("l_shipdate", "d/M/yyyy' 24:00'")).otherwise(date)
    first = F.when(status == "F", F.lit(3)).otherwise(F.lit(2))
    return _cells(
        df,
        [
            (first, n, station), (first + 1, n, param), (first + 2, n, F.when(F.col("l_linestatus") == "O", F.lit("ug/m3"))),
            (6, n, F.when(status == "P", station)),
            (n + 7, 0, date), (n + 7, n, _value_text(AIR_TOKENS, tenfold=False)),
        ],
    )


def workbook_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, file): a workbook name per order: the standard form, free names, and names of particles alone."""
    o = table(spark, sf_dir, "orders")
    names = {"1-URGENT": "NO2", "2-HIGH": "PM2.5", "3-MEDIUM": "pm10", "4-NOT SPECIFIED": "CO"}
    label = _case(F.col("o_orderpriority"), names, F.substring("o_orderpriority", 3, 9))
    key = F.col("o_orderkey").cast("string")
    standard = F.concat(F.year("o_orderdate").cast("string"), F.lit("_"), label, F.lit("_CCT.xlsx"))
    free = F.concat(F.lit("site "), label, F.lit(" no "), key, F.lit(".xls"))
    particles = F.concat(F.lit("PM "), key, F.lit(".xlsx"))
    status = F.col("o_orderstatus")
    return o.select("o_orderkey", F.when(status == "F", standard).when(status == "O", free).otherwise(particles).alias("file"))
