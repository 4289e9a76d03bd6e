"""Join helpers.

Rules used throughout the library:

* No join is hinted: the planner compares the estimated size of a side with
  ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks the real size at
  run time, falling back to a shuffle join when the side is large. Building a
  report runs no job for it.
* Reports that join the fact to a dimension aggregate the fact by station key
  first where the aggregate is decomposable, so the join sees one row per
  station instead of one per measurement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_station(
    fact: DataFrame,
    dim: DataFrame,
    how: str = "inner",
    columns: tuple[str, ...] = ("station_name",),
    fact_key: str = "station_fk",
) -> DataFrame:
    """Fact JOIN dimension on ``fact_key = station_pk`` keeping ``columns``."""
    right = dim.select(F.col("station_pk").alias("__pk"), *columns)
    joined = fact.join(right, fact[fact_key] == right["__pk"], how)
    return joined.drop("__pk")
