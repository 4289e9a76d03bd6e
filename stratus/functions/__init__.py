from stratus.functions.scalar import (  # noqa: F401
    BITMAP_DAYS,
    BITMAP_IDS,
    bitmap_of_days,
    bitmap_of_hours,
    bitmap_of_ids,
    bucket_of,
    count_if,
    day_number,
    duck_round,
    half_even_round,
    metric_from_param,
    normalise_station,
    null_sentinels,
    pct,
    pollutant_from_filename,
    python_strip,
    to_fact_value,
    to_number,
    to_ts,
    trunc_ts,
    unit_of,
)
