"""Adapters from the driver tables to the job schemas.

The driver data has no noise readings, so a fixed, documented mapping turns
``events`` into readings (FIXTURES.md section 8). The same arithmetic is
written in the DuckDB oracle (``quietude.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quietude.functions import expr as X
from quietude.operators import features

# Fixed mapping event type -> location label (adapter definition).
EVENT_LOCATION = {
    "click": "Indoor - Home",
    "signup": "Indoor - Office",
    "view": "Outdoor",
    "error": "Indoor - Transport",
    "purchase": "Indoor - Commercial",
}

_LOCATION_SQL = ("CASE " + " ".join(f"WHEN event_type = {X.s(e)} THEN {X.s(loc)}"
                                     for e, loc in EVENT_LOCATION.items()) + " END")
_LAT_SQL = "CASE WHEN user_id % 7 != 0 THEN 1.2D + CAST(user_id % 15 AS DOUBLE) * 0.02D END"
_LON_SQL = "CASE WHEN user_id % 7 != 0 THEN 103.6D + CAST(user_id div 10 AS DOUBLE) * 0.03D END"
_NOISE_SQL = X.clip_keep_null_sql("40.0D + value * 0.5D")

READING_TABLE_COLUMNS = ["timestamp", "participant_id", "latitude", "longitude", "noise_level_db",
                         "noise_category", "location_type", "noise_kind", "hour", "day_of_week",
                         "geo_zone"]


def events_to_raw(events: DataFrame) -> DataFrame:
    """Events in the reading layout before zoning (keeps ``reading_id``)."""
    return events.selectExpr(
        "event_id AS reading_id",
        "ts AS `timestamp`",
        "CAST(user_id AS STRING) AS participant_id",
        f"{_LAT_SQL} AS latitude",
        f"{_LON_SQL} AS longitude",
        f"{_NOISE_SQL} AS noise_level_db",
        f"{_LOCATION_SQL} AS location_type",
        "props AS noise_kind",
        "CAST(hour(ts) AS BIGINT) AS hour",
        "CAST(weekday(ts) AS BIGINT) AS day_of_week",
        "value",
    )


def readings(events: DataFrame, keep_id: bool = True, with_zone: bool = True) -> DataFrame:
    """Readings table (FIXTURES.md section 4) derived from ``events``.

    ``reading_id`` (the event id) is kept for the complaint jobs; pass
    ``keep_id=False`` for the eleven table columns only. The zones need the
    bounds of both axes, one pass over ``events``; ``with_zone=False`` leaves
    ``geo_zone`` out and starts no job.
    """
    raw = events_to_raw(events)
    exprs = {c: X.q(c) for c in READING_TABLE_COLUMNS}
    exprs["noise_category"] = X.noise_category_sql("noise_level_db")
    if with_zone:
        bounds = features.axis_bounds(raw, "latitude", "longitude")
        exprs["geo_zone"] = features.geo_zone_sql("latitude", "longitude", bounds)
    else:
        del exprs["geo_zone"]
    sel = [f"{v} AS {X.q(k)}" for k, v in exprs.items()]
    return raw.selectExpr(*(["reading_id"] if keep_id else []), *sel)


def offset_inputs(events: DataFrame) -> DataFrame:
    """Inputs for the offset operator: base estimate and measured exposure."""
    return events.selectExpr(
        "event_id AS reading_id",
        f"{_LOCATION_SQL} AS location_type",
        "least(45.0D + value * 0.1D, 85.0D) AS base_noise_db",
        "CASE WHEN event_id % 10 = 0 THEN value END AS measured_db",
    )


def order_series(orders: DataFrame) -> DataFrame:
    """Orders as a time series for the monthly trend job."""
    return orders.selectExpr("o_orderdate AS `timestamp`", "o_totalprice AS value")


def customer_records(customer: DataFrame) -> DataFrame:
    """Customers as space-separated ``id name balance`` record lines."""
    return customer.selectExpr(
        "concat_ws(' ', CAST(c_custkey AS STRING), c_name, format_string('%.2f', c_acctbal)) AS value")


# The raw rendering of events: a CSV line each, with what raw files have.
RAW_COLUMNS = ["time", "id_participant", "ws_latitude", "ws_longitude", "q_location", "q_noise_kind", "q_noise_nearby",
               "ts_audio_exposure_environment", "ts_heart_rate", "base_db"]


def raw_csv_lines(events: DataFrame) -> DataFrame:
    """Events as lines of a raw sensor CSV (column ``value``): times with and
    without fractions and offsets, blanks, quoted labels, and by event id a
    share of missing and unreadable times, bad numbers, lines with a field too
    many and lines that end early (FIXTURES.md section 9)."""
    def bad(every: int, text: str, otherwise: str) -> str:
        return f"CASE WHEN event_id % {every} = 0 THEN {text} ELSE {otherwise} END"

    fraction = "CASE WHEN event_id % 3 = 0 THEN '.250' ELSE '' END"
    offset = "CASE event_id % 4 WHEN 0 THEN '+08:00' WHEN 1 THEN 'Z' WHEN 2 THEN '-0330' ELSE '' END"
    stamp = f"concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), {fraction}, {offset})"
    time = bad(17, "''", bad(23, "concat('on ', date_format(ts, 'yyyy-MM-dd'))", stamp))
    fields = [time, "CAST(user_id AS STRING)", bad(29, "'n/a'", f"coalesce(CAST({_LAT_SQL} AS STRING), '')"),
              f"coalesce(CAST({_LON_SQL} AS STRING), '')",
              bad(13, "concat('\"', event_type, ', \"\"so called\"\"\"')", f"coalesce({_LOCATION_SQL}, '')"),
              "coalesce(props, '')", "'no'", bad(31, "'12,5 dB'", "CASE WHEN event_id % 10 = 0 THEN coalesce(CAST(value AS STRING), '') ELSE '' END"),
              "'70'", "coalesce(CAST(45.0D + value * 0.1D AS STRING), '')"]
    fields[7] = f"CASE WHEN event_id % 31 = 0 THEN '\"12,5 dB\"' ELSE {fields[7].partition(' ELSE ')[2].rpartition(' END')[0]} END"
    line = f"concat_ws(',', {', '.join(fields)})"
    line = bad(37, f"concat({line}, ',more')", bad(41, f"concat_ws(',', {', '.join(fields[:3])})", line))
    return events.selectExpr(f"{line} AS value")
