"""Cleaning and feature derivation (noise class, offsets, clipping, local-time
features, equal-width geographic zones, tolerant text parsing).

Each function maps DataFrame(s) to a DataFrame. The only action is the
bounds fit of the geographic bins (four numbers, like fitting a bucketizer).
Expressions are SQL text (see ``quietude.functions.expr``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietude.functions import expr as X
from quietude.functions.expr import E, q
from quietude.sources.raw import time_sql
from quietude.sources.schemas import EXPORT_HEADER, RAW_SENSOR_COLUMNS, READING_COLUMNS

# Characters a text-line strip removes at both ends (ASCII whitespace).
WHITESPACE = " \t\n\r\x0b\x0c"


def with_noise_category(df: DataFrame, noise_col: str = "noise_level_db",
                        out: str = "noise_category") -> DataFrame:
    """Add the noise class label."""
    return df.withColumn(out, X.noise_category(noise_col))


def adjusted_noise_sql(base: str, location: str, measured: str | None = None) -> str:
    """Base estimate + location offset, overridden by a measured exposure when
    present, then clipped to [40, 105] keeping NULL (P9, P10, P11)."""
    estimate = f"({base} + {X.location_offset_sql(location)})"
    if measured is not None:
        estimate = f"coalesce({measured}, {estimate})"
    return X.clip_keep_null_sql(estimate)


def with_noise_adjusted(df: DataFrame, base_col: str, location_col: str,
                        measured_col: str | None = None,
                        out: str = "noise_level_db") -> DataFrame:
    sql = adjusted_noise_sql(q(base_col), q(location_col), q(measured_col) if measured_col else None)
    return df.withColumn(out, E(sql))


def time_features_sql(ts: str) -> dict[str, str]:
    """hour (0-23), day_of_week (Monday = 0) and date, from local wall-clock time."""
    return {"hour": f"CAST(hour({ts}) AS BIGINT)",
            "day_of_week": f"CAST(weekday({ts}) AS BIGINT)",
            "date": f"to_date({ts})"}


def with_time_features(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    return df.withColumns({k: E(v) for k, v in time_features_sql(q(ts_col)).items()})


def axis_bounds(df: DataFrame, lat_col: str, lon_col: str) -> tuple:
    """Global (lat_lo, lat_hi, lon_lo, lon_hi).

    Like fitting a bucketizer: one pruned two-column scan with a partial
    min/max aggregate (one row per task crosses the shuffle), returning four
    numbers to the driver. The bins then use them as literals, which
    constant-folds the bin width into the generated code (a scalar-subquery
    form of the same bounds ran several times slower per row).
    """
    la, lo = q(lat_col), q(lon_col)
    row = df.selectExpr(f"min({la})", f"max({la})", f"min({lo})", f"max({lo})").first()
    return tuple(row)


def geo_zone_sql(lat: str, lon: str, bounds: tuple, bins: int = 10) -> str:
    """``latbin_lonbin`` zone text for fitted ``bounds`` (P17); never NULL."""
    lat_lo, lat_hi, lon_lo, lon_hi = bounds
    return (f"concat({X.bin_label_sql(X.equal_width_bin_sql(lat, lat_lo, lat_hi, bins))}, '_', "
            f"{X.bin_label_sql(X.equal_width_bin_sql(lon, lon_lo, lon_hi, bins))})")


def with_geo_zone(df: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude",
                  bins: int = 10, bounds_from: DataFrame | None = None,
                  out: str = "geo_zone") -> DataFrame:
    """Equal-width geographic zone ``latbin_lonbin``.

    Bins span the global min/max of each axis (``bounds_from`` defaults to
    ``df``). A missing coordinate prints ``nan`` for that axis; the zone is
    never NULL.
    """
    bounds = axis_bounds(bounds_from if bounds_from is not None else df, lat_col, lon_col)
    return df.withColumn(out, E(geo_zone_sql(q(lat_col), q(lon_col), bounds, bins)))


def preprocess_raw(raw: DataFrame, base_noise_col: str) -> DataFrame:
    """Raw sensor rows -> readings.

    ``base_noise_col`` is the base estimate per row (the reference draws it
    at random; here it is an input column). Rows with a NULL time are
    dropped before parsing; a time that is not wholly a local time (0 to 9
    decimals of a second, with or without an offset) survives as NULL.
    """
    others = [q(c) for c in RAW_SENSOR_COLUMNS if c != "time"]
    df = raw.filter("`time` IS NOT NULL").selectExpr(f"{time_sql('`time`')} AS `time`", *others, q(base_noise_col))
    noise = adjusted_noise_sql(q(base_noise_col), "`q_location`", "`ts_audio_exposure_environment`")
    feats = time_features_sql("`time`")
    df = df.selectExpr("*", f"{noise} AS noise_level_db", *[f"{v} AS {k}" for k, v in feats.items()])
    df = df.selectExpr("*", f"{X.noise_category_sql('noise_level_db')} AS noise_category")
    return with_geo_zone(df, "ws_latitude", "ws_longitude")


def rename_to_table(df: DataFrame) -> DataFrame:
    """Export names -> table names."""
    return df.withColumnsRenamed({
        "time": "timestamp", "id_participant": "participant_id",
        "ws_latitude": "latitude", "ws_longitude": "longitude",
        "q_location": "location_type", "q_noise_kind": "noise_kind",
    })


def readings_as_tsv_lines(readings: DataFrame) -> DataFrame:
    """Readings as TSV text lines (header first), NULL as an empty field."""
    fields = ", ".join(f"coalesce(CAST({q(c)} AS STRING), '')" for c in READING_COLUMNS)
    body = readings.selectExpr(f"concat_ws('\\t', {fields}) AS value")
    header = readings.sparkSession.createDataFrame([("\t".join(EXPORT_HEADER),)], "value string")
    return header.unionByName(body)


def parse_readings_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Tolerant TSV parse (S4): strip, split on tab, keep rows with at least
    11 fields, skip the header and rows with a blank noise level, and drop
    rows whose noise level or hour fail to convert. Other fields are typed
    with ``try_cast`` (NULL on failure).

    The split array is produced by a generator (``explode`` of a one-element
    array). Filters on generator output stay above it, so the line is
    stripped and split once, not once per field test.
    """
    parts = F.split(F.trim(F.col(col), F.lit(WHITESPACE)), "\t")
    df = lines.select(F.explode(F.array(parts)).alias("p"))
    noise = "try_cast(p[4] AS DOUBLE)"
    hour = "try_cast(try_cast(p[8] AS DOUBLE) AS BIGINT)"
    df = df.filter(f"size(p) >= 11 AND p[0] != 'time' AND p[4] != '' "
                   f"AND {noise} IS NOT NULL AND {hour} IS NOT NULL")

    def blank_null(i: int) -> str:
        return f"CASE WHEN p[{i}] != '' THEN p[{i}] END"

    return df.selectExpr(
        "try_cast(nullif(p[0], '') AS TIMESTAMP_NTZ) AS `timestamp`",
        f"{blank_null(1)} AS participant_id",
        "try_cast(p[2] AS DOUBLE) AS latitude",
        "try_cast(p[3] AS DOUBLE) AS longitude",
        f"{noise} AS noise_level_db",
        f"{blank_null(5)} AS noise_category",
        f"{blank_null(6)} AS location_type",
        f"{blank_null(7)} AS noise_kind",
        f"{hour} AS hour",
        "try_cast(try_cast(p[9] AS DOUBLE) AS BIGINT) AS day_of_week",
        f"{blank_null(10)} AS geo_zone",
    )


def readings_complete(df: DataFrame) -> DataFrame:
    """Rows a store load accepts: noise, latitude and longitude present."""
    return df.filter("noise_level_db IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL")


def store_coerce(df: DataFrame) -> DataFrame:
    """Types and defaults applied on store load (P19); an unknown hour or day
    stays NULL."""
    return df.selectExpr(
        "CAST(`timestamp` AS STRING) AS `timestamp`",
        "CAST(participant_id AS STRING) AS participant_id",
        "CAST(latitude AS DOUBLE) AS latitude",
        "CAST(longitude AS DOUBLE) AS longitude",
        "CAST(noise_level_db AS DOUBLE) AS noise_level_db",
        f"coalesce(noise_category, {X.s(X.NOISE_CLASS_MISSING)}) AS noise_category",
        "CAST(location_type AS STRING) AS location_type",
        "CAST(noise_kind AS STRING) AS noise_kind",
        "CAST(hour AS BIGINT) AS hour",
        "CAST(day_of_week AS BIGINT) AS day_of_week",
        "CAST(geo_zone AS STRING) AS geo_zone",
    )


def export_columns(readings: DataFrame) -> DataFrame:
    """The eleven exported columns with export names (P1, K2 input)."""
    return readings.selectExpr(*[f"{q(t)} AS {q(e)}" for t, e in zip(READING_COLUMNS, EXPORT_HEADER)])
