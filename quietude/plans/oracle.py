"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Independent formulations over the same parquet views, with the same adapter
arithmetic (FIXTURES.md section 8), the same half-up decimal rounding and
the same tie-breaks. Keys match ``quietude.plans.catalog.QUERIES``.
"""

from __future__ import annotations

from quietude.operators.text import COMPLAINT_KEYWORDS
from quietude.plans.catalog import COMPLAINT_COUNT, HOTSPOT_DB, SAMPLE_SEED, SEARCH_KEYWORD, UPSERT_CUTOFF, UPSERT_SOUTH


def R(x: str, d: int = 2) -> str:
    """Half-up rounding through DECIMAL, as ``round_half_up`` in Spark."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), {d}) AS DOUBLE)"


def _bin(axis: str, lo: str, hi: str) -> str:
    terms = " + ".join(
        f"(CASE WHEN {axis} > {lo} + {k} * (({hi} - {lo}) / 10e0) THEN 1 ELSE 0 END)" for k in range(1, 10))
    return (f"(CASE WHEN {axis} IS NULL THEN 'nan' WHEN {hi} = {lo} THEN '4.0' "
            f"ELSE CAST(({terms}) AS VARCHAR) || '.0' END)")


RAW = """raw_r AS (
  SELECT event_id AS reading_id, ts AS "timestamp", CAST(user_id AS VARCHAR) AS participant_id,
         CASE WHEN user_id % 7 = 0 THEN NULL ELSE 1.2e0 + (user_id % 15) * 0.02e0 END AS latitude,
         CASE WHEN user_id % 7 = 0 THEN NULL ELSE 103.6e0 + (user_id // 10) * 0.03e0 END AS longitude,
         CASE WHEN value IS NULL THEN NULL ELSE least(greatest(40e0 + value * 0.5e0, 40e0), 105e0) END
           AS noise_level_db,
         CASE event_type WHEN 'click' THEN 'Indoor - Home' WHEN 'signup' THEN 'Indoor - Office'
              WHEN 'view' THEN 'Outdoor' WHEN 'error' THEN 'Indoor - Transport'
              WHEN 'purchase' THEN 'Indoor - Commercial' END AS location_type,
         props AS noise_kind,
         CAST(hour(ts) AS BIGINT) AS hour,
         CAST(isodow(ts) - 1 AS BIGINT) AS day_of_week,
         value
  FROM events
)"""

READINGS = f"""{RAW},
bounds AS (
  SELECT min(latitude) AS lat_lo, max(latitude) AS lat_hi,
         min(longitude) AS lon_lo, max(longitude) AS lon_hi FROM raw_r
),
readings AS (
  SELECT r.reading_id, r."timestamp", r.participant_id, r.latitude, r.longitude, r.noise_level_db,
         CASE WHEN r.noise_level_db IS NULL THEN 'Unknown' WHEN r.noise_level_db < 50 THEN 'Quiet'
              WHEN r.noise_level_db < 60 THEN 'Moderate' WHEN r.noise_level_db < 70 THEN 'Noisy'
              WHEN r.noise_level_db < 80 THEN 'Very Noisy' ELSE 'Extremely Noisy' END AS noise_category,
         r.location_type, r.noise_kind, r.hour, r.day_of_week,
         {_bin('r.latitude', 'b.lat_lo', 'b.lat_hi')} || '_' || {_bin('r.longitude', 'b.lon_lo', 'b.lon_hi')}
           AS geo_zone
  FROM raw_r r, bounds b
),
store AS (
  SELECT * FROM readings
  WHERE noise_level_db IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
)"""

ROUTE = ("CASE WHEN coalesce(contains(location_type, 'Transport'), false) THEN 'traffic' "
         "WHEN hour BETWEEN 7 AND 18 THEN 'day' WHEN hour BETWEEN 18 AND 23 THEN 'evening' "
         "ELSE 'night' END")
CAT_B = "((reading_id * 7919) % 100)"
STATUS_B = "((reading_id * 7 + (reading_id // 100) * 13) % 100)"
CATEGORY = (f"CASE {ROUTE} WHEN 'traffic' THEN 'traffic' "
            f"WHEN 'day' THEN (CASE WHEN {CAT_B} < 50 THEN 'construction' WHEN {CAT_B} < 80 THEN 'traffic' "
            f"ELSE 'industrial' END) "
            f"WHEN 'evening' THEN (CASE WHEN {CAT_B} < 40 THEN 'entertainment' WHEN {CAT_B} < 80 THEN 'neighbors' "
            f"ELSE 'traffic' END) "
            f"WHEN 'night' THEN (CASE WHEN {CAT_B} < 50 THEN 'neighbors' WHEN {CAT_B} < 80 THEN 'animals' "
            f"ELSE 'traffic' END) END")
STATUS = (f"CASE WHEN {STATUS_B} < 30 THEN 'Open' WHEN {STATUS_B} < 50 THEN 'In Progress' "
          f"WHEN {STATUS_B} < 80 THEN 'Resolved' ELSE 'Closed' END")

COMPLAINT_ROWS = f"""complaints AS (
  SELECT CASE WHEN length(CAST(reading_id AS VARCHAR)) < 6
              THEN 'NC' || lpad(CAST(reading_id AS VARCHAR), 6, '0')
              ELSE 'NC' || CAST(reading_id AS VARCHAR) END AS complaint_id,
         reading_id, "timestamp", latitude, longitude, {CATEGORY} AS category,
         noise_level_db AS estimated_noise_db, location_type, hour, day_of_week, geo_zone,
         {STATUS} AS status
  FROM sampled
)"""

SAMPLED = f"""{READINGS},
sampled AS (
  SELECT * FROM readings
  WHERE noise_level_db > 70 OR (SELECT count(*) FROM readings WHERE noise_level_db > 70) < {COMPLAINT_COUNT}
  ORDER BY (reading_id * 7919) % 100003, reading_id
  LIMIT {COMPLAINT_COUNT}
),
{COMPLAINT_ROWS}"""

# The analytics take every complaint, not the sample.
COMPLAINTS = f"""{READINGS},
sampled AS (SELECT * FROM readings WHERE noise_level_db > 70),
{COMPLAINT_ROWS}"""

X = "noise_level_db"


def _stats5(x: str = X) -> str:
    return (f"count(*) AS measurement_count, {R(f'avg({x})')} AS avg_noise_db, "
            f"{R(f'stddev_pop({x})')} AS std_dev_db, {R(f'min({x})')} AS min_noise_db, "
            f"{R(f'max({x})')} AS max_noise_db")


def _gs_branch(kind: str, cols: list[str], aggs: str, extra: str = "", where: str = "") -> str:
    key = "'" + kind + "'" + "".join(f" || ':' || coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    group = ", ".join(cols + ([extra] if extra else []))
    sel_extra = f"{extra}, " if extra else ""
    cond = f"WHERE {where}" if where else ""
    return f"SELECT {key} AS key, {sel_extra}{aggs} FROM keyed {cond} GROUP BY {group}"


def _five_sets(aggs: str, extra: str = "") -> str:
    loc = "location_type IS NOT NULL AND location_type <> ''"
    return "\nUNION ALL\n".join([
        _gs_branch("zone_hour", ["geo_zone", "hour"], aggs, extra),
        _gs_branch("location_hour", ["location_type", "hour"], aggs, extra, loc),
        _gs_branch("day", ["day_of_week"], aggs, extra),
        _gs_branch("hour", ["hour"], aggs, extra),
        _gs_branch("zone", ["geo_zone"], aggs, extra),
    ])


KEYED = ("keyed AS (SELECT *, CAST(\"timestamp\" AS DATE) AS date FROM readings "
         "WHERE noise_level_db IS NOT NULL AND \"timestamp\" IS NOT NULL AND hour IS NOT NULL)")

PARTIALS = (f"partials AS ({_five_sets('count(*) AS n, sum(noise_level_db) AS sum_x, min(noise_level_db) AS min_x, '
                                       'max(noise_level_db) AS max_x, sum(noise_level_db * noise_level_db) AS sum_x2', 'date')})")


def _zone_stats(src: str) -> str:
    def nz(v):
        return f"CASE WHEN {v} IS NOT NULL AND {v} <> 0 THEN {R(v)} END"
    return (f"SELECT geo_zone, {nz('avg(noise_level_db)')} AS avg_noise_db, "
            f"{nz('max(noise_level_db)')} AS max_noise_db, {nz('min(noise_level_db)')} AS min_noise_db, "
            f"{nz('CASE WHEN count(*) > 1 THEN stddev_samp(noise_level_db) ELSE 0e0 END')} AS std_dev_db, "
            f"count(*) AS sample_count FROM {src} WHERE geo_zone IS NOT NULL GROUP BY geo_zone")


def _json_obj(key: str, order: str, src: str) -> str:
    return (f"(SELECT '{{' || string_agg('\"' || CAST({key} AS VARCHAR) || '\":' || CAST(n AS VARCHAR), ',' "
            f"ORDER BY {order}) || '}}' FROM {src})")


def _keyword_rows() -> str:
    rows = []
    for cat, kws in COMPLAINT_KEYWORDS.items():
        cond = " OR ".join(f"contains(lower(text), '{kw}')" for kw in kws)
        rows.append(f"SELECT '{cat}' AS category, count(*) FILTER (WHERE {cond}) AS match_count, "
                    f"count(*) AS total FROM documents")
    return "\nUNION ALL\n".join(rows)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    W = f"WITH {READINGS}\n"
    WC = f"WITH {COMPLAINTS}\n"
    WS = f"WITH {SAMPLED}\n"

    q["readings_clean"] = W + """SELECT "timestamp", participant_id, latitude, longitude, noise_level_db,
       noise_category, location_type, noise_kind, hour, day_of_week, geo_zone
FROM readings WHERE noise_level_db IS NOT NULL AND hour IS NOT NULL"""
    q["noise_category"] = W + "SELECT reading_id, noise_level_db, noise_category FROM readings"
    q["noise_adjusted"] = f"""WITH {RAW},
inp AS (
  SELECT reading_id, location_type, least(45e0 + value * 0.1e0, 85e0) AS base_noise_db,
         CASE WHEN reading_id % 10 = 0 THEN value END AS measured_db FROM raw_r
),
est AS (
  SELECT reading_id, location_type,
         coalesce(measured_db, base_noise_db + CASE location_type WHEN 'Indoor - Home' THEN -10e0
           WHEN 'Indoor - Office' THEN -5e0 WHEN 'Outdoor' THEN 10e0 WHEN 'Indoor - Transport' THEN 15e0
           WHEN 'Indoor - Commercial' THEN 5e0 ELSE 0e0 END) AS e FROM inp
)
SELECT reading_id, location_type,
       CASE WHEN e IS NULL THEN NULL ELSE least(greatest(e, 40e0), 105e0) END AS noise_level_db FROM est"""
    # The raw lines of adapter.raw_csv_lines, by what each is made to be.
    whole = "event_id % 37 <> 0 AND event_id % 41 <> 0"
    lat = "CASE WHEN event_id % 29 <> 0 AND user_id % 7 <> 0 THEN 1.2e0 + (user_id % 15) * 0.02e0 END"
    q["raw_readings"] = f"""WITH good AS (
  SELECT CASE WHEN event_id % 23 <> 0 THEN date_trunc('second', ts)
              + CASE WHEN event_id % 3 = 0 THEN INTERVAL 250 MILLISECOND ELSE INTERVAL 0 SECOND END END AS "time",
         CAST(user_id AS VARCHAR) AS id_participant, {lat} AS ws_latitude,
         CASE WHEN user_id % 7 <> 0 THEN 103.6e0 + (user_id // 10) * 0.03e0 END AS ws_longitude,
         CASE WHEN event_id % 13 = 0 THEN event_type || ', "so called"'
              ELSE CASE event_type WHEN 'click' THEN 'Indoor - Home' WHEN 'signup' THEN 'Indoor - Office'
                   WHEN 'view' THEN 'Outdoor' WHEN 'error' THEN 'Indoor - Transport'
                   WHEN 'purchase' THEN 'Indoor - Commercial' END END AS q_location,
         nullif(props, '') AS q_noise_kind,
         CASE WHEN event_id % 31 <> 0 AND event_id % 10 = 0 THEN value END AS measured, 45e0 + value * 0.1e0 AS base
  FROM events WHERE {whole} AND event_id % 17 <> 0
), est AS (
  SELECT *, coalesce(measured, base + CASE q_location WHEN 'Indoor - Home' THEN -10e0 WHEN 'Indoor - Office' THEN -5e0
           WHEN 'Outdoor' THEN 10e0 WHEN 'Indoor - Transport' THEN 15e0 WHEN 'Indoor - Commercial' THEN 5e0 ELSE 0e0 END) AS e FROM good
), f AS (
  SELECT *, CASE WHEN e IS NOT NULL THEN least(greatest(e, 40e0), 105e0) END AS noise_level_db FROM est
), bounds AS (
  SELECT min(ws_latitude) AS lat_lo, max(ws_latitude) AS lat_hi, min(ws_longitude) AS lon_lo, max(ws_longitude) AS lon_hi FROM good
)
SELECT "time", id_participant, ws_latitude, ws_longitude, noise_level_db,
       CASE WHEN noise_level_db IS NULL THEN 'Unknown' WHEN noise_level_db < 50 THEN 'Quiet' WHEN noise_level_db < 60 THEN 'Moderate'
            WHEN noise_level_db < 70 THEN 'Noisy' WHEN noise_level_db < 80 THEN 'Very Noisy' ELSE 'Extremely Noisy' END AS noise_category,
       q_location, q_noise_kind, CAST(hour("time") AS BIGINT) AS hour, CAST(isodow("time") - 1 AS BIGINT) AS day_of_week,
       {_bin('ws_latitude', 'lat_lo', 'lat_hi')} || '_' || {_bin('ws_longitude', 'lon_lo', 'lon_hi')} AS geo_zone
FROM f, bounds"""
    q["raw_faults"] = f"""SELECT * FROM (
  SELECT NULL::VARCHAR AS column_name, 'malformed line' AS reason, true AS rejected, count(*) AS n FROM events WHERE NOT ({whole})
  UNION ALL SELECT 'time', 'missing', true, count(*) FROM events WHERE {whole} AND event_id % 17 = 0
  UNION ALL SELECT 'time', 'not a time', false, count(*) FROM events WHERE {whole} AND event_id % 17 <> 0 AND event_id % 23 = 0
  UNION ALL SELECT 'ws_latitude', 'not a number', false, count(*) FROM events WHERE {whole} AND event_id % 29 = 0
  UNION ALL SELECT 'ts_audio_exposure_environment', 'not a number', false, count(*) FROM events WHERE {whole} AND event_id % 31 = 0
) WHERE n > 0 ORDER BY reason, column_name"""
    q["store_rows"] = W + """SELECT CAST("timestamp" AS VARCHAR) AS "timestamp", participant_id, latitude, longitude, noise_level_db,
       noise_category, location_type, noise_kind, hour, day_of_week, geo_zone FROM store"""
    q["geo_zone"] = W + "SELECT reading_id, latitude, longitude, geo_zone FROM readings"
    q["readings_complete"] = W + "SELECT reading_id, participant_id, noise_level_db, geo_zone FROM store"

    q["hourly_trends"] = W + f"""SELECT hour, {_stats5()},
       {R('quantile_cont(noise_level_db, 0.5)')} AS median_noise_db,
       {R('quantile_cont(noise_level_db, 0.95)')} AS p95_noise_db
FROM readings WHERE noise_level_db IS NOT NULL GROUP BY hour ORDER BY hour"""
    q["zone_hotspots"] = W + f"""SELECT geo_zone, count(*) AS measurement_count, {R('avg(noise_level_db)')} AS avg_noise_db,
       {R('max(noise_level_db)')} AS max_noise_db,
       count(*) FILTER (WHERE noise_level_db > 80) AS extreme_noise_count,
       {R('100e0 * count(*) FILTER (WHERE noise_level_db > 80) / count(*)')} AS extreme_noise_pct
FROM readings WHERE geo_zone IS NOT NULL GROUP BY geo_zone HAVING count(*) >= 10
ORDER BY avg_noise_db DESC, geo_zone LIMIT 20"""
    q["weekday_weekend"] = W + f"""SELECT CASE WHEN day_of_week IN (5, 6) THEN 'Weekend' ELSE 'Weekday' END AS period_type,
       {_stats5()}
FROM readings WHERE noise_level_db IS NOT NULL GROUP BY 1"""
    q["location_analysis"] = W + f""", f AS (
  SELECT * FROM readings WHERE location_type IS NOT NULL AND location_type <> '' AND noise_level_db IS NOT NULL
), m AS (
  SELECT location_type, noise_category,
         row_number() OVER (PARTITION BY location_type ORDER BY count(*) DESC, noise_category) AS rn
  FROM f GROUP BY location_type, noise_category
)
SELECT f.location_type, {_stats5('f.noise_level_db')}, any_value(m.noise_category) AS most_common_category
FROM f JOIN m ON f.location_type = m.location_type AND m.rn = 1
GROUP BY f.location_type ORDER BY avg_noise_db DESC, f.location_type"""
    q["peak_hours_by_location"] = W + f"""SELECT location_type, hour, {R('avg(noise_level_db)')} AS avg_noise_db,
       count(*) AS measurement_count
FROM readings WHERE location_type IS NOT NULL AND location_type <> '' AND noise_level_db IS NOT NULL
GROUP BY location_type, hour ORDER BY location_type, avg_noise_db DESC, hour"""
    q["monthly_trends"] = f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS measurement_count,
       {R('avg(o_totalprice)')} AS avg_noise_db, {R('stddev_pop(o_totalprice)')} AS std_dev_db,
       count(*) FILTER (WHERE o_totalprice > 250000) AS high_noise_count
FROM orders WHERE o_totalprice IS NOT NULL GROUP BY 1 ORDER BY 1"""
    q["category_distribution"] = W + f"""SELECT noise_category, count(*) AS count,
       {R('100e0 * count(*) / sum(count(*)) OVER ()')} AS percentage,
       {R('avg(noise_level_db)')} AS avg_noise_db, {R('min(noise_level_db)')} AS min_noise_db,
       {R('max(noise_level_db)')} AS max_noise_db
FROM readings WHERE noise_category IS NOT NULL GROUP BY noise_category ORDER BY count DESC, noise_category"""
    q["zone_hour_day"] = W + f"""SELECT geo_zone, hour, day_of_week, count(*) AS sample_size,
       {R('avg(noise_level_db)')} AS avg_noise_db, {R('stddev_pop(noise_level_db)')} AS std_dev_db
FROM readings WHERE geo_zone IS NOT NULL AND noise_level_db IS NOT NULL
GROUP BY geo_zone, hour, day_of_week HAVING count(*) >= 5
ORDER BY avg_noise_db DESC, geo_zone, hour, day_of_week LIMIT 100"""
    q["summary_view"] = W + f"""SELECT geo_zone, location_type, hour, day_of_week,
       CASE WHEN day_of_week IN (5, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       count(*) AS total_measurements, {R('avg(noise_level_db)')} AS avg_noise_db,
       {R('stddev_pop(noise_level_db)')} AS std_dev_db, {R('min(noise_level_db)')} AS min_noise_db,
       {R('max(noise_level_db)')} AS max_noise_db, {R('quantile_cont(noise_level_db, 0.5)')} AS median_noise_db,
       count(*) FILTER (WHERE noise_level_db > 80) AS extreme_noise_events,
       count(*) FILTER (WHERE noise_level_db < 50) AS quiet_events
FROM readings WHERE noise_level_db IS NOT NULL GROUP BY geo_zone, location_type, hour, day_of_week"""
    q["export_aggregates"] = W + f"""SELECT geo_zone, location_type, hour, day_of_week,
       floor(CAST(sum(u) AS DOUBLE) / count(*) + 0.5e0) / 1e6 AS avg_noise_db,
       floor(sqrt(CAST(count(*)::HUGEINT * sum(u * u) - sum(u) * sum(u) AS DOUBLE)) / count(*) + 0.5e0) / 1e6 AS std_dev_db,
       count(*) AS sample_count, max(noise_level_db) AS max_noise_db, min(noise_level_db) AS min_noise_db
FROM (SELECT *, CAST(round(noise_level_db * 1e6) AS HUGEINT) AS u FROM readings WHERE noise_level_db IS NOT NULL)
GROUP BY geo_zone, location_type, hour, day_of_week"""
    q["zone_hourly_stats"] = W + f""", f AS (
  SELECT *, strftime("timestamp", '%Y-%m-%d') AS date_partition FROM readings WHERE noise_level_db IS NOT NULL
), s AS (
  SELECT geo_zone, hour, date_partition, {R('avg(noise_level_db)')} AS avg_noise_db,
         {R('max(noise_level_db)')} AS max_noise_db, {R('min(noise_level_db)')} AS min_noise_db,
         {R('stddev_pop(noise_level_db)')} AS std_dev_db, count(*) AS sample_count
  FROM f GROUP BY geo_zone, hour, date_partition
), c AS (
  SELECT geo_zone, hour, date_partition, noise_category, count(*) AS category_count
  FROM f GROUP BY geo_zone, hour, date_partition, noise_category
)
SELECT s.geo_zone, s.hour, s.date_partition, avg_noise_db, max_noise_db, min_noise_db, std_dev_db,
       sample_count, c.noise_category, c.category_count
FROM s JOIN c ON s.geo_zone = c.geo_zone AND s.hour = c.hour AND s.date_partition = c.date_partition"""

    # What is kept by loads equals what one query over all readings gives.
    q["summary_kept"] = q["summary_view"]
    q["zone_hourly_loads"] = q["zone_hourly_stats"]

    q["noise_grouping_sets"] = W + f""", {KEYED}
{_five_sets(f"count(*) AS count, {R('avg(noise_level_db)')} AS mean_db, "
            f"{R('stddev_pop(noise_level_db)')} AS std_dev, {R('min(noise_level_db)')} AS min_db, "
            f"{R('max(noise_level_db)')} AS max_db")}
ORDER BY key"""
    q["moments_partial"] = W + f""", {KEYED}, {PARTIALS}
SELECT key, date, n, min_x, max_x, {R('sum_x', 6)} AS sum_x, {R('sum_x2', 6)} AS sum_x2 FROM partials"""
    q["moments_merge"] = W + f""", {KEYED}, {PARTIALS}, m AS (
  SELECT key, sum(n) AS n, sum(sum_x) AS sum_x, min(min_x) AS min_x, max(max_x) AS max_x,
         sum(sum_x2) AS sum_x2 FROM partials GROUP BY key
)
SELECT key, CAST(n AS BIGINT) AS count, {R('sum_x / n')} AS mean_db,
       {R('sqrt(greatest(0e0, sum_x2 / n - (sum_x / n) * (sum_x / n)))')} AS std_dev,
       {R('min_x')} AS min_db, {R('max_x')} AS max_db
FROM m ORDER BY key"""
    q["zone_statistics"] = W + _zone_stats("store")
    q["hotspots_threshold"] = W + f""", z AS ({_zone_stats('store')})
SELECT geo_zone, avg_noise_db, sample_count FROM z WHERE avg_noise_db >= {HOTSPOT_DB} AND sample_count >= 10
ORDER BY avg_noise_db DESC, geo_zone"""
    q["hourly_patterns"] = W + f"""SELECT hour, {R('avg(noise_level_db)')} AS avg_noise_db,
       max(noise_level_db) AS max_noise_db, count(*) AS sample_count
FROM store WHERE hour IS NOT NULL GROUP BY hour ORDER BY hour"""
    q["dataset_stats"] = W + f"""SELECT count(*) AS total_records, {R('avg(noise_level_db)')} AS avg_noise_db,
       min(noise_level_db) AS min_noise_db, max(noise_level_db) AS max_noise_db,
       count(DISTINCT participant_id) AS participants, count(DISTINCT geo_zone) AS zones FROM store"""
    q["readings_overview"] = W + """SELECT count(*) AS total_measurements, min("timestamp") AS first_time,
       max("timestamp") AS last_time, count(DISTINCT participant_id) AS participants FROM readings"""
    q["noise_describe"] = W + f"""SELECT count(noise_level_db) AS count, {R('avg(noise_level_db)', 5)} AS mean,
       {R('stddev_samp(noise_level_db)', 5)} AS std, min(noise_level_db) AS min,
       {R('quantile_cont(noise_level_db, 0.25)', 5)} AS p25, {R('quantile_cont(noise_level_db, 0.5)', 5)} AS p50,
       {R('quantile_cont(noise_level_db, 0.75)', 5)} AS p75, max(noise_level_db) AS max FROM readings"""
    q["noise_summary"] = W + f"""SELECT count(*) AS total_records, {R('avg(noise_level_db)')} AS mean_db,
       {R('stddev_samp(noise_level_db)')} AS std_dev_db, {R('min(noise_level_db)')} AS min_db,
       {R('max(noise_level_db)')} AS max_db, {R('quantile_cont(noise_level_db, 0.5)')} AS median_db FROM readings"""
    q["value_counts"] = W + f"""SELECT location_type, count(*) AS count,
       {R('100e0 * count(*) / sum(count(*)) OVER ()')} AS percentage
FROM readings WHERE location_type IS NOT NULL GROUP BY location_type ORDER BY count DESC, location_type"""
    q["group_mode"] = W + """, c AS (
  SELECT location_type, noise_kind, count(*) AS n FROM readings WHERE noise_kind IS NOT NULL
  GROUP BY location_type, noise_kind
), r AS (
  SELECT *, row_number() OVER (PARTITION BY location_type ORDER BY n DESC, noise_kind) AS rn FROM c
)
SELECT location_type, noise_kind AS mode_value, n AS mode_count FROM r WHERE rn = 1"""
    q["top_zones"] = W + f"""SELECT geo_zone, {R('avg(noise_level_db)')} AS mean_db, count(noise_level_db) AS count
FROM readings GROUP BY geo_zone HAVING count(noise_level_db) >= 10 ORDER BY mean_db DESC, geo_zone LIMIT 10"""
    q["distinct_zones"] = W + "SELECT DISTINCT geo_zone FROM store WHERE geo_zone IS NOT NULL"
    second = f"(\"timestamp\" >= TIMESTAMP '{UPSERT_CUTOFF}' AND latitude >= {UPSERT_SOUTH}e0)"
    before = f"(SELECT * FROM store WHERE NOT {second})"
    after = f"(SELECT * FROM store WHERE {second})"
    q["zone_stats_upsert"] = W + f""", old AS ({_zone_stats(before)}), new AS ({_zone_stats(after)})
SELECT * FROM old WHERE geo_zone NOT IN (SELECT geo_zone FROM new)
UNION ALL SELECT * FROM new"""

    q["zone_stats_keyed"] = q["zone_stats_upsert"]
    q["participants_trailing"] = W + """, d AS (SELECT DISTINCT CAST("timestamp" AS DATE) AS date, participant_id FROM readings)
SELECT a.date, count(DISTINCT b.participant_id) AS distinct_ids
FROM (SELECT DISTINCT date FROM d) a JOIN d b ON b.date BETWEEN a.date - 6 AND a.date GROUP BY a.date"""

    q["word_count"] = """SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word"""
    lines = "(SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"
    q["keyword_search"] = (f"SELECT 'Found' AS key, line FROM {lines} "
                           f"WHERE contains(lower(line), '{SEARCH_KEYWORD}')")
    q["keyword_count"] = (f"SELECT count(*) AS match_count FROM {lines} "
                          f"WHERE contains(lower(line), '{SEARCH_KEYWORD}')")
    q["sort_by_name"] = """WITH rec AS (
  SELECT CAST(c_custkey AS VARCHAR) || ' ' || c_name || ' ' || printf('%.2f', c_acctbal) AS value FROM customer
), p AS (SELECT value, string_split(rtrim(value, ' '), ' ') AS parts FROM rec)
SELECT parts[2] AS name, value AS record FROM p WHERE len(parts) >= 3 ORDER BY name, record"""
    q["word_frequency"] = """SELECT word, count(*) AS count
FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS word FROM documents)
WHERE regexp_full_match(word, '[a-z]{4,}') GROUP BY word ORDER BY count DESC, word LIMIT 20"""
    q["word_frequency_bounded"] = q["word_frequency"]
    q["keyword_categories"] = f"""SELECT category, match_count, {R('100e0 * match_count / total')} AS match_pct
FROM ({_keyword_rows()})"""

    q["complaint_route"] = W + f"SELECT reading_id, location_type, hour, {ROUTE} AS route FROM readings"
    q["weighted_assign"] = W + f"SELECT reading_id, {CATEGORY} AS category, {STATUS} AS status FROM readings"
    q["sample_high_noise"] = WS + 'SELECT reading_id, "timestamp", noise_level_db, location_type, geo_zone FROM sampled'
    q["sample_uniform"] = W + f"""SELECT reading_id, "timestamp", noise_level_db, location_type FROM readings WHERE noise_level_db > 70
ORDER BY md5('{SAMPLE_SEED}:' || reading_id), reading_id LIMIT {COMPLAINT_COUNT}"""
    q["complaints"] = WS + "SELECT * FROM complaints"
    q["complaints_by_hour"] = WC + "SELECT hour, count(*) AS complaints FROM complaints GROUP BY hour ORDER BY hour"
    q["complaint_zones"] = WC + f"""SELECT geo_zone, count(*) AS complaints, {R('avg(estimated_noise_db)')} AS avg_noise_db
FROM complaints GROUP BY geo_zone ORDER BY complaints DESC, geo_zone LIMIT 10"""
    q["complaints_by_weekday"] = WC + """SELECT day_of_week,
       ['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'][day_of_week + 1] AS day_name,
       count(*) AS complaints
FROM complaints WHERE day_of_week BETWEEN 0 AND 6 GROUP BY day_of_week ORDER BY day_of_week"""
    q["complaint_status"] = WC + f"""SELECT status, count(*) AS count,
       {R('100e0 * count(*) / sum(count(*)) OVER ()')} AS percentage
FROM complaints WHERE status IS NOT NULL GROUP BY status ORDER BY count DESC, status"""
    q["top_zone_share"] = WC + f""", z AS (
  SELECT geo_zone, count(*) AS n, sum(estimated_noise_db) AS s FROM complaints GROUP BY geo_zone
  ORDER BY n DESC, geo_zone LIMIT 5
)
SELECT string_agg(geo_zone, ', ' ORDER BY n DESC, geo_zone) AS top_zones,
       {R('100e0 * sum(n) / (SELECT count(*) FROM complaints)')} AS zone_share_pct,
       {R('sum(s) / sum(n)')} AS avg_noise_db FROM z"""
    q["peak_hour"] = WC + """SELECT hour AS peak_hour, count(*) AS peak_count, hour - 1 AS window_start,
       hour + 1 AS window_end
FROM complaints GROUP BY hour ORDER BY peak_count DESC, hour LIMIT 1"""
    q["top_category"] = WC + f""", t AS (SELECT count(*) AS total FROM complaints)
SELECT category, count(*) AS category_count, {R('100e0 * count(*) / any_value(t.total)')} AS category_pct,
       CASE WHEN 100e0 * count(*) / any_value(t.total) > 30 THEN 'High' ELSE 'Medium' END AS priority
FROM complaints, t GROUP BY category ORDER BY category_count DESC, category LIMIT 1"""
    q["unresolved_share"] = WC + f"""SELECT count(*) FILTER (WHERE status IN ('Open', 'In Progress')) AS unresolved_count,
       {R("100e0 * count(*) FILTER (WHERE status IN ('Open', 'In Progress')) / count(*)")} AS unresolved_pct,
       CASE WHEN 100e0 * count(*) FILTER (WHERE status IN ('Open', 'In Progress')) / count(*) > 50
            THEN 'High' ELSE 'Medium' END AS priority
FROM complaints"""
    q["complaint_report"] = WC + f""",
cat AS (SELECT category AS k, count(*) AS n FROM complaints GROUP BY category),
hr AS (SELECT hour AS k, count(*) AS n FROM complaints GROUP BY hour),
st AS (SELECT status AS k, count(*) AS n FROM complaints GROUP BY status),
zn AS (SELECT geo_zone AS k, count(*) AS n, sum(estimated_noise_db) AS s FROM complaints GROUP BY geo_zone),
zn10 AS (SELECT * FROM zn ORDER BY n DESC, k LIMIT 10),
zn5 AS (SELECT * FROM zn ORDER BY n DESC, k LIMIT 5),
tot AS (SELECT count(*) AS total, min("timestamp") AS t0, max("timestamp") AS t1,
               avg(estimated_noise_db) AS a, max(estimated_noise_db) AS mx,
               count(*) FILTER (WHERE status IN ('Open', 'In Progress')) AS unres FROM complaints),
topcat AS (SELECT k AS top_k, n AS top_n FROM cat ORDER BY n DESC, k LIMIT 1),
peak AS (SELECT k AS peak_k, n AS peak_n FROM hr ORDER BY n DESC, k LIMIT 1),
z5 AS (SELECT sum(n) AS n5, sum(s) AS s5 FROM zn5)
SELECT tot.total AS total_complaints, (SELECT count(*) FROM readings) AS total_readings,
       strftime(tot.t0, '%Y-%m-%d %H:%M:%S.%f') AS date_start, strftime(tot.t1, '%Y-%m-%d %H:%M:%S.%f') AS date_end,
       {R('tot.a', 6)} AS avg_noise_level_db, tot.mx AS max_noise_level_db,
       {_json_obj('k', 'n DESC, k', 'cat')} AS category_distribution,
       {_json_obj('k', 'k', 'hr')} AS hourly_distribution,
       {_json_obj('k', 'n DESC, k', 'st')} AS status_distribution,
       {_json_obj('k', 'n DESC, k', 'zn10')} AS top_complaint_zones,
       {R('100e0 * z5.n5 / tot.total')} AS top5_zone_share_pct,
       {R('z5.s5 / z5.n5')} AS top5_avg_noise_db,
       peak.peak_k AS peak_hour, peak.peak_n AS peak_count,
       topcat.top_k AS top_category,
       CASE WHEN 100e0 * topcat.top_n / tot.total > 30 THEN 'High' ELSE 'Medium' END AS category_priority,
       tot.unres AS unresolved_count,
       CASE WHEN 100e0 * tot.unres / tot.total > 50 THEN 'High' ELSE 'Medium' END AS unresolved_priority
FROM tot, z5, topcat, peak"""
    return q
