"""Complaint jobs: routing, deterministic weighted assignment, sampling,
patterns (hour, zone, weekday, status) and the four insights.

The reference draws categories and statuses at random; here the draw is a
fixed arithmetic bucket of the reading id, uniform over consecutive ids and
reproducible in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quietude.functions import expr as X
from quietude.functions.expr import E, q
from quietude.functions.expr import round_half_up_sql as R

# --- fixed values that must equal the reference's -------------------------
# Category choices and weights (in percent) per route group.
ROUTE_CHOICES = {
    "day": [("construction", 50), ("traffic", 30), ("industrial", 20)],
    "evening": [("entertainment", 40), ("neighbors", 40), ("traffic", 20)],
    "night": [("neighbors", 50), ("animals", 30), ("traffic", 20)],
}
STATUS_CHOICES = [("Open", 30), ("In Progress", 20), ("Resolved", 30), ("Closed", 20)]
UNRESOLVED = ["Open", "In Progress"]
HIGH_NOISE_DB = 70.0
CATEGORY_HIGH_PCT = 30.0
UNRESOLVED_HIGH_PCT = 50.0
# ---------------------------------------------------------------------------

SAMPLE_MODULUS = 100003


def route_group_sql(location: str = "location_type", hour: str = "hour") -> str:
    """Ordered routing rule (P20): Transport location -> ``traffic``; hour 7-18
    -> ``day``; 18-23 -> ``evening``; otherwise (NULL hour too) ``night``."""
    return (f"CASE WHEN coalesce(contains({location}, 'Transport'), false) THEN 'traffic' "
            f"WHEN {hour} BETWEEN 7 AND 18 THEN 'day' WHEN {hour} BETWEEN 18 AND 23 THEN 'evening' "
            f"ELSE 'night' END")


def route_group(location: str = "location_type", hour: str = "hour") -> Column:
    return E(route_group_sql(q(location), q(hour)))


def category_bucket_sql(id_col: str = "reading_id") -> str:
    """0..99 bucket for the category draw."""
    return f"(pmod({q(id_col)}, 100) * 7919 % 100)"


def status_bucket_sql(id_col: str = "reading_id") -> str:
    """0..99 bucket for the status draw; mixes in ``id div 100`` so it does not
    follow the category bucket."""
    i = q(id_col)
    return f"((pmod({i}, 100) * 7 + pmod({i} div 100, 100) * 13) % 100)"


def category_bucket(id_col: str = "reading_id") -> Column:
    return E(category_bucket_sql(id_col))


def status_bucket(id_col: str = "reading_id") -> Column:
    return E(status_bucket_sql(id_col))


def weighted_pick_sql(bucket: str, choices: list[tuple[str, int]]) -> str:
    """Choice whose cumulative weight first exceeds ``bucket`` (0..99)."""
    whens, acc = [], 0
    for label, weight in choices[:-1]:
        acc += weight
        whens.append(f"WHEN {bucket} < {acc} THEN {X.s(label)}")
    return f"CASE {' '.join(whens)} ELSE {X.s(choices[-1][0])} END"


def assigned_category_sql(group: str, id_col: str = "reading_id") -> str:
    """Category of a route group: ``traffic`` stays, the others draw by weight."""
    b, g = category_bucket_sql(id_col), f"({group})"
    whens = [f"WHEN {g} = 'traffic' THEN 'traffic'"]
    whens += [f"WHEN {g} = {X.s(name)} THEN {weighted_pick_sql(b, ch)}" for name, ch in ROUTE_CHOICES.items()]
    return f"CASE {' '.join(whens)} END"


def assigned_category(group: str | None = None, id_col: str = "reading_id") -> Column:
    return E(assigned_category_sql(group or route_group_sql(), id_col))


def assigned_status_sql(id_col: str = "reading_id") -> str:
    return weighted_pick_sql(status_bucket_sql(id_col), STATUS_CHOICES)


def assigned_status(id_col: str = "reading_id") -> Column:
    return E(assigned_status_sql(id_col))


def complaint_route(readings: DataFrame) -> DataFrame:
    """Route group of every reading (P20)."""
    return readings.selectExpr("reading_id", "location_type", "hour", f"{route_group_sql()} AS route")


def weighted_assign(readings: DataFrame) -> DataFrame:
    """Category and status of every reading by weighted pick."""
    return readings.selectExpr("reading_id",
                               f"{assigned_category_sql(route_group_sql())} AS category",
                               f"{assigned_status_sql()} AS status")


def sample_order_sql(id_col: str = "reading_id") -> str:
    return f"(pmod({q(id_col)}, {SAMPLE_MODULUS}) * 7919 % {SAMPLE_MODULUS})"


def sample_high_noise(readings: DataFrame, n: int = 500,
                      threshold: float = HIGH_NOISE_DB) -> DataFrame:
    """``n`` readings above ``threshold`` in sample order; when fewer than
    ``n`` exist, ``n`` from all readings instead (O7).

    Nothing goes through the driver and no task sees more than a bounded
    share of the rows. One plan serves every size:

    * one aggregate over (sample key) counts the rows above the threshold and
      all rows (at most ``SAMPLE_MODULUS`` groups, partially aggregated). A
      running sum over these groups gives the number of high rows and the
      smallest key whose cumulative count reaches ``n``, for either choice;
    * rows with a larger key are filtered out, so the merge of the top-n
      receives at most n + rows(that key) rows, not n from each task.
    """
    high = f"coalesce(noise_level_db > {X.dbl(threshold)}, false)"
    keyed = readings.withColumn("_sample_key", E(f"coalesce({sample_order_sql()}, -1)"))
    hist = keyed.groupBy("_sample_key").agg(E(f"count_if({high}) AS _h"), E("count(1) AS _n"))
    upto = Window.orderBy("_sample_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = hist.withColumn("_cum_h", F.sum("_h").over(upto)).withColumn("_cum_n", F.sum("_n").over(upto))
    enough = f"max(_cum_h) >= {n}"
    cut = running.agg(E(f"named_struct('high', {enough}, 'key', IF({enough}, "
                        f"min(_sample_key) FILTER (WHERE _cum_h >= {n}), "
                        f"coalesce(min(_sample_key) FILTER (WHERE _cum_n >= {n}), {SAMPLE_MODULUS})))")).scalar()
    cand = keyed.filter((E(high) | ~cut["high"]) & (F.col("_sample_key") <= cut["key"]))
    return cand.orderBy("_sample_key", "reading_id").limit(n).drop("_sample_key")


def sample_uniform(rows: DataFrame, n: int, seed: int = 0, id_col: str = "reading_id") -> DataFrame:
    """A uniform sample of ``n`` rows without replacement (all, if fewer) (O7):
    the rows with the lowest MD5 of seed and id.

    Another seed gives another, independent sample; the same seed gives the
    same one, in any engine. Each task keeps ``n`` rows at most, and samples of
    parts merge: the sample of a union is the sample of the parts' samples.
    Rows without an id come last, ties by id."""
    key = f"coalesce(md5(concat('{int(seed)}:', CAST({q(id_col)} AS STRING))), 'g')"  # no hash has a g
    return rows.withColumn("_draw", E(key)).orderBy("_draw", id_col).limit(n).drop("_draw")


def as_complaints(rows: DataFrame) -> DataFrame:
    """Complaint records of readings (P20-P22), with the zone if there is one."""
    zone = ["geo_zone"] if "geo_zone" in rows.columns else []
    return rows.selectExpr(
        f"{X.zero_pad_id_sql('NC', 'reading_id')} AS complaint_id",
        "reading_id", "`timestamp`", "latitude", "longitude",
        f"{assigned_category_sql(route_group_sql())} AS category",
        "noise_level_db AS estimated_noise_db",
        "location_type", "hour", "day_of_week", *zone,
        f"{assigned_status_sql()} AS status",
    )


def complaints(readings: DataFrame, n: int = 500) -> DataFrame:
    """Complaint records from sampled readings."""
    return as_complaints(sample_high_noise(readings, n))


def all_complaints(readings: DataFrame, threshold: float = HIGH_NOISE_DB) -> DataFrame:
    """Complaint records of every reading above ``threshold``: the input of the
    analytics (A28-A30, A32, I1-I4)."""
    return as_complaints(readings.filter(f"noise_level_db > {X.dbl(threshold)}"))


def complaints_by_hour(c: DataFrame) -> DataFrame:
    """Complaints per hour (A28); complaints without an hour are not counted."""
    return c.filter("hour IS NOT NULL").groupBy("hour").agg(E("count(1) AS complaints")).orderBy("hour")


def complaint_zones(c: DataFrame, top: int = 10) -> DataFrame:
    """Top zones by complaint count with their average noise."""
    return (c.groupBy("geo_zone")
            .agg(E("count(1) AS complaints"), E(f"{R('avg(estimated_noise_db)')} AS avg_noise_db"))
            .orderBy(F.desc("complaints"), "geo_zone")
            .limit(top))


def complaints_by_weekday(c: DataFrame) -> DataFrame:
    """Complaints per weekday with its name; days outside 0-6 dropped."""
    names = ", ".join(X.s(d) for d in X.DAY_NAMES)
    return (c.filter("day_of_week BETWEEN 0 AND 6")
            .groupBy("day_of_week").agg(E("count(1) AS complaints"))
            .selectExpr("day_of_week",
                        f"element_at(array({names}), CAST(day_of_week + 1 AS INT)) AS day_name",
                        "complaints")
            .orderBy("day_of_week"))


def complaint_status(c: DataFrame) -> DataFrame:
    """Status counts with share (A22 on complaints)."""
    from quietude.operators.stats import value_counts
    return value_counts(c, "status", closed=True)


def _counts_with_total(c: DataFrame, col: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Per-value counts carrying the overall total. Used for the complaint
    category (closed set of six) and zone (at most 11 x 11 bins), so the
    window over the grouped rows holds a bounded number of rows."""
    grouped = c.groupBy(col).agg(E("count(1) AS n"), *[E(x) for x in extra])
    return grouped.withColumn("total", F.sum("n").over(Window.partitionBy()))


def top_zone_share(c: DataFrame, k: int = 5) -> DataFrame:
    """Insight 1: the ``k`` busiest zones (ties by zone), their share of all
    complaints and the average noise of their complaints (I1, J1).

    The reference's membership test (complaints in the top zones) is folded
    into per-zone partial sums: the top-k rows already carry count and noise
    sum, so there is no second scan and no join.
    """
    top = (_counts_with_total(c, "geo_zone", ("sum(estimated_noise_db) AS s",))
           .orderBy(F.desc("n"), "geo_zone").limit(k))
    names = "array_join(transform(array_sort(collect_list(named_struct('neg_n', -n, 'z', geo_zone))), " \
            "e -> e.z), ', ')"
    return top.agg(E(f"{names} AS top_zones"),
                   E(f"{R('100.0D * sum(n) / max(total)')} AS zone_share_pct"),
                   E(f"{R('sum(s) / sum(n)')} AS avg_noise_db"))


def peak_hour(c: DataFrame) -> DataFrame:
    """Insight 2: busiest hour (ties to the lowest), its count and the patrol
    window hour-1..hour+1 (I2)."""
    top = c.filter("hour IS NOT NULL").groupBy("hour").agg(E("count(1) AS n")).orderBy(F.desc("n"), "hour").limit(1)
    return top.selectExpr("hour AS peak_hour", "n AS peak_count", "hour - 1 AS window_start",
                          "hour + 1 AS window_end")


def priority_sql(pct: str, high_above: float) -> str:
    """``High`` above the threshold, else ``Medium``."""
    return f"CASE WHEN {pct} > {X.dbl(high_above)} THEN 'High' ELSE 'Medium' END"


def top_category(c: DataFrame) -> DataFrame:
    """Insight 3: leading category, its share and priority."""
    top = _counts_with_total(c, "category").orderBy(F.desc("n"), "category").limit(1)
    pct = "(100.0D * n / total)"
    return top.selectExpr("category", "n AS category_count", f"{R(pct)} AS category_pct",
                          f"{priority_sql(pct, CATEGORY_HIGH_PCT)} AS priority")


def unresolved_share(c: DataFrame) -> DataFrame:
    """Insight 4: complaints still open or in progress, share and priority (I4)."""
    states = ", ".join(X.s(u) for u in UNRESOLVED)
    out = c.agg(E(f"count_if(status IN ({states})) AS unresolved_count"), E("count(1) AS _total"))
    pct = "(100.0D * unresolved_count / _total)"
    return out.selectExpr("unresolved_count", f"{R(pct)} AS unresolved_pct",
                          f"{priority_sql(pct, UNRESOLVED_HIGH_PCT)} AS priority")
