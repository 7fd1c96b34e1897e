"""Column expressions: native Spark SQL, no Python UDFs.

Each helper has two forms: ``*_sql`` returns the SQL text of the
expression (column names or SQL text in, SQL text out) and the plain name
returns it as a ``Column`` via ``F.expr``. Writing an expression as SQL text
builds it in one JVM call, where a chain of ``F.when`` / ``F.lit`` objects
costs one call per node; Catalyst gets the same tree either way, and it
stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's -------------------------
# Noise classes (upper bounds are exclusive), lowest first.
NOISE_CLASSES = [(50.0, "Quiet"), (60.0, "Moderate"), (70.0, "Noisy"), (80.0, "Very Noisy")]
NOISE_CLASS_TOP = "Extremely Noisy"
NOISE_CLASS_MISSING = "Unknown"
ALL_NOISE_CLASSES = ["Quiet", "Moderate", "Noisy", "Very Noisy", "Extremely Noisy", "Unknown"]

# Location offsets in dB added to the base estimate.
LOCATION_OFFSETS = {
    "Indoor - Home": -10.0,
    "Indoor - Office": -5.0,
    "Outdoor": 10.0,
    "Indoor - Transport": 15.0,
    "Indoor - Commercial": 5.0,
}

# Valid noise range in dB.
NOISE_MIN_DB = 40.0
NOISE_MAX_DB = 105.0

WEEKEND_DAYS = [5, 6]  # Monday = 0
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# ---------------------------------------------------------------------------


def E(sql: str) -> Column:
    """SQL text -> Column (``expr AS alias`` allowed)."""
    return F.expr(sql)


def q(name: str) -> str:
    """Quote a plain column name for SQL text; other SQL text is kept."""
    return f"`{name}`" if name.isidentifier() else name


def dbl(v) -> str:
    """Exact DOUBLE literal for a Python number (NULL for None)."""
    return "CAST(NULL AS DOUBLE)" if v is None else f"CAST('{float(v)!r}' AS DOUBLE)"


def s(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def round_half_up_sql(x: str, digits: int = 2) -> str:
    return f"CAST(round(CAST(({x}) AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def round_half_up(col: Column | str, digits: int = 2) -> Column:
    """Round a double half-up through DECIMAL, then back to DOUBLE.

    ``round`` on a raw double disagrees between engines at binary ties
    (1.005); rounding the 6-place decimal form gives one answer everywhere.
    ``col`` is a Column, a column name or SQL text.
    """
    if isinstance(col, str):
        return E(round_half_up_sql(q(col), digits))
    return F.round(col.cast("decimal(38,6)"), digits).cast("double")


def noise_category_sql(x: str) -> str:
    whens = [f"WHEN {x} IS NULL THEN {s(NOISE_CLASS_MISSING)}"]
    whens += [f"WHEN {x} < {bound} THEN {s(label)}" for bound, label in NOISE_CLASSES]
    return f"CASE {' '.join(whens)} ELSE {s(NOISE_CLASS_TOP)} END"


def noise_category(db: str = "noise_level_db") -> Column:
    """Noise class label; NULL input gives ``Unknown``."""
    return E(noise_category_sql(q(db)))


def clip_keep_null_sql(x: str, lo: float = NOISE_MIN_DB, hi: float = NOISE_MAX_DB) -> str:
    """Clip to [lo, hi]; NULL stays NULL (``greatest(NULL, lo)`` is ``lo``)."""
    return f"CASE WHEN ({x}) IS NOT NULL THEN least(greatest(({x}), {dbl(lo)}), {dbl(hi)}) END"


def clip_keep_null(x: str, lo: float = NOISE_MIN_DB, hi: float = NOISE_MAX_DB) -> Column:
    return E(clip_keep_null_sql(q(x), lo, hi))


def location_offset_sql(loc: str) -> str:
    """Offset in dB for a location label, 0 for any other label or NULL."""
    whens = " ".join(f"WHEN {loc} = {s(label)} THEN {dbl(off)}" for label, off in LOCATION_OFFSETS.items())
    return f"CASE {whens} ELSE {dbl(0.0)} END"


def day_type_sql(dow: str) -> str:
    days = ", ".join(str(d) for d in WEEKEND_DAYS)
    return f"CASE WHEN {dow} IN ({days}) THEN 'Weekend' ELSE 'Weekday' END"


def day_type(day_of_week: str = "day_of_week") -> Column:
    """``Weekend`` for days 5 and 6, else ``Weekday`` (NULL too)."""
    return E(day_type_sql(q(day_of_week)))


def equal_width_bin_sql(x: str, lo, hi, bins: int = 10) -> str:
    """Index of the right-closed equal-width bin of ``x`` over [lo, hi].

    The first bin includes ``lo``. The index equals the number of interior
    edges ``lo + k * ((hi - lo) / bins)`` (k = 1..bins-1) that ``x`` exceeds,
    which is what interval-based cutting gives (``width_bucket`` is
    left-closed and differs on edges). It is computed as an arithmetic guess
    corrected by one exact comparison against each neighbouring edge, so the
    expression stays short. A constant axis puts every value in the middle
    bin; an all-NULL axis (no bounds) gives NULL.
    """
    if lo is None or hi is None:
        return "CAST(NULL AS INT)"
    if lo == hi:
        return f"CASE WHEN {x} IS NULL THEN CAST(NULL AS INT) ELSE {(bins - 1) // 2} END"
    L, H = dbl(lo), dbl(hi)
    w = f"(({H} - {L}) / {dbl(bins)})"
    g = f"least(greatest(CAST(ceil(({x} - {L}) / {w}) AS INT) - 1, 0), {bins - 1})"

    def edge(k: str) -> str:
        return f"({L} + CAST({k} AS DOUBLE) * {w})"

    return (f"CASE WHEN {x} IS NULL THEN CAST(NULL AS INT) ELSE {g}"
            f" + CASE WHEN {g} < {bins - 1} AND {x} > {edge(f'{g} + 1')} THEN 1 ELSE 0 END"
            f" - CASE WHEN {g} > 0 AND {x} <= {edge(g)} THEN 1 ELSE 0 END END")


def equal_width_bin(x: str, lo, hi, bins: int = 10) -> Column:
    return E(equal_width_bin_sql(q(x), lo, hi, bins))


def bin_label_sql(b: str) -> str:
    """Bin index as the float text ``5.0``; NULL gives ``nan``. Never NULL, so
    ``IS NOT NULL`` tests on a zone fold away."""
    return f"coalesce(concat(CAST(({b}) AS STRING), '.0'), 'nan')"


def zero_pad_id_sql(prefix: str, n: str, width: int = 6) -> str:
    """``prefix`` + ``n`` padded to ``width`` digits; longer ids are kept whole
    (``lpad`` alone would cut them)."""
    t = f"CAST({n} AS STRING)"
    return f"concat({s(prefix)}, CASE WHEN length({t}) < {width} THEN lpad({t}, {width}, '0') ELSE {t} END)"


def zero_pad_id(prefix: str, n: str, width: int = 6) -> Column:
    return E(zero_pad_id_sql(prefix, q(n), width))
