"""Order-independent moments: exact fixed-point sums as SQL text.

A value is counted in whole units of ``10**-DIGITS``. Sums of units and of
their squares are integers, so they merge in any order and any split to the
same figures. A square may have 38 digits; it is summed in two limbs (what is
above and below ``LIMB``), so no sum overflows before some 10**19 rows,
whatever the values. Mean and deviation are taken from the sums once, after
the last merge: the squares are centred on the integer mean in exact
arithmetic, and only the small rest becomes a double.
"""

from __future__ import annotations

DIGITS = 6
LIMB = 10 ** 19
_ROOT = 3037000499  # squares up to its own fit a BIGINT

SUMS = ("n", "s", "q_hi", "q_lo")


def _int(x: str, digits: int = 19) -> str:
    return f"CAST({x} AS DECIMAL({digits}, 0))"


def units_sql(x: str) -> str:
    """``x`` in whole units, rounded half up (away from zero); |x| < 9.2 * 10**12."""
    return f"CAST(round({x} * {10 ** DIGITS}D) AS BIGINT)"


def sums_sql(x: str, weight: str | None = None, out: tuple[str, ...] = SUMS) -> list[str]:
    """Aggregates n, s, q_hi, q_lo (the count of non-NULL values, their sum, and
    the limbs of the sum of squares). ``weight``: how often a row's value counts."""
    u = units_sql(x)
    square, small = f"({_int(u)} * {_int(u)})", f"abs({u}) <= {_ROOT}L"
    hi = f"CASE WHEN {small} THEN {_int('0')} ELSE {_int(f'{square} div {LIMB}')} END"
    lo = f"CASE WHEN {small} THEN {_int(f'{u} * {u}')} ELSE {_int(f'{square} % {LIMB}')} END"

    def total(v: str) -> str:
        return _int(f"sum({v})" if weight is None else f"sum({_int(f'{v} * {_int(weight)}', 38)})", 38)

    count = f"count({x})" if weight is None else f"coalesce(sum({weight}) FILTER (WHERE {x} IS NOT NULL), 0L)"
    return [f"{count} AS {out[0]}", f"{total(_int(u))} AS {out[1]}", f"{total(hi)} AS {out[2]}", f"{total(lo)} AS {out[3]}"]


def merge_sql(names: tuple[str, ...] = SUMS, out: tuple[str, ...] = SUMS) -> list[str]:
    """Aggregates that merge stored sums."""
    return [f"CAST(sum({names[0]}) AS BIGINT) AS {out[0]}", *[f"{_int(f'sum({c})', 38)} AS {o}" for c, o in zip(names[1:], out[1:])]]


def mean_sql(names: tuple[str, ...] = SUMS) -> str:
    n, s = names[:2]
    return f"(CAST({s} AS DOUBLE) / {n} / {10 ** DIGITS}D)"


def _centred(names: tuple[str, ...]) -> tuple[str, str]:
    """The sum of squares around the integer mean, and what the sum has beyond it."""
    n, s, hi, lo = names
    c = _int(f"({s} div {n})")
    rest = f"({s} - {c} * {_int(n)})"
    t = f"({s} + {rest})"  # sum (u - c)^2 = sum u^2 - c * (s + rest)
    low = f"({c} * {_int(f'{t} % {LIMB}')})"
    top = f"({hi} - {c} * {_int(f'{t} div {LIMB}')} - {_int(f'{low} div {LIMB}')})"
    bottom = f"({lo} - {_int(f'{low} % {LIMB}')})"
    whole = (f"CASE WHEN abs({top}) < {10 ** 18} THEN CAST({_int(f'{_int(top)} * {_int(LIMB, 20)}', 38)} + {bottom} AS DOUBLE) "
             f"ELSE CAST({top} AS DOUBLE) * {float(LIMB)!r}D + CAST({bottom} AS DOUBLE) END")
    return whole, f"CAST({rest} AS DOUBLE)"


def variance_sql(names: tuple[str, ...] = SUMS, sample: bool = False) -> str:
    """Population (or sample) variance; NULL without values (or with one)."""
    whole, rest = _centred(names)
    n = names[0]
    divisor = f"nullif({n} - 1, 0)" if sample else f"nullif({n}, 0)"
    return f"CASE WHEN {n} > 0 THEN greatest(0.0D, {whole} - {rest} * {rest} / {n}) / {divisor} / {float(10 ** (2 * DIGITS))!r}D END"


def std_sql(names: tuple[str, ...] = SUMS, sample: bool = False) -> str:
    return f"sqrt({variance_sql(names, sample)})"
