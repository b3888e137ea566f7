"""Column expressions (all JVM-side Catalyst expressions, no Python UDFs).

ANSI mode is on in Spark 4, so every coercion goes through ``try_*``
functions; NaN is never let through because pandas treats it as missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Plain decimal numbers, as pandas' to_numeric takes them; Spark's text-to-double cast
# also accepts '1d', '2f', 'NaN', 'Infinity' and hex floats. The syntax is checked before
# the cast: a try_cast of other text raises and catches an exception for every row.
_NUMBER = r"\A[+-]?+(?:[0-9]++(?:\.[0-9]*+)?+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+\z"
#: Whole numbers, also written with a point and nothing but zeros after it.
_WHOLE = r"\A[+-]?+[0-9]++(?:\.0*+)?+\z"


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_nan(c: ColumnLike) -> Column:
    """NaN -> NULL (Spark treats NaN as a value; pandas treats it as missing)."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))


def to_double(c: ColumnLike) -> Column:
    """Numeric coercion; anything that is not a plain number -> NULL."""
    s = F.trim(_c(c).cast("string"))
    return F.when(F.regexp_like(s, F.lit(_NUMBER)), s.try_cast("double"))


def to_long(c: ColumnLike) -> Column:
    """Nullable integer; non-numeric or fractional text -> NULL.

    Ids above 2**53 stay exact: whole-number text ('2', '2.0') is parsed as such, other
    forms of whole numbers ('1e3') as decimals; a double only tells whether there is a fraction.
    """
    s = F.trim(_c(c).cast("string"))
    d = to_double(s)
    other = F.when(d == F.floor(d), s.try_cast("decimal(38,10)").try_cast("long"))
    return F.when(F.regexp_like(s, F.lit(_WHOLE)), F.substring_index(s, ".", 1).try_cast("long")).otherwise(other)


def to_date(c: ColumnLike, fmt: str = "yyyy-MM-dd") -> Column:
    """Date coercion, bad input -> NULL."""
    return F.try_to_date(F.trim(_c(c).cast("string")), fmt)


def is_present(c: ColumnLike) -> Column:
    """1 when the value is present, else 0."""
    return _c(c).isNotNull().cast("int")


def full_name(forename: ColumnLike, surname: ColumnLike) -> Column:
    """Trimmed forename + ' ' + trimmed surname; NULL if either is NULL."""
    return F.concat(F.trim(_c(forename)), F.lit(" "), F.trim(_c(surname)))


def season_round(year: ColumnLike, rnd: ColumnLike) -> Column:
    """X6: 'YYYY_Rnn' (round zero-padded to at least two digits)."""
    y, r = _c(year), _c(rnd)
    return F.when(y.isNotNull() & r.isNotNull(),
                  F.format_string("%d_R%02d", y.cast("long"), r.cast("long")))


def lap_ms(c: ColumnLike) -> Column:
    """X7: 'm:ss.mmm' -> whole milliseconds, truncated toward zero.

    Exactly two ':'-separated numeric parts are required; anything else is NULL.
    """
    s = _c(c).cast("string")
    parts = F.split(s, ":")
    m = to_double(parts.getItem(0))
    sec = to_double(parts.getItem(1))
    ms = ((m * F.lit(60.0) + sec) * F.lit(1000.0)).try_cast("long")
    return F.when((F.trim(s) != "") & (F.size(parts) == 2), ms)


def long_stop_flag(duration: ColumnLike, threshold: float = 60.0) -> Column:
    """1 when duration > threshold; a missing duration counts as 0."""
    return F.coalesce((_c(duration) > F.lit(threshold)).cast("int"), F.lit(0))


def safe_div(num: ColumnLike, den: ColumnLike) -> Column:
    """Division where a zero (or NULL) denominator gives NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def round_half_even(c: ColumnLike, k: int = 0) -> Column:
    """X11: numpy-style rounding: rint(x * 10^k) / 10^k on the binary value."""
    x = _c(c).cast("double")
    if k == 0:
        return F.rint(x)
    p = float(10 ** k)
    return F.rint(x * F.lit(p)) / F.lit(p)


def round_half_away(c: ColumnLike, k: int = 0) -> Column:
    """SQL-engine rounding, half away from zero on x * 10^k (binary value)."""
    p = float(10 ** k)
    y = _c(c).cast("double") * F.lit(p)
    a = F.abs(y)
    r = F.floor(a).cast("double") + F.when(a - F.floor(a) >= F.lit(0.5), F.lit(1.0)).otherwise(F.lit(0.0))
    return F.signum(y) * r / F.lit(p)


def pct(num: ColumnLike, den: ColumnLike, k: int = 4) -> Column:
    """Percentage 0..100, half-even rounded to k decimals."""
    return round_half_even(safe_div(num, den) * F.lit(100.0), k)


def best_of(*cols: ColumnLike) -> Column:
    """Row-wise minimum ignoring NULLs (NULL only when all are NULL)."""
    return F.least(*[_c(c) for c in cols])


def positions_gained(grid: ColumnLike, finish: ColumnLike) -> Column:
    """round(grid - finish) to a whole number, half-even."""
    return F.rint(_c(grid).cast("double") - _c(finish).cast("double"))


def surname(name: ColumnLike) -> Column:
    """Last whitespace-separated token."""
    return F.element_at(F.split(F.trim(_c(name)), r"\s+"), -1)


def first_token(name: ColumnLike) -> Column:
    """First whitespace-separated token."""
    return F.element_at(F.split(F.trim(_c(name)), r"\s+"), 1)


def day_name(d: ColumnLike) -> Column:
    """Full English day name."""
    return F.date_format(_c(d), "EEEE")


def is_weekend(d: ColumnLike) -> Column:
    """Saturday or Sunday -> 1 (weekday(): Monday = 0)."""
    return (F.weekday(_c(d)) >= 5).cast("int")


def hhi_band(hhi: ColumnLike, competitive_max: float = 0.18, dominant_min: float = 0.35) -> Column:
    """Band label for a Herfindahl index."""
    h = _c(hhi)
    return (F.when(h <= F.lit(competitive_max), F.lit("competitive"))
            .when(h >= F.lit(dominant_min), F.lit("dominant"))
            .when(h.isNotNull(), F.lit("contested")))


def margin_class(margin: ColumnLike, blowout_over: float = 100.0) -> Column:
    """X27: 'blowout' when the title margin exceeds the threshold."""
    m = _c(margin)
    return F.when(m > F.lit(blowout_over), F.lit("blowout")).when(m.isNotNull(), F.lit("contest"))
