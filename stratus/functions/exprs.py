"""Column -> Column expressions (validation, labels, scores, time helpers).

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Physically valid ranges (inclusive) and the suspicious-row rule.
TEMP_MIN, TEMP_MAX = -90, 60
HUMIDITY_MIN, HUMIDITY_MAX = 0, 100
# Weather-code labels, in the order they are tested; anything else is Unknown.
WEATHER_LABELS = [
    ("Clear sky", [0]),
    ("Cloudy", [1, 2, 3]),
    ("Fog", [45, 48]),
    ("Drizzle", [51, 53, 55]),
    ("Rain", [61, 63, 65]),
    ("Snow", [71, 73, 75, 77]),
    ("Rain showers", [80, 81, 82]),
    ("Thunderstorm", [95, 96, 99]),
]
UNKNOWN_LABEL = "Unknown"
# Continent -> sales-style region; anything else is OTHER.
REGIONS = [
    ("Europe", "EMEA"),
    ("Africa", "EMEA"),
    ("Asia", "APAC"),
    ("Oceania", "APAC"),
    ("North America", "AMER"),
    ("South America", "AMER"),
]
OTHER_REGION = "OTHER"
# Extreme-event thresholds (strict) and label priority.
HEAT_C, FREEZE_C, HIGH_WIND_KMH, HEAVY_RAIN_MM = 35, -10, 60, 10
EVENT_TYPES = ["Thunderstorm", "Heatwave", "Freeze", "High winds", "Heavy rain", "Other"]
# Anomaly thresholds on |z|.
SIGNIFICANT_Z, EXTREME_Z = 2, 3
# Fahrenheit from Celsius: 9/5 and 32.
F_PER_C, F_OFFSET = Decimal("1.8"), 32
# Days of a baseline, and the readings a city needs for one.
BASELINE_DAYS, MIN_BASELINE_SAMPLES = 30, 24
SEVERITIES = ["extreme", "significant", "normal"]
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _memo(fn):
    """Cache an expression builder when every argument is a plain name or number.

    Building a long CASE chain costs one JVM round trip per node; the built
    Column is an immutable, unresolved expression, so it is reused.
    """
    cache: dict = {}

    def wrapper(*args):
        if all(isinstance(a, (str, int, float)) for a in args):
            if args not in cache:
                cache[args] = fn(*args)
            return cache[args]
        return fn(*args)
    wrapper.__doc__, wrapper.__name__ = fn.__doc__, fn.__name__
    return wrapper


@_memo
def in_range_or_null(c, lo, hi) -> Column:
    """Keep ``c`` when ``lo <= c <= hi`` (inclusive), else NULL."""
    c = _c(c)
    return F.when(c.between(lo, hi), c)


@_memo
def at_least_or_null(c, lo) -> Column:
    """Keep ``c`` when ``c >= lo``, else NULL."""
    c = _c(c)
    return F.when(c >= lo, c)


@_memo
def c_to_f(c) -> Column:
    """Celsius -> Fahrenheit, rounded to 2 places, only for valid temperatures.

    Decimal arithmetic, so 20.55 -> 68.99 exactly (no binary-float drift).
    """
    c = _c(c)
    f = F.round(c * F.lit(F_PER_C) + F_OFFSET, 2).cast("decimal(7,2)")
    return F.when(c.between(TEMP_MIN, TEMP_MAX), f)


@_memo
def weather_label(code) -> Column:
    """P5: weather code -> label; unmatched and NULL codes give Unknown."""
    code = _c(code)
    out = None
    for label, codes in WEATHER_LABELS:
        cond = code.isin(codes)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(UNKNOWN_LABEL))


@_memo
def is_suspicious(temperature, humidity) -> Column:
    """Raw temperature or humidity outside the valid range.

    Three-valued logic resolved like a searched CASE: NULL inputs do not flag,
    so the result is never NULL.
    """
    t, h = _c(temperature), _c(humidity)
    return (F.when((t < TEMP_MIN) | (t > TEMP_MAX), F.lit(True))
            .when((h < HUMIDITY_MIN) | (h > HUMIDITY_MAX), F.lit(True))
            .otherwise(F.lit(False)))


@_memo
def region_of(continent) -> Column:
    """Continent -> region."""
    c = _c(continent)
    out = None
    for cont, region in REGIONS:
        cond = c == cont
        out = F.when(cond, F.lit(region)) if out is None else out.when(cond, F.lit(region))
    return out.otherwise(F.lit(OTHER_REGION))


@_memo
def is_extreme_event(temperature_c, windspeed_kmh, precipitation_mm, condition) -> Column:
    """P10: disjunctive extreme-event predicate, strict bounds."""
    t, w, p, cond = map(_c, (temperature_c, windspeed_kmh, precipitation_mm, condition))
    return ((t > HEAT_C) | (t < FREEZE_C) | (w > HIGH_WIND_KMH) | (p > HEAVY_RAIN_MM)
            | (cond == "Thunderstorm"))


@_memo
def event_type(temperature_c, windspeed_kmh, precipitation_mm, condition) -> Column:
    """Event label by priority Thunderstorm > Heatwave > Freeze > High winds > Heavy rain."""
    t, w, p, cond = map(_c, (temperature_c, windspeed_kmh, precipitation_mm, condition))
    return (F.when(cond == "Thunderstorm", F.lit("Thunderstorm"))
            .when(t > HEAT_C, F.lit("Heatwave"))
            .when(t < FREEZE_C, F.lit("Freeze"))
            .when(w > HIGH_WIND_KMH, F.lit("High winds"))
            .when(p > HEAVY_RAIN_MM, F.lit("Heavy rain"))
            .otherwise(F.lit("Other")))


# ----------------------------------------------------------------- scores ---

def safe_div(a, b) -> Column:
    """``a / NULLIF(b, 0)`` — NULL instead of an ANSI divide-by-zero error."""
    return _c(a) / F.nullif(_c(b), F.lit(0))


def z_score(x, mean, stddev) -> Column:
    """F12 (unrounded): ``(x - mean) / NULLIF(stddev, 0)`` in double precision."""
    return safe_div(_c(x).cast("double") - _c(mean), _c(stddev))


def iqr_score(x, mean, p25, p75) -> Column:
    """F13 (unrounded): ``(x - mean) / NULLIF(p75 - p25, 0)`` — centred on the mean."""
    return safe_div(_c(x).cast("double") - _c(mean), _c(p75) - _c(p25))


@_memo
def severity(z) -> Column:
    """|z| > 3 extreme, > 2 significant, otherwise (and NULL) normal."""
    a = F.abs(_c(z))
    return (F.when(a > EXTREME_Z, F.lit("extreme"))
            .when(a > SIGNIFICANT_Z, F.lit("significant"))
            .otherwise(F.lit("normal")))


@_memo
def is_anomaly(z) -> Column:
    """|z| > 2; NULL when z is NULL."""
    return F.abs(_c(z)) > SIGNIFICANT_Z


@_memo
def alert_severity(z) -> Column:
    """F16: severity of a streamed alert (only called for |z| > 2)."""
    return F.when(F.abs(_c(z)) > EXTREME_Z, F.lit("extreme")).otherwise(F.lit("significant"))


# ------------------------------------------------------------ aggregates ---

def exact_avg(c, scale: int, precision: int = 10, in_scale: int | None = None) -> Column:
    """A3: ``ROUND(AVG(c), scale)`` computed exactly, half away from zero.

    ``c`` is a decimal or integer column with at most ``in_scale`` fractional
    digits (default ``scale``). With ``u`` = the sum in units of 10^-in_scale
    and ``n`` the non-null count, the rounded mean in units of 10^-scale is
    ``sign(u) * floor((2|u|*10^scale + n*10^in_scale) / (2n*10^in_scale))``.
    Both inputs are algebraic aggregates, so the plan keeps a map-side partial
    aggregation; Spark's own ``avg(decimal)`` would round twice (to 6 places,
    then to ``scale``). The per-row sum is a 64-bit integer (overflow raises
    under ANSI, and needs ~10^14 rows in one group); only the per-group
    finish uses wide decimals.
    """
    c = _c(c)
    k = scale if in_scale is None else in_scale
    return rounded_mean(F.sum(units_of(c, k)), F.count(c), scale, precision, k)


def units_of(c, scale: int) -> Column:
    """``c`` as a whole number of units of 10^-scale."""
    return (_c(c) * F.lit(10 ** scale)).cast("bigint")


def rounded_mean(units: Column, count: Column, scale: int, precision: int = 10,
                 in_scale: int | None = None) -> Column:
    """The finish of :func:`exact_avg`, from a sum in units of 10^-in_scale and its count."""
    k = scale if in_scale is None else in_scale
    units = units.cast("decimal(38,0)")
    n = F.nullif(count, F.lit(0)).cast("decimal(38,0)")
    num = (F.lit(2 * 10 ** scale) * F.abs(units) + n * F.lit(10 ** k)).cast("decimal(38,0)")
    rounded = F.signum(units).cast("decimal(38,0)") * _int_div(num, n * F.lit(2 * 10 ** k))
    return (rounded / F.lit(10 ** scale)).cast(f"decimal({precision},{scale})")


def exact_sum(c, scale: int = 2, precision: int = 38) -> Column:
    """A5: ``SUM(c)`` of a decimal with ``scale`` fractional digits, exactly.

    Summed as 64-bit integer units (cheap per row, overflow raises under ANSI)
    and turned back into ``decimal(precision, scale)`` once per group; NULL
    when every input is NULL.
    """
    c = _c(c)
    units = F.sum((c * F.lit(10 ** scale)).cast("bigint"))
    return (units.cast("decimal(38,0)") / F.lit(10 ** scale)).cast(f"decimal({precision},{scale})")


def _int_div(a: Column, b: Column) -> Column:
    """Exact floor division of two non-negative decimal(38,0) columns.

    ``a - a % b`` is a multiple of ``b``, so the decimal quotient is an exact
    integer and no intermediate rounding can move it across a boundary.
    """
    return ((a - a % b) / b).cast("decimal(38,0)")


# Fractional digits that a daily mean keeps before it is averaged again.
MEAN_DIGITS = 16


def wide_mean(units: Column, count: Column, in_scale: int = 2) -> Column:
    """Mean as a whole number of 10^-16, rounded half away from zero (decimal(38,0))."""
    u = units.cast("decimal(38,0)")
    n = F.nullif(count, F.lit(0)).cast("decimal(38,0)")
    shift = F.lit(2 * 10 ** (MEAN_DIGITS - in_scale)).cast("decimal(18,0)")
    num = (F.abs(u).cast("decimal(20,0)") * shift).cast("decimal(38,0)") + n
    whole = _int_div(num.cast("decimal(38,0)"), (n * F.lit(2)).cast("decimal(38,0)"))
    return (F.signum(u).cast("decimal(2,0)") * whole).cast("decimal(38,0)")


def exact_mean(c, scale: int = 2) -> Column:
    """Mean as a double from the exact integer sum: order-independent.

    ``sum(units) / 10^scale`` is one correctly rounded division (the integer
    sum is exact below 2^53), then divided by the count.
    """
    c = _c(c)
    return mean_of(F.sum(units_of(c, scale)), F.count(c), scale)


def mean_of(units: Column, count: Column, scale: int = 2) -> Column:
    """The finish of :func:`exact_mean`."""
    return units.cast("double") / float(10 ** scale) / F.nullif(count, F.lit(0))


def exact_stddev_samp(c, scale: int = 2) -> Column:
    """Sample standard deviation from exact integer moments.

    ``sum(u)``, ``sum(u^2)`` and ``n`` (``u`` = value in units of 10^-scale)
    are exact decimal sums, so the variance numerator ``n*sum(u^2) - sum(u)^2``
    is exact and free of cancellation; only the final division and square root
    are floating point. NULL for fewer than two values (as STDDEV).
    """
    c = _c(c)
    u = (c * F.lit(10 ** scale)).cast("bigint")
    # u^2 summed as a wide decimal: a 64-bit sum of squares could overflow for
    # a hot group at scale.
    return stddev_of(F.sum(u), F.sum((u * u).cast("decimal(38,0)")), F.count(c), scale)


def stddev_of(s1: Column, s2: Column, n: Column, scale: int = 2) -> Column:
    """The finish of :func:`exact_stddev_samp`, from the sums of u and u^2 and the count."""
    s1 = s1.cast("decimal(38,0)")
    num = (n.cast("decimal(38,0)") * s2 - s1 * s1).cast("decimal(38,0)")
    den = n.cast("double") * (n - 1).cast("double")
    var = F.when(n > 1, num.cast("double") / den / float(10 ** (2 * scale)))
    return F.sqrt(var)


def overflowed(pairs: list[tuple[Column, Column]]) -> Column:
    """The one reject rule for measures: a value is present but does not fit its column."""
    bad = F.lit(False)
    for raw, stored in pairs:
        bad = bad | (raw.isNotNull() & stored.isNull())
    return bad


# ------------------------------------------------------------ time / text ---

def ts_literal(as_of: datetime, ntz: bool = False) -> Column:
    """A timestamp literal for ``as_of`` (naive datetimes are UTC)."""
    lit = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return lit if ntz else lit.cast("timestamp")


def since(c, as_of: datetime, interval: str, inclusive: bool = False,
          ntz: bool = False) -> Column:
    """``c >= / > as_of - INTERVAL``; no upper bound (future rows count)."""
    lo = ts_literal(as_of, ntz) - F.expr(f"INTERVAL {interval}")
    return _c(c) >= lo if inclusive else _c(c) > lo


def recent(df: DataFrame, c: str, as_of: datetime, interval: str, inclusive: bool = False,
           ntz: bool = False, partition: str = "reading_date") -> DataFrame:
    """Rows of ``df`` that satisfy :func:`since`.

    On a table partitioned by the day of ``c`` the implied bound on the
    partition column is added, so older days are pruned before any file is
    opened.
    """
    out = df.where(since(c, as_of, interval, inclusive, ntz))
    if partition in df.columns:
        day = F.to_date(ts_literal(as_of, True) - F.expr(f"INTERVAL {interval}"))
        out = out.where(F.col(partition) >= day)
    return out


def older_than(c, as_of: datetime, interval: str, ntz: bool = False) -> Column:
    """``c < as_of - INTERVAL``."""
    return _c(c) < ts_literal(as_of, ntz) - F.expr(f"INTERVAL {interval}")


def slug(name) -> Column:
    """spaces -> underscores, lower case (``São Paulo`` -> ``são_paulo``)."""
    return F.lower(F.translate(_c(name), " ", "_"))


def landing_key(name, ts) -> Column:
    """``city=<slug>/year=YYYY/month=MM/day=DD/hour=HH/data.json``."""
    ts = _c(ts)
    return F.concat(
        F.lit("city="), slug(name),
        F.lit("/year="), F.date_format(ts, "yyyy"),
        F.lit("/month="), F.date_format(ts, "MM"),
        F.lit("/day="), F.date_format(ts, "dd"),
        F.lit("/hour="), F.date_format(ts, "HH"),
        F.lit("/data.json"))


def iso_utc(ts) -> Column:
    """timestamp as ISO-8601 with a trailing ``Z``."""
    return F.concat(F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def parse_hour(c) -> Column:
    """lenient ``2026-04-06T00:00`` (no seconds) -> timestamp; bad text -> NULL."""
    return F.try_to_timestamp(_c(c), F.lit("yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS][XXX]"))
