"""Column expressions over ordered windows.

Every expression stays inside the JVM. A missing or undefined result is NULL,
never NaN, because ``avg``, ``max`` and friends skip NULL only.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365


def missing_as_null(value: Column) -> Column:
    """NaN to NULL, for values that arrive from files."""
    return F.when(~F.isnan(value), value)


def utc_time(seconds: Column) -> Column:
    """Unix seconds to the wall clock in UTC, whatever the session time zone is."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def relative_change(value: Column, base: Column) -> Column:
    """``value / base - 1``; NULL when the base is missing or zero."""
    return F.try_divide(value, base) - F.lit(1.0)


def change_over_rows(value: Column, n: int, ordered: WindowSpec) -> Column:
    """Relative change against the value ``n`` rows earlier."""
    return relative_change(value, F.lag(value, n).over(ordered))


def moments(value: Column, frame: WindowSpec) -> Column:
    """(n, mean, m2) of the values present: their number, mean and squared distances."""
    present = F.count(value).over(frame)
    return F.struct(
        present.alias("n"),
        F.avg(value).over(frame).alias("mean"),
        (F.var_pop(value).over(frame) * present).alias("m2"),
    )


def merged_moments(a: Column, b: Column) -> Column:
    """Moments of two sets of values from the moments of each; NULL means none."""
    zero = F.lit(0)
    n_a, n_b = F.coalesce(a["n"], zero), F.coalesce(b["n"], zero)
    n, apart = n_a + n_b, b["mean"] - a["mean"]
    both = F.struct(
        n.alias("n"),
        (a["mean"] + F.try_divide(apart * n_b, n)).alias("mean"),
        (a["m2"] + b["m2"] + F.try_divide(apart * apart * n_a * n_b, n)).alias("m2"),
    )
    return F.when(n_a == 0, b).when(n_b == 0, a).otherwise(both)


def sample_deviation(state: Column, n: int) -> Column:
    """Sample deviation of moments, NULL unless ``n`` values are there."""
    return F.when(state["n"] >= n, F.sqrt(F.try_divide(state["m2"], state["n"] - F.lit(1))))


def below_peak(value: Column, peak: Column) -> Column:
    """Drawdown: distance of a value from the peak so far, as a share of it."""
    return F.try_divide(value - peak, peak)


def annual_growth(first: Column, last: Column, days: Column) -> Column:
    """Compound growth per 365 calendar days; NULL for a span of zero days."""
    return F.pow(F.try_divide(last, first), F.try_divide(F.lit(float(DAYS_PER_YEAR)), days)) - F.lit(1.0)


def latest_present(value: Column, order: Column) -> Column:
    """Aggregate: the last value that is not NULL, in the given order."""
    return F.max_by(value, F.when(value.isNotNull(), order))
