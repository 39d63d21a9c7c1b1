"""Number, month, id and range expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fluxsieve import fixed


def significant(c: Column, figures: int) -> Column:
    """Round to a number of significant figures (half even)."""
    step = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))) - (figures - 1))
    return F.when(c == 0, F.lit(0.0)).otherwise(
        # steps below one are divided by their exact reciprocal, so 0.235 stays 0.235
        F.when(step < 1, F.bround(c * F.bround(1 / step)) / F.bround(1 / step))
        .otherwise(F.bround(c / step) * step)
    )


def top_count(n: Column, fraction: float) -> Column:
    """Size of a shortlist: half-even rounded share, never below one."""
    return F.greatest(F.lit(1), F.bround(n * F.lit(fraction)).cast("int"))


def days_in_month(c: Column) -> Column:
    return F.dayofmonth(F.last_day(c))


def month_start(period: Column) -> Column:
    """DATE of a 'yyyy-MM' period, null when the text is not one."""
    return F.when(period.rlike(fixed.PERIOD_PATTERN), F.to_date(F.concat(period, F.lit("-01"))))


def month_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def months_between(start: Column, end: Column) -> Column:
    """Every first-of-month from start to end, both included."""
    return F.sequence(start, end, F.expr("interval 1 month"))


def market_time(c: Column) -> Column:
    return F.to_timestamp(c, fixed.MARKET_TIME)


def hourly_time(c: Column) -> Column:
    return F.to_timestamp(c, fixed.HOURLY_TIME)


def hour_month(interval_end: Column) -> Column:
    """First day of the month an hour-ending interval belongs to."""
    return F.trunc((interval_end - F.expr("interval 1 hour")).cast("date"), "month")


def layer_version(edited_ms: Column) -> Column:
    """Version tag of a map layer from its last-edit time in epoch milliseconds."""
    return F.concat(F.lit("hifld_open_"), F.date_format(F.timestamp_millis(edited_ms), "yyyy-MM-dd"))


def derived_id(label: Column, parents: Column) -> Column:
    """Stable id of a derived value: hash of its label and sorted parent ids."""
    marked = F.transform(F.array_sort(parents), lambda p: F.concat(F.lit("\x00"), p))
    return F.concat(
        F.lit("drv:"), F.substring(F.sha2(F.concat(label, F.array_join(marked, "")), 256), 1, 16)
    )


def canonical_digest(c: Column) -> Column:
    """sha256 of the compact JSON of a struct whose fields are in key order."""
    return F.sha2(F.to_json(c), 256)


def constraint_id(name: Column, contingency: Column) -> Column:
    return F.concat_ws("|", name, contingency)


def usable_constraint_name(name: Column, contingency: Column) -> Column:
    filled = (F.coalesce(name, F.lit("")) != "") & (F.coalesce(contingency, F.lit("")) != "")
    return filled & ~name.contains("|") & ~contingency.contains("|")


def band(point: Column, lo: float, hi: float) -> Column:
    """Range around a point estimate as fractions of it."""
    return F.struct(
        (point * F.lit(lo)).alias("lo"), point.alias("expected"), (point * F.lit(hi)).alias("hi")
    )


def range_of(lo: Column, expected: Column, hi: Column) -> Column:
    return F.struct(lo.alias("lo"), expected.alias("expected"), hi.alias("hi"))


def spread(point: Column, width: float = fixed.ABSENT_SPREAD) -> Column:
    """A point with a small band that never goes below zero."""
    return range_of(F.greatest(F.lit(0.0), point - F.lit(width)), point, point + F.lit(width))


def scaled(rng: Column, reference: float) -> Column:
    d = F.lit(float(reference or 1.0))
    return range_of(rng["lo"] / d, rng["expected"] / d, rng["hi"] / d)


def ordered_range(rng: Column) -> Column:
    """The quality predicate every range must satisfy."""
    return (rng["lo"] <= rng["expected"]) & (rng["expected"] <= rng["hi"])


def forward_share(predictor: str, months: Column) -> Column:
    if predictor == "annual":
        return F.lit(1.0)
    held = F.least(F.greatest(months, F.lit(0)), F.lit(12)) / F.lit(12.0)
    return F.when(months.isNotNull(), held).otherwise(F.lit(1.0))


def interpolate(u: Column, points: list[tuple[float, float]]) -> Column:
    """Piecewise linear function through ``points``, constant outside them."""
    out = F.lit(float(points[0][1]))
    for (p0, v0), (p1, v1) in zip(points, points[1:]):
        slope = (v1 - v0) / (p1 - p0)
        out = F.when(u >= F.lit(float(p0)), F.lit(float(v0)) + (u - F.lit(float(p0))) * F.lit(slope)
                     ).otherwise(out)
    return F.when(u >= F.lit(float(points[-1][0])), F.lit(float(points[-1][1]))).otherwise(out)


def interpolated_mean(points: list[tuple[float, float]]) -> float:
    """Mean of the interpolated quantile function (a handful of configured points)."""
    return sum((p1 - p0) * (v1 + v0) / 2 for (p0, v0), (p1, v1) in zip(points, points[1:]))
