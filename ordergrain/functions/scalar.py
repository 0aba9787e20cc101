"""Row-level expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in km and the length of a day in microseconds.
EARTH_RADIUS_KM = 6371.0088
MICROS_PER_DAY = 86_400_000_000

# Texts a CSV cell may hold to mean "missing", besides the empty cell.
MISSING_LITERALS = (
    "NA", "null", "NULL", "None", "nan", "NaN", "N/A", "n/a", "<NA>", "-nan", "-NaN",
    "#N/A", "#NA", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN", "#N/A N/A",
)


def null_if_missing(text: Column) -> Column:
    return F.when((text != "") & ~text.isin(*MISSING_LITERALS), text)


def parse_timestamp(text: Column) -> Column:
    """Timestamp without zone; unreadable text becomes null."""
    return text.try_cast("timestamp_ntz")


def haversine_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Great-circle distance; null as soon as one coordinate is null."""
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    half_lat = F.sin((phi_b - phi_a) / 2)
    half_lng = F.sin(F.radians(lng_b - lng_a) / 2)
    chord = F.sqrt(half_lat * half_lat + F.cos(phi_a) * F.cos(phi_b) * half_lng * half_lng)
    # Rounding may push the chord of antipodes above 1, where asin is NaN. least() skips
    # nulls, hence the guard.
    known = lat_a.isNotNull() & lng_a.isNotNull() & lat_b.isNotNull() & lng_b.isNotNull()
    return F.when(known, F.asin(F.least(F.lit(1.0), chord)) * (2 * EARTH_RADIUS_KM))


def box_volume(length: Column, height: Column, width: Column) -> Column:
    return length * height * width


def days_between(start: Column, end: Column) -> Column:
    """Fractional days from ``start`` to ``end``."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(MICROS_PER_DAY)


def whole_days_between(start: Column, end: Column) -> Column:
    return F.floor(days_between(start, end))


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def months_between_months(first: Column, later: Column) -> Column:
    return (F.year(later) - F.year(first)) * 12 + F.month(later) - F.month(first)


def late_flag(delivered_at: Column, late_days: Column) -> Column:
    """Null until delivered, then 1 after the promised date and 0 otherwise."""
    after_promise = F.coalesce(late_days > 0, F.lit(False))
    return F.when(delivered_at.isNotNull(), after_promise.cast("int"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null instead of an error when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def percent(share: Column) -> Column:
    return share * 100


def delivery_result(is_late: Column, null_policy: str = "on_time") -> Column:
    """Label lateness; ``null_policy`` is ``on_time`` or ``null`` for an unknown flag."""
    label = F.when(is_late == 1, "Late")
    if null_policy == "on_time":
        return label.otherwise("On time")
    if null_policy == "null":
        return label.when(is_late == 0, "On time")
    raise ValueError(f"Unknown null policy: {null_policy}")


def round_half_away(value: Column, places: int = 0) -> Column:
    """Round the double itself; Spark's ROUND works on its decimal text and sends 0.285 up."""
    scale = 10.0**places
    return F.round(value * scale, 0) / scale


def reaches(score: Column, threshold: Column | float) -> Column:
    return (score >= threshold).cast("int")


def threshold_at(index: Column) -> Column:
    """Point ``index`` (0 to 75) of the grid 0.05, 0.06, … 0.80."""
    return F.lit(0.05) + index * F.lit(0.01)


def rfm_segment(recency: Column, frequency: Column) -> Column:
    """Segment from the recency and frequency scores (1 to 4)."""
    often = frequency >= 3
    fresh = recency >= 3
    return (
        F.when(often & (recency >= 4), "Champions")
        .when(often & fresh, "Loyal")
        .when(fresh, "Recent")
        .when(often, "At risk")
        .otherwise("Hibernating")
    )


# Means of doubles depend in their last bits on the order of addition; text cuts them off first.
_TEXT_PLACES = 9


def number_text(value: Column, places: int) -> Column:
    return F.format_number(F.round(value, _TEXT_PLACES), places)


def count_text(value: Column) -> Column:
    return F.format_number(value, 0)


def money_text(value: Column, places: int = 0) -> Column:
    return F.concat(F.lit("R$ "), number_text(value, places))


def percent_text(share: Column) -> Column:
    cut = F.round(percent(share), _TEXT_PLACES)
    return F.concat(F.call_function("format_number", cut, F.lit("0.0")), F.lit("%"))


def title_text(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))
