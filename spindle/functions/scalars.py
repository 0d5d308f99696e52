"""Scalar Column helpers: label rules, integer division, record parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spindle.functions.text import java_split

# Fixed value: canonical textual UUID (8-4-4-4-12 hex digits).
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def binarize_label(c) -> Column:
    """0 -> 0.0, any other number -> 1.0 (a middle class counts as positive)."""
    c = _col(c)
    return (F.when(c.isNull(), F.lit(None).cast("double"))
            .when(c == 0, F.lit(0.0)).otherwise(F.lit(1.0)))


def int_div(a, b) -> Column:
    """Integer division truncating toward zero (SQL `div`, Java `/` on ints).

    Division by zero gives null instead of failing the task.
    """
    b = _col(b)
    return F.call_function("div", _col(a), F.when(b != 0, b))


def parse_sensor_line(c, delimiter: str = ",") -> Column:
    """`uuid,heart_rate,calorie` -> struct(session_id, heart_rate, calorie).

    Bad numbers become null (try_cast) so a caller can route the row to a
    reject table instead of failing the job.
    """
    parts = java_split(_col(c), delimiter)
    return F.struct(
        F.get(parts, 0).alias("session_id"),
        F.get(parts, 1).try_cast("int").alias("heart_rate"),
        F.get(parts, 2).try_cast("int").alias("calorie"),
    )


def is_uuid(c) -> Column:
    return _col(c).rlike(UUID_PATTERN)


def json_field(c, path: str) -> Column:
    return F.get_json_object(_col(c), path)


def to_bytes(c) -> Column:
    return F.encode(_col(c), "UTF-8")


def from_bytes(c) -> Column:
    return F.decode(_col(c), "UTF-8")


def bucket_start(c, seconds: int) -> Column:
    """Start of the fixed bucket of `seconds` that holds `c`, aligned to 1970 on
    the clock that the value shows. Keeps the timestamp type (zone-free stays
    zone-free, unlike date_trunc) and keeps nulls (unlike `window`, which drops
    their rows)."""
    c = _col(c)
    days = F.date_diff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    whole = days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    into = F.pmod(whole, F.lit(int(seconds))) + F.extract(F.lit("SECOND"), c)
    zero = F.lit(0)
    return c - F.make_dt_interval(zero, zero, zero, F.pmod(into, F.lit(int(seconds)).cast("decimal(18,6)")))
