"""Time expressions (F1-F6, F12, P10). The session time zone must be UTC."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def parse_time(c: Column | str, fmt: str | None = None) -> Column:
    """text to timestamp; ISO text when no format is given."""
    return F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)


def require_utc() -> None:
    """Fails unless the session's time zone is UTC; in another, keys and calendar columns would silently differ."""
    session = SparkSession.getActiveSession()
    zone = session.conf.get("spark.sql.session.timeZone") if session is not None else "UTC"
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"the session time zone is {zone}; set spark.sql.session.timeZone to UTC")


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    """Hour, day of month, month, weekday with Monday = 0, and the weekend flag."""
    require_utc()
    weekday = F.weekday(ts)
    return {
        "Hour": F.hour(ts),
        "Day": F.dayofmonth(ts),
        "Month": F.month(ts),
        "DayOfWeek": weekday,
        "IsWeekend": weekday.isin(5, 6).cast("int"),
    }


def epoch_key(ts: Column | str) -> Column:
    """whole epoch seconds as text. Unique only if rows are at least a second apart."""
    require_utc()
    return F.unix_seconds(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp")).cast("string")


def utc_now() -> Column:
    """current time; one value per query."""
    return F.to_utc_timestamp(F.current_timestamp(), "UTC")


def load_stamp(at: datetime | None = None) -> Column:
    """P10: one constant stamp for all tables of a run, so separate writes agree."""
    at = at or datetime.now(timezone.utc)
    micros = round(at.timestamp() * 1_000_000)
    return F.timestamp_micros(F.lit(micros))


def step_after(ts: Column | str, steps: Column | int, minutes: int = 10) -> Column:
    """a timestamp plus a number of fixed steps."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    steps = F.lit(steps) if isinstance(steps, int) else steps
    total = steps.cast("bigint") * F.lit(minutes).cast("bigint")
    # Days and the rest apart: minutes alone would not fit an INT after some 4,000 years.
    days = F.floor(total / 1440).cast("int")
    return ts + F.make_dt_interval(days=days, mins=F.pmod(total, F.lit(1440).cast("bigint")).cast("int"))
