"""Column builders for run and log records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: detail cap in bytes and the status/level rules
DETAIL_CAP_BYTES = 8192


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_level(status_code="status_code") -> Column:
    """>= 500 error, >= 400 warn, else info."""
    s = _col(status_code)
    return F.when(s >= 500, "error").when(s >= 400, "warn").otherwise("info")


def job_level(status="status") -> Column:
    """A job that is not ok logs at error."""
    return F.when(_col(status) == "ok", "info").otherwise("error")


def duration_ms(started="started_at", finished="finished_at") -> Column:
    """Whole milliseconds, truncated; null until both ends are known."""
    micros = F.timestamp_diff("MICROSECOND", _col(started), _col(finished))
    return F.when(micros >= 0, F.floor(micros / 1000)).otherwise(-F.floor(-micros / 1000)).cast("bigint")


def duration_s(started="started_at", finished="finished_at") -> Column:
    """Seconds as a double."""
    return F.timestamp_diff("MICROSECOND", _col(started), _col(finished)) / 1e6


def cap_detail(detail="detail", failed=None, cap_bytes: int = DETAIL_CAP_BYTES) -> Column:
    """Keep the body only when failed, cut to ``cap_bytes`` bytes, repair a cut character."""
    raw = F.substring(_col(detail).cast("binary"), 1, cap_bytes)
    capped = F.make_valid_utf8(raw.cast("string"))
    if failed is None:
        return capped
    return F.when(_col(failed), capped)
