"""Column builders for movement rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockflow.functions.calendar import fdiv


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def item_code(partkey) -> Column:
    """Item code of a numeric key: padded to seven digits, longer keys stay whole."""
    s = (F.col(partkey) if isinstance(partkey, str) else partkey).cast("string")
    return F.lpad(s, F.greatest(F.length(s), F.lit(7)), F.lit("0"))


def doc_ts(doc_date="doc_date", doc_time="doc_time") -> Column:
    """B2: business timestamp = date at midnight + HHMM; null time is midnight.

    No range check, like the source system: 2575 rolls over to 02:15 the next day.
    """
    t = F.coalesce(_col(doc_time).cast("int"), F.lit(0))
    minutes = fdiv(t, 100) * 60 + F.pmod(t, F.lit(100))
    return F.timestamp_add("MINUTE", minutes, _col(doc_date).cast("date").cast("timestamp_ntz"))


MOV_ID_PARTS = ("company", "trans_type", "base_entry", "doc_line", "item_code", "warehouse")


def mov_id(*parts) -> Column:
    """Audit hash of the natural-key parts joined by '|'; null if any part is null."""
    cols = [_col(p).cast("string") for p in (parts or MOV_ID_PARTS)]
    joined = []
    for i, c in enumerate(cols):
        if i:
            joined.append(F.lit("|"))
        joined.append(c)
    return F.md5(F.concat(*joined))


def value_direction(trans_value="trans_value") -> Column:
    """B6: 'in' when value enters, 'out' when it leaves, 'none' at zero."""
    v = _col(trans_value)
    return F.when(v > 0, "in").when(v < 0, "out").when(v == 0, "none")


def source_doc_ref(trans_type="trans_type", base_entry="base_entry", doc_line="doc_line") -> Column:
    """Pointer to the exact source line as text ``type:entry:line``."""
    return F.concat_ws(":", _col(trans_type).cast("string"), _col(base_entry).cast("string"),
                       _col(doc_line).cast("string"))


def net_qty(in_qty="in_qty", out_qty="out_qty") -> Column:
    """Signed quantity; null if either side is null, so SUM skips the row (as the source)."""
    return _col(in_qty) - _col(out_qty)
