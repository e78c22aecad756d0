"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions import calendar as cal
from stockflow.sources.movements import window_pred


def window_filter(df: DataFrame, col: str, since=None, until=None) -> DataFrame:
    """Half-open ``[since, until)``."""
    return df.filter(window_pred(col, since, until))


def range_filter(df: DataFrame, col: str, since=None, until=None) -> DataFrame:
    """Closed ``[since, until]``; each bound optional."""
    pred = F.lit(True)
    if since is not None:
        pred = pred & (F.col(col) >= F.lit(since))
    if until is not None:
        pred = pred & (F.col(col) <= F.lit(until))
    return df.filter(pred)


def field_filters(df: DataFrame, **eq) -> DataFrame:
    """D3: AND of optional equalities; None means "no filter on this field"."""
    out = df
    for c, v in eq.items():
        if v is not None:
            out = out.filter(F.col(c) == F.lit(v))
    return out


def between_doc_dates(mov: DataFrame, lo, hi) -> DataFrame:
    """Closed doc_date range plus the implied ``retail_year`` range.

    On a table sorted by ``retail_year`` the second predicate skips row groups by their statistics,
    which Catalyst cannot derive from a ``doc_date`` filter by itself.
    """
    y_lo, y_hi = cal.retail_year_of(lo), cal.retail_year_of(hi)
    return mov.filter(F.col("retail_year").between(y_lo, y_hi)
                      & F.col("doc_date").between(F.lit(lo), F.lit(hi)))


def scoped_view(df: DataFrame, grants: DataFrame, user: str, scope_col: str,
                grant_user: str = "user", grant_scope: str = "scope") -> DataFrame:
    """Keep rows whose scope is granted to ``user`` (left-semi join).

    The grants of one user are a handful of scopes; the semi join lets the planner broadcast
    them when their measured size is under the broadcast threshold, else it shuffles.
    """
    g = grants.filter(F.col(grant_user) == user).select(F.col(grant_scope).alias("_scope")).distinct()
    return df.join(g, df[scope_col] == g["_scope"], "left_semi")


def lookup(df: DataFrame, **key) -> DataFrame:
    """Point lookup; an absent key gives an empty frame."""
    return field_filters(df, **key)


def text_search(df: DataFrame, q: str, cols: list[str]) -> DataFrame:
    """Case-insensitive substring match on any of ``cols``."""
    needle = q.lower()
    pred = F.lit(False)
    for c in cols:
        pred = pred | F.coalesce(F.lower(F.col(c)).contains(needle), F.lit(False))
    return df.filter(pred)


__all__ = ["window_filter", "range_filter", "field_filters", "between_doc_dates", "scoped_view",
           "lookup", "text_search", "cal"]
