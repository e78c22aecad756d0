"""A1 as a partitioned source: movements pulled from company databases window by window.

The extract of a company is an indexed range scan on the capture date, asked of a database through a
function of the user's. Spark reads it as a data source with one input partition for each company and
capture month; filters on ``company`` and ``create_date`` reach the planning, so windows that they rule
out are never asked for, and narrow the range that the others ask for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema

from stockflow.schemas import SOURCE_COLUMNS
from stockflow.sources.movements import window_pred

#: (company, since, until) -> record batches of the source columns captured in ``[since, until)``.
Fetch = Callable[[str, date, date], Iterable[pa.RecordBatch]]
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@dataclass
class Window(InputPartition):
    company: str
    since: date
    until: date


def month_windows(since: date, until: date) -> Iterator[tuple[date, date]]:
    """``[since, until)`` cut at the first days of months."""
    while since < until:
        following = (since.replace(day=1) + timedelta(days=32)).replace(day=1)
        yield since, min(following, until)
        since = following


class _Reader(DataSourceReader):
    def __init__(self, fetch: Fetch, companies: Sequence[str], since: date, until: date, schema: T.StructType):
        self.fetch, self.companies, self.since, self.until, self.schema = fetch, list(companies), since, until, schema

    def pushFilters(self, filters):
        """Take in bounds on the capture date and the companies; every filter is still applied by Spark."""
        for f in filters:
            name = getattr(f, "attribute", None)
            if name == ("company",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
                if wanted is not None:
                    self.companies = [c for c in self.companies if c in wanted]
            elif name == ("create_date",) and isinstance(getattr(f, "value", None), date):
                day = timedelta(days=1)
                if isinstance(f, (GreaterThanOrEqual, EqualTo)):
                    self.since = max(self.since, f.value)
                if isinstance(f, GreaterThan):
                    self.since = max(self.since, f.value + day)
                if isinstance(f, LessThan):
                    self.until = min(self.until, f.value)
                if isinstance(f, (LessThanOrEqual, EqualTo)):
                    self.until = min(self.until, f.value + day)
            yield f

    def partitions(self):
        return [Window(c, a, b) for c in self.companies for a, b in month_windows(self.since, self.until)]

    def read(self, partition):
        if partition is None:  # no window is left
            return
        target = to_arrow_schema(T.StructType([f for f in self.schema if f.name != "company"]))
        for b in self.fetch(partition.company, partition.since, partition.until):
            rows = pa.Table.from_batches([b]).select(target.names).cast(target)
            tag = pa.array([partition.company] * b.num_rows, pa.string())
            yield from pa.Table.from_arrays([tag, *rows.columns], names=self.schema.names).to_batches()


def read_extract(spark: SparkSession, fetch: Fetch, companies: Sequence[str], since: date, until: date, schema: T.StructType) -> DataFrame:
    """Movements of the companies captured in ``[since, until)`` as a DataFrame of the source columns.

    ``fetch`` runs on the executors and must be picklable; ``schema`` gives the types of ``company`` and
    the source columns. Turns Spark's filter push-down for Python sources on in the session."""
    spark.conf.set(PUSHDOWN, "true")
    own = T.StructType([T.StructField("company", T.StringType()), *[schema[c] for c in SOURCE_COLUMNS]])

    class MovementExtract(DataSource):
        @classmethod
        def name(cls):
            return "stockflow_movements"

        def schema(self):
            return own

        def reader(self, schema):
            return _Reader(fetch, companies, since, until, own)

    spark.dataSource.register(MovementExtract)
    # the filter also makes every plan push down anew: without any, Spark would plan with the windows
    # that the last plan on this frame has left
    return spark.read.format("stockflow_movements").load().filter(window_pred("create_date", since, until))
