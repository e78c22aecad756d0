"""Movement table sink: ensure, window replace, merge, sync, back-fill, partitioned read, compaction
(A5-A10, D5 helper).

Layout: Parquet under ``root/company=C/load_month=YYYY-MM``. Load windows are on ``create_date``
(the capture date); ``load_month`` is its month. Files are sorted by ``retail_year`` and
``doc_date``, so reads by business date (D5, A9) skip row groups by their statistics.

Replacing ``[since, until)`` rewrites only the months the window touches: months fully inside it
are replaced by the incoming rows alone, and the at most two boundary months keep their existing
rows outside the window, which are staged first. Leaves of the window that the new extract no
longer produces are removed. Cost is proportional to the window plus two months, never the table.

Guarantee: one writer; not atomic across partitions. Re-running a window repairs an interrupted
replace. The staged rows of boundary months outlive a failed write, and the next call on the table
puts back those that the cut-off commit removed (``recover``). Staging folders live next to the
table (shared storage), never on a machine-local disk.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.functions.calendar import retail_year_cuts, retail_year_of
from stockflow.schemas import MOVEMENT_COLUMNS, MOVEMENT_SCHEMA, SOURCE_COLUMNS
from stockflow.sources.movements import FLOOR_DATE, finalize, read_movements

PARTITION_COLUMNS = ("company", "load_month")
TARGET_ROWS_PER_FILE = 5_000_000
#: Written into a staging folder just before the table is touched.
MARKER = "COMMITTING"
#: The list of files that the merged ones of a compaction replace.
SWAP = "REPLACED"


# --- file-system helpers (Hadoop FileSystem API; works for any shared store) -----------------

def _path(spark: SparkSession, p: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(p)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark, p: str) -> bool:
    path, fs = _path(spark, p)
    return fs.exists(path)


def _delete(spark, p: str) -> None:
    path, fs = _path(spark, p)
    if fs.exists(path):
        fs.delete(path, True)


def _list_dirs(spark, p: str) -> list[str]:
    path, fs = _path(spark, p)
    if not fs.exists(path):
        return []
    return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName()[0] not in "_."]


# --- A5 / A9 ------------------------------------------------------------------------------------

def ensure_table(spark: SparkSession, root: str, name: str | None = None) -> str:
    """A5: idempotent create of the partitioned table (folder, and a catalog entry if named)."""
    path, fs = _path(spark, root)
    if not fs.exists(path):
        fs.mkdirs(path)
    if name:
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _table_schema().fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                  f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{root}'")
    return root


def _table_schema() -> T.StructType:
    data = [f for f in MOVEMENT_SCHEMA.fields if f.name not in PARTITION_COLUMNS]
    parts = [next(f for f in MOVEMENT_SCHEMA.fields if f.name == c) for c in PARTITION_COLUMNS if c != "load_month"]
    return T.StructType(data + parts + [T.StructField("load_month", T.StringType())])


def _read_raw(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(_table_schema()).parquet(root)


def load_month(create_date="create_date"):
    c = F.col(create_date) if isinstance(create_date, str) else create_date
    return F.date_format(c, "yyyy-MM")


def _months(since: date, until: date) -> list[str]:
    """Months touched by ``[since, until)``."""
    out, y, m = [], since.year, since.month
    last = until - timedelta(days=1)
    while (y, m) <= (last.year, last.month):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def _month_bounds(ym: str) -> tuple[date, date]:
    y, m = int(ym[:4]), int(ym[5:])
    return date(y, m, 1), (date(y + 1, 1, 1) if m == 12 else date(y, m + 1, 1))


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The movement table with the pinned column order (empty if nothing was loaded yet)."""
    if not _list_dirs(spark, root):
        return spark.createDataFrame([], MOVEMENT_SCHEMA)
    return _read_raw(spark, root).select(*MOVEMENT_COLUMNS)


def read_partitioned(spark: SparkSession, root: str, years: list[int] | None = None,
                     companies: list[str] | None = None) -> DataFrame:
    """Read by company (folders are pruned) and retail year (row groups are skipped)."""
    df = read_table(spark, root)
    if years is not None:
        df = df.filter(F.col("retail_year").isin(*years))
    if companies is not None:
        df = df.filter(F.col("company").isin(*companies))
    return df


def between_doc_dates(spark: SparkSession, root: str, lo: date, hi: date) -> DataFrame:
    """D5 on the table: the doc_date range plus the implied retail-year range (both skip row groups)."""
    return read_table(spark, root).filter(F.col("retail_year").between(retail_year_of(lo), retail_year_of(hi))
                                          & F.col("doc_date").between(F.lit(lo), F.lit(hi)))


# --- A6 -----------------------------------------------------------------------------------------

def _write_leaves(df: DataFrame, path: str, mode: str, derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
    # REBALANCE: one hash shuffle on the leaf columns so each leaf lands in few files; AQE
    # splits a skewed leaf (e.g. a month holding a third of the rows) into several tasks and
    # coalesces small ones. Unlike range partitioning it needs no sampling pass over the input.
    df = df.hint("rebalance", *PARTITION_COLUMNS)
    if derive:  # columns that follow from others do not go through the shuffle
        df = derive(df).withColumn("load_month", load_month())
    (df.sortWithinPartitions(*PARTITION_COLUMNS, "retail_year", "doc_date")
       .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
       .option("maxRecordsPerFile", TARGET_ROWS_PER_FILE)
       .partitionBy(*PARTITION_COLUMNS).parquet(path))


def _leaf_files(spark, root: str, companies: list[str], months: list[str]) -> dict[str, frozenset]:
    """File names of each existing leaf of the companies and months (driver-side listing only)."""
    out = {}
    for c in companies:
        for m in set(_list_dirs(spark, f"{root}/company={c}")) & {f"load_month={m}" for m in months}:
            path, fs = _path(spark, f"{root}/company={c}/{m}")
            out[f"company={c}/{m}"] = frozenset(st.getPath().getName() for st in fs.listStatus(path) if st.isFile())
    return out


def _staged(spark: SparkSession, path: str) -> DataFrame | None:
    return _read_raw(spark, path) if _list_dirs(spark, path) else None


def _months_of(spark: SparkSession, root: str, companies: list[str], months: list[str]) -> DataFrame:
    return _read_raw(spark, root).filter(F.col("company").isin(*companies) & F.col("load_month").isin(*months))


def _repeated(rows: DataFrame, times) -> DataFrame:
    """Every row of the table's columns ``times`` times (none if that is not positive)."""
    return rows.where(times > 0).withColumn("_k", F.explode(F.array_repeat(F.lit(0), times.cast("int")))).drop("_k")


def recover(spark: SparkSession, root: str) -> int:
    """Put back the staged rows that a cut-off commit removed; returns how many staging folders it
    settled. Whole rows are counted on both sides (nulls are equal), so rows that share a ``mov_id``
    or repeat come back as often as they were staged, and doing it again adds nothing."""
    folder = f"{root.rstrip('/')}/_staging"
    names = _list_dirs(spark, folder)
    columns = [f.name for f in _table_schema().fields]
    for name in names:
        own = f"{folder}/{name}"
        if _exists(spark, f"{own}/{SWAP}"):
            _swap(spark, root.rstrip("/"), own)
            continue
        kept = _staged(spark, f"{own}/keep") if _exists(spark, f"{own}/{MARKER}") else None
        if kept is not None:
            companies = [d.partition("=")[2] for d in _list_dirs(spark, f"{own}/keep")]
            months = sorted({d.partition("=")[2] for c in companies for d in _list_dirs(spark, f"{own}/keep/company={c}")})
            sides = kept.withColumn("_n", F.lit(1))
            if _list_dirs(spark, root):
                sides = sides.unionByName(_months_of(spark, root, companies, months).withColumn("_n", F.lit(-1)))
            lacking = sides.groupBy(*columns).agg(F.sum("_n").alias("_n"))
            _write_leaves(_repeated(lacking, F.col("_n")).select(*columns), root, "append")
        _delete(spark, own)
    return len(names)


def replace_window(spark: SparkSession, root: str, incoming: DataFrame, company: str | Sequence[str],
                   since: date, until: date, allow_empty: bool = False, stage: bool = False) -> int:
    """Remove exactly ``company``'s rows captured in ``[since, until)`` and add ``incoming``.

    ``company`` may name several companies sharing the window (A3): they load in one job.

    A company without incoming rows keeps all it has, as an empty pull must delete nothing (Q2);
    ``allow_empty`` clears its window instead. Returns rows written.
    Rows of ``incoming`` outside the window or of another company are an error (they would
    land in leaves the window does not own): the write fails before its commit.

    ``incoming`` is computed once. Where the window has boundary months, or ``stage`` says that
    its plan reads the table itself (A10), it is staged, since a plan may not read and overwrite
    the same leaves; otherwise it goes straight into the table.
    """
    if since >= until:
        return 0
    root = root.rstrip("/")
    ensure_table(spark, root)
    recover(spark, root)
    companies = [company] if isinstance(company, str) else list(company)
    months = _months(since, until)
    partial = [m for m in months if _month_bounds(m)[0] < since or _month_bounds(m)[1] > until]
    has_table = bool(_list_dirs(spark, root))
    staging = f"{root}/_staging/{uuid.uuid4().hex}"
    in_window = (F.col("company").isin(*companies) & (F.col("create_date") >= F.lit(since))
                 & (F.col("create_date") < F.lit(until)))
    inc = incoming.select(*MOVEMENT_COLUMNS)
    inc = inc.withColumn("company", F.when(in_window, F.col("company")).otherwise(F.raise_error(
        F.lit(f"incoming row outside {company} [{since}, {until})")).cast("string")))
    inc = inc.withColumn("load_month", load_month())
    n_kept = 0
    if stage or (partial and has_table):
        _write_leaves(inc, f"{staging}/in", "overwrite")
        inc = _staged(spark, f"{staging}/in")
        if not allow_empty:
            companies = [c for c in companies if f"company={c}" in _list_dirs(spark, f"{staging}/in")]
        if not companies:
            _delete(spark, staging)
            return 0
        if partial and has_table:
            _write_leaves(_months_of(spark, root, companies, partial).filter(~in_window), f"{staging}/keep", "overwrite")
            kept = _staged(spark, f"{staging}/keep")
            if kept is not None:
                n_kept = kept.count()
                inc = kept if inc is None else inc.unionByName(kept)
        path, fs = _path(spark, f"{staging}/{MARKER}")
        fs.create(path).close()
    before = _leaf_files(spark, root, companies, months)
    if inc is not None:
        _write_leaves(inc, root, "overwrite")
    # Leaves of the window that the new extract did not produce still hold their old files.
    after = _leaf_files(spark, root, companies, months)
    changed = {leaf.partition("/")[0] for leaf, files in after.items() if before.get(leaf) != files}
    if not allow_empty:
        companies = [c for c in companies if f"company={c}" in changed]
        if not companies:
            return 0
    for leaf, files in after.items():
        if before.get(leaf) == files and (allow_empty or leaf.partition("/")[0] in changed):
            _delete(spark, f"{root}/{leaf}")
    n = _months_of(spark, root, companies, months).count() - n_kept if _list_dirs(spark, root) else 0  # from footers
    _delete(spark, staging)
    return n


def _row_hash() -> Column:
    """64-bit hash of a row; rows that are equal in all columns have the same one (0.0 is -0.0)."""
    doubles = {f.name for f in MOVEMENT_SCHEMA.fields if f.dataType == T.DoubleType()}
    return F.xxhash64("company", *[F.col(c) + 0.0 if c in doubles else F.col(c) for c in SOURCE_COLUMNS])


def merge_windows(spark: SparkSession, root: str, batch: DataFrame, windows: dict[str, tuple[date, date]],
                  delivery: str | None = None, derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Add ``batch`` to the window ``[since, until)`` of each company without doubling what is there.

    ``delivery`` names a column that tells which file (pull) brought a row: a row, equal in all columns
    (nulls are equal), stands as often as in the delivery that holds it most often. Without it equal
    rows stand once. Either way the table is the same however rows fall into batches and however often
    one comes again. ``mov_id`` alone would not do: documents that collide in it (E8) may come in
    different files, and it may be null.

    Only the rows that the table lacks are written, behind those that are there; a merge that was cut
    off is made whole by merging the batch again. One shuffle of row hashes finds the rows that may be
    equal to another one, of the batch or of the table; only these are compared as a whole. Where the
    batch's rows come from ``derive`` (B1), its columns are made again from the source columns behind
    the shuffle into leaves."""
    ensure_table(spark, root)
    recover(spark, root)
    root = root.rstrip("/")
    inside = F.lit(False)
    for company, (since, until) in windows.items():
        inside = inside | ((F.col("company") == company) & (F.col("create_date") >= F.lit(since)) & (F.col("create_date") < F.lit(until)))
    spans = ", ".join(f"{company} [{since}, {until})" for company, (since, until) in windows.items())
    came = batch.select(*MOVEMENT_COLUMNS, (F.col(delivery) if delivery else F.lit("")).cast("string").alias("_from"))
    came = came.withColumn("company", F.when(inside, F.col("company")).otherwise(F.raise_error(
        F.lit(f"incoming row outside {spans}")).cast("string"))).withColumn("_h", _row_hash())
    hashes, there = came.select("_h", F.lit(True).alias("_new")), None
    if _list_dirs(spark, root):
        months = sorted({m for since, until in windows.values() for m in _months(since, until)})
        there = _months_of(spark, root, list(windows), months).filter(inside).withColumn("_h", _row_hash())
        hashes = hashes.unionByName(there.select("_h", F.lit(False).alias("_new")))
    staging = f"{root}/_staging/{uuid.uuid4().hex}"
    (hashes.groupBy("_h").agg(F.count("*").alias("_n"), F.max("_new").alias("_new")).filter("_n > 1 and _new").select("_h")
     .write.parquet(f"{staging}/met"))
    met = spark.read.schema("_h bigint").parquet(f"{staging}/met")
    columns = list(MOVEMENT_COLUMNS) if derive is None else ["company", *SOURCE_COLUMNS]
    rows = came.select(*columns)
    if not met.isEmpty():
        alike = came.join(met, "_h", "left_semi").select(*MOVEMENT_COLUMNS, "_from", F.lit(True).alias("_new"))
        if there is not None:
            alike = alike.unionByName(there.join(met, "_h", "left_semi").select(*MOVEMENT_COLUMNS, F.lit("").alias("_from"), F.lit(False).alias("_new")))
        often = alike.groupBy(*MOVEMENT_COLUMNS, "_new", "_from").agg(F.count("*").alias("_n"))
        often = often.groupBy(*MOVEMENT_COLUMNS).agg(F.max(F.when(F.col("_new"), F.col("_n") if delivery else F.lit(1).cast("bigint"))).alias("_wanted"),
                                                     F.coalesce(F.max(F.when(~F.col("_new"), F.col("_n"))), F.lit(0)).alias("_had"))
        lacking = _repeated(often, F.col("_wanted") - F.col("_had"))
        rows = came.join(met, "_h", "left_anti").select(*columns).unionByName(lacking.select(*columns))
    _write_leaves(rows.withColumn("load_month", load_month()), root, "append", derive)
    _delete(spark, staging)


def merge_window(spark: SparkSession, root: str, batch: DataFrame, company: str, since: date, until: date,
                 delivery: str | None = None) -> int:
    """``merge_windows`` for one company; returns the rows that stand in its window."""
    if since >= until:
        return 0
    merge_windows(spark, root, batch, {company: (since, until)}, delivery)
    if not _list_dirs(spark, root):
        return 0
    return _months_of(spark, root, [company], _months(since, until)).filter(
        (F.col("create_date") >= F.lit(since)) & (F.col("create_date") < F.lit(until))).count()


# --- A7 / A8 ------------------------------------------------------------------------------------

def table_watermark(spark: SparkSession, root: str, company: str):
    """E2 on the table for one company (None when empty), from its newest capture month alone."""
    months = [m.partition("=")[2] for m in _list_dirs(spark, f"{root.rstrip('/')}/company={company}")]
    if not months:
        return None
    return _months_of(spark, root, [company], [max(months)]).agg(F.max("create_date")).first()[0]


def sync(spark: SparkSession, root: str, source: DataFrame, company: str, until: date,
         since: date | None = None) -> int:
    """Resume at the watermark (inclusive: re-pulls the last captured day), else the floor
    date; one window ``[since, until)``. ``until`` is explicit (no clock inside, Q10)."""
    ensure_table(spark, root)
    eff = since or table_watermark(spark, root, company) or FLOOR_DATE
    incoming = finalize(read_movements(source, company, eff, until))
    return replace_window(spark, root, incoming, company, eff, until)


def backfill(spark: SparkSession, root: str, source: DataFrame, company: str | Sequence[str],
             start: date = FLOOR_DATE, end: date | None = None) -> list[tuple[date, date, int]]:
    """Load ``[start, end)`` in retail-year windows, each committed before the next is read, and
    report the rows of each. A run that was cut off is resumed by starting at its first missing window
    (or by running it again: a window that is there is replaced by itself)."""
    if end is None:
        raise ValueError("end is required")
    companies = [company] if isinstance(company, str) else list(company)
    return [(since, until, replace_window(spark, root, finalize(read_movements(source, companies, since, until)), companies, since, until))
            for since, until in retail_year_cuts(start, end)]


# --- A10 ----------------------------------------------------------------------------------------

def compact(spark: SparkSession, root: str, company: str, since: date, until: date, target_bytes: int = 128 << 20) -> dict[str, int]:
    """A10: merge adjacent small files of the months of ``[since, until)``; files of at least half of
    ``target_bytes`` stay as they are. Returns ``files_before``, ``files_after``, ``rewritten``.

    A bin is a run of small files of one leaf, in order of their names, of at most ``target_bytes``
    together (two at least); it becomes one file. Only the files of bins are read. The merged files are
    staged first; then a list of what they replace is written and the swap is made, file by file. A swap
    that was cut off is finished by the next call on the table (``recover``)."""
    recover(spark, root)
    root = root.rstrip("/")
    staging = f"{root}/_staging/{uuid.uuid4().hex}"
    counts = {"files_before": 0, "files_after": 0, "rewritten": 0}
    merged, replaced = [], []
    for leaf in sorted(_leaf_files(spark, root, [company], _months(since, until))):
        path, fs = _path(spark, f"{root}/{leaf}")
        files = sorted((f.getPath().getName(), f.getLen()) for f in fs.listStatus(path) if f.isFile() and f.getPath().getName()[0] not in "_.")
        bins = _bins(files, target_bytes)
        counts["files_before"] += len(files)
        counts["files_after"] += len(files) - sum(len(b) - 1 for b in bins)
        for b in bins:
            merged.append((leaf, [f"{root}/{leaf}/{name}" for name in b]))
            replaced += merged[-1][1]
    counts["rewritten"] = len(replaced)
    if not merged:
        return counts
    # one job for all bins: a bin goes to one task, which writes it into one file
    where = [(leaf.split("=")[-1], f.rpartition("/")[2], k) for k, (leaf, files) in enumerate(merged) for f in files]
    of = spark.createDataFrame(where, "load_month string, _name string, bin int")
    rows = spark.read.schema(_table_schema()).option("basePath", root).parquet(*replaced).withColumn("_name", F.col("_metadata.file_name"))
    (rows.join(F.broadcast(of), ["load_month", "_name"]).drop("_name")  # one row for each file of the listing
     .repartition(len(merged), "bin").sortWithinPartitions("bin", *PARTITION_COLUMNS, "retail_year", "doc_date")
     .write.partitionBy("bin", *PARTITION_COLUMNS).parquet(f"{staging}/merged"))
    path, fs = _path(spark, f"{staging}/{SWAP}")
    out = fs.create(path)
    out.write(bytearray("\n".join(f[len(root) + 1:] for f in replaced), "utf-8"))
    out.close()
    _swap(spark, root, staging)
    return counts


def _bins(files: list[tuple[str, int]], target: int) -> list[list[str]]:
    """Runs of adjacent small files (name, bytes) that together stay within ``target``."""
    out, run, size = [], [], 0
    for name, n in [*files, ("", target)]:
        if run and (2 * n >= target or size + n > target):
            out.append(run)
            run, size = [], 0
        if 2 * n < target:
            run, size = [*run, name], size + n
    return [b for b in out if len(b) > 1]


def _swap(spark: SparkSession, root: str, staging: str) -> None:
    """Take away the listed files, then move the merged ones into their leaves; either can be repeated."""
    jvm = spark.sparkContext._jvm
    path, fs = _path(spark, f"{staging}/{SWAP}")
    stream = fs.open(path)
    listed = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split("\n")
    stream.close()
    for name in listed:
        _delete(spark, f"{root}/{name}")
    for k in _list_dirs(spark, f"{staging}/merged"):
        for company in _list_dirs(spark, f"{staging}/merged/{k}"):
            for month in _list_dirs(spark, f"{staging}/merged/{k}/{company}"):
                source, _ = _path(spark, f"{staging}/merged/{k}/{company}/{month}")
                for f in fs.listStatus(source):
                    if f.getPath().getName()[0] not in "_.":
                        # files of two bins may bear one name
                        fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(f"{root}/{company}/{month}/{k.replace('=', '')}-{f.getPath().getName()}"))
    _delete(spark, staging)


def day_after(d: date) -> date:
    return d + timedelta(days=1)
