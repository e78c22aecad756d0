"""Session construction and the few session-level settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every stockflow job wants. Timestamps in the data are zone-less, but UTC keeps any
# TIMESTAMP (LTZ) conversion, e.g. for streaming watermarks, deterministic.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "stockflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with stockflow's defaults.

    On a cluster ``master`` stays None and the launcher decides; tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(SESSION_CONF)
    conf.update({"spark.ui.enabled": "false", "spark.sql.execution.arrow.pyspark.enabled": "true",
                 "spark.ui.showConsoleProgress": "false"})
    if master:
        builder = builder.master(master)
        if master.startswith("local"):  # one process: sizes that fit a workstation
            conf["spark.driver.memory"] = os.environ.get("STOCKFLOW_DRIVER_MEMORY", "8g")
            shuffle_partitions = shuffle_partitions or int(os.environ.get("BENCH_CPUS", "8"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to a session created elsewhere (e.g. by a driver)."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir`` (or set on the context before).

    Only a local master, where driver and tasks share one disk, may go without: it gets a
    temporary folder. On a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if found:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(found)
        return found
    if current := sc.getCheckpointDir():
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stockflow-ckpt-"))
    return sc.getCheckpointDir()


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Session settings for the plans made and run inside; the former ones come back behind it."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_written: list[list[tuple[str, object]]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Remove the tables that ``materialize`` writes inside, but for those given to the function that
    this yields, which hands them on to the scratch around it (if any)."""
    own: list[tuple[str, object]] = []
    kept: list[object] = []

    def keep(df):
        kept.append(df)
        return df

    _written.append(own)
    try:
        yield keep
    finally:
        _written.pop()
        for path, df in own:
            if any(df is k for k in kept):
                if _written:
                    _written[-1].append((path, df))
            else:
                target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df, name: str = "table"):
    """Write ``df`` as Parquet below the shared checkpoint folder and return the written table.

    This cuts lineage like a checkpoint, survives the loss of executors, and is compressed and
    column-pruned when read again.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)  # texts and hashes are most of it
    table = spark.read.schema(df.schema).parquet(path)
    if _written:
        _written[-1].append((path, table))
    return table
