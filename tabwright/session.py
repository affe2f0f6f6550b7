"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}
_SCOPES: list[str] = []
# largest fitted table kept as literal rows
SMALL_ROWS = 20_000
# bytes of a written table that tell of large shuffles behind it
LARGE_BYTES = 16 << 20


def build_session(app: str = "tabwright", cores: int | None = None) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.appName(app)
    if cores:
        builder = builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(cores))
    return (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TABWRIGHT_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset
    (a local test run) is a fresh folder made, once per application.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="tabwright-")
    return _LOCAL[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """New path below one folder per application (and scope), so a finished run can be removed as a whole."""
    inner = "".join(f"/{name}" for name in _SCOPES)
    return f"{shared_dir(spark)}/tabwright-{spark.sparkContext.applicationId}{inner}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove all intermediate tables written inside the block when it ends.

    The caller writes or collects its results before that: a DataFrame made inside cannot be
    read afterwards. Scopes nest; one driver thread opens and closes them.
    """
    _SCOPES.append(f"scope-{uuid.uuid4().hex}")
    folder = os.path.dirname(fresh_path(spark, "any"))
    try:
        yield
    finally:
        _SCOPES.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the result.

    Unlike a cache, the written table survives lost executors, has known size
    statistics (so Spark can decide on broadcasts) and freezes any value that
    could differ between two evaluations of the same plan.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    schema = df.schema
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength() >= LARGE_BYTES:
        release(spark)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Give back disk: ``tables`` written by ``materialize`` that no later plan reads, and shuffle files of finished plans.

    Spark removes the latter only when the driver happens to collect its garbage, so until then the
    shuffles of all steps would add up.
    """
    for table in tables:
        for folder in {os.path.dirname(file) for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark._jvm.System.gc()


def fitted(df: DataFrame, label: str = "fitted") -> DataFrame:
    """Freeze a small fitted table (class quotas, group edges, means).

    Up to SMALL_ROWS rows travel through the driver as fitted state; a larger result is
    written instead. Either way the real size is known when the next plan is made, so Spark
    broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles above it.
    """
    rows = df.limit(SMALL_ROWS + 1).toArrow()
    if rows.num_rows > SMALL_ROWS:
        return materialize(df, label)
    return df.sparkSession.createDataFrame(rows, df.schema)


def bucket_target(spark: SparkSession) -> int:
    """How many ordered buckets to aim for: follows the shuffle width of the session."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(8, min(4096, width))
