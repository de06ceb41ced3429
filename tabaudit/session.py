"""Session helpers: local session for tests, lineage cuts, and tables in the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark. Clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabaudit")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local") and not context.master.startswith("local-cluster"):
        own = tempfile.mkdtemp(prefix="tabaudit-ckpt-")  # one machine: the folder is shared by all there is
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession) -> str:
    """A path in the shared checkpoint folder that nobody uses yet."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"


#: Bytes of an Arrow batch in :func:`small_batches`. A batch is held by the JVM and by the worker, and grown by doubling.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of at most ``BATCH_BYTES``, or of one row; a smaller setting of the session stays.

    Spark's own limit is sixteen times as much, which texts of some kilobytes fill. The setting holds for plans made from here on.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = int(spark.conf.get(name).removesuffix("b"))
    if not 0 < own <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end. Only what was written for good inside, or depends on none of them, can be used later."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES[:] = [open_scope for open_scope in _SCOPES if open_scope is not paths]
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, packed: bool = True) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``; the table is compressed, is read by column, and the optimiser knows its size: that of its files.
    Tables that others may be joined with by broadcast are written with ``packed=False``, neither compressed nor by dictionary; lists of few
    different names else take a hundred times as much memory as their files.
    """
    path = fresh_path(df.sparkSession)
    if packed:
        df.write.parquet(path)
    else:
        df.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
    for open_scope in _SCOPES:
        open_scope.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
