"""The shared folder for tables that one step writes and a later step reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tablecraft"


def working_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder the session names in ``spark.checkpoint.dir``, else below its
    warehouse. Both are settings of the session that all executors share; no folder of one machine is
    ever picked here. What is written there is deleted when the session's process ends, because
    results are lazy and may be read until then.
    """
    path = f"{_base(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)  # only a folder that exists can be marked for deletion
    files.deleteOnExit(folder)
    return f"{path}/data"


def _write(df: DataFrame, path: str, **options) -> None:
    """Write the files of a staged table. What its plan has shuffled is deleted when they are written; else it would
    lie on the disks until a garbage collection of the driver finds it, hours later or never."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("errorifexists").options(compression="zstd", **options).parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame, name: str, *, rebalance_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and go on from the written table.

    This cuts the lineage: a lost executor costs a re-read of some files, not a re-run of the plan
    behind them. Column metadata (attribute names of vectors) is kept. ``rebalance_by`` names a
    unique column by which the rows are first spread evenly over files of the advisory partition
    size; that is one more shuffle, and pays for a table that an iterative fit reads many times.
    """
    spark = df.sparkSession
    path = working_path(spark, name)
    _write(df.hint("rebalance", F.col(rebalance_by)) if rebalance_by else df, path)
    return spark.read.schema(df.schema).parquet(path)


def stage_in_parts(df: DataFrame, name: str, rows: int) -> DataFrame:
    """Write ``df`` as files of at most ``rows`` rows each and go on from them, one partition for each file or piece
    of a large one. Rows are cut where they lie, without a shuffle.

    Files are otherwise read together up to a number of bytes. The size that keeps them apart is a setting of the session,
    so the result belongs to a session of its own; it is meant for what is read as it is, like the rows of a fit.
    """
    path = working_path(df.sparkSession, name)
    _write(df, path, maxRecordsPerFile=rows)
    own = df.sparkSession.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    return own.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more, instead of at the end of the process. What
    lies outside the working folder of the session is not touched."""
    spark = df.sparkSession
    base = spark._jvm.org.apache.hadoop.fs.Path(_base(spark)).toUri().getPath()
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(f"{base}/"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_bucketed(df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
    """Write ``df`` as a table of ``buckets`` buckets by a hash of the column ``by``, each one file sorted by
    it, and go on from that table.

    Groups, windows and joins on ``by`` then need no exchange and no sort: one shuffle here is shared by
    all that is asked per key later. All rows of one key lie in one bucket, so this is a layout for keys
    none of which holds a large part of the rows; the number of buckets is to follow the size of the
    table, some hundred megabytes each. The table is known to the session under a name of its own.
    """
    spark = df.sparkSession
    table = f"tablecraft_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, by)
    dealt.write.bucketBy(buckets, by).sortBy(by).option("path", working_path(spark, name)).format("parquet").saveAsTable(table)
    return spark.table(table)
