"""CSV and Parquet in and out."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    malformed: str = "drop",
    header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Read CSV files.

    ``malformed="drop"`` leaves out every row with the wrong number of fields or with a text that
    its declared type cannot hold. Spark's own ``DROPMALFORMED`` judges a row only by the columns a
    query happens to read, so ``count()`` and ``collect()`` disagree; here the row test is an
    ordinary filter over all typed columns, and every query sees the same rows.

    ``malformed="fail"`` raises on the first bad row. Without a schema the types are inferred, which
    costs one more pass over the files. ``multi_line`` reads texts with line breaks inside quotes; a
    file is then read by one task, so it is off unless asked for. A quote inside a quoted text is
    doubled.
    """
    if malformed not in ("drop", "fail"):
        raise ValueError(f"malformed must be 'drop' or 'fail', not {malformed!r}")
    # A null value that no file holds: a field without anything is null, a quoted empty text is not.
    reader = spark.read.options(header=header, columnPruning=False, multiLine=multi_line, escape='"', nullValue="\0")
    if malformed == "fail":
        reader = reader.option("mode", "FAILFAST")
        return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)

    reader = reader.option("mode", "DROPMALFORMED")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)

    fields = as_struct(schema).fields
    texts = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in fields])).csv(path)
    typed = [f for f in fields if not isinstance(f.dataType, T.StringType)]
    if typed:
        readable = [F.col(f.name).isNull() | F.col(f.name).try_cast(f.dataType).isNotNull() for f in typed]
        texts = texts.where(reduce(lambda a, b: a & b, readable))
    return texts.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in typed}) if typed else texts


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet; filters and column lists of later steps reach this scan."""
    return spark.read.parquet(path)


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files whose global counts, minima and maxima are answered from the footers, without reading a page.

    The result belongs to a session of its own, in which Spark pushes such aggregates down to the files. What it does
    not push (minima of texts, anything grouped or filtered) is scanned as usual. A footer without the minimum
    that is asked for, as of a column that holds NaN or nothing but nulls in some file, is an error.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path)


def from_footers(spark: SparkSession, path: str, report: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A small report over Parquet files, one row per column or fewer, answered from the footers where these
    know the answer, and by a scan of the pages where they do not. The rows are the same either way."""
    try:
        made = report(read_statistics(spark, path))
        rows = made.collect()
    except Exception as failed:  # Spark has no class of its own for it; the text names the setting
        if "aggregatePushdown" not in str(failed):
            raise
        made = report(read_parquet(spark, path))
        rows = made.collect()
    return spark.createDataFrame(rows, made.schema)


def write_csv(df: DataFrame, path: str, *, line_breaks: str = "fail") -> None:
    """Write CSV files with a header; spaces at the ends of a text are kept.

    A text with a line break would come back as two malformed rows from a read that splits files, so
    it is refused; ``line_breaks="keep"`` writes it, to be read with ``multi_line``.
    """
    if line_breaks not in ("fail", "keep"):
        raise ValueError(f"line_breaks must be 'fail' or 'keep', not {line_breaks!r}")
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if line_breaks == "fail":
        refused = F.raise_error(F.lit("a text holds a line break; write it with line_breaks='keep'"))
        df = df.withColumns({c: F.when(F.col(c).rlike("[\r\n]"), refused).otherwise(F.col(c)) for c in texts}) if texts else df
    df.write.mode("errorifexists").options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"'
    ).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
