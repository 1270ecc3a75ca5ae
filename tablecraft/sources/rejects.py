"""CSV files in, with a table of what could not be read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.sources.files import as_struct
from tablecraft.sources.workspace import stage


def read_csv_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType | str, *, header: bool = True, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The rows that :func:`read_csv` keeps, and why each other row was left out, from one read.

    The files are parsed once, into a table in the shared folder; both results are filters over it. The
    rejects are ``(file, record_no, record, column, value, reason)``: one row for a record with a wrong number of
    fields, or one for each field that its type cannot hold. ``record_no`` tells records apart and has
    no other meaning. ``record`` is the line as it stands in the file where the number of fields is wrong,
    else its fields written as CSV again. So lines = kept rows + distinct ``record_no`` of the rejects.
    """
    fields = as_struct(schema).fields
    texts = T.StructType([*[T.StructField(f.name, T.StringType()) for f in fields], T.StructField("__line", T.StringType())])
    reader = spark.read.options(header=header, columnPruning=False, multiLine=multi_line, escape='"', nullValue="\0")
    lines = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord="__line").schema(texts).csv(path)
    unreadable = [
        F.when(
            F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("value"), F.lit(f"not {f.dataType.simpleString()}").alias("reason")),
        )
        for f in fields
        if not isinstance(f.dataType, T.StringType)
    ]
    shape = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"), F.lit("number of fields").alias("reason"))
    faults = F.when(F.col("__line").isNotNull(), F.array(shape))
    faults = faults.otherwise(F.array_compact(F.array(*unreadable))) if unreadable else faults
    parsed = stage(
        lines.select(
            "*", F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__no"), faults.alias("__faults")
        ),
        "csv-lines",
    )
    kept = parsed.where(F.coalesce(F.size("__faults"), F.lit(0)) == 0)
    names = [F.col(f"`{f.name}`") for f in fields]
    options = {"escape": '"', "nullValue": "", "emptyValue": '""', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rejects = parsed.where(F.size("__faults") > 0).select(
        F.col("__file").alias("file"),
        F.col("__no").alias("record_no"),
        F.coalesce("__line", F.to_csv(F.struct(*names), options)).alias("record"),
        F.inline("__faults"),
    )
    return kept.select(*[c.try_cast(f.dataType).alias(f.name) for c, f in zip(names, fields)]), rejects
