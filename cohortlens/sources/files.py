"""CSV scans and sinks, lineage stamps and the landing-folder manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE = "_line"


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, infer: bool = False, **options: str
) -> DataFrame:
    """CSV with a header row. ``infer`` costs one more pass over the files.

    Columns are found by their names in the header, whatever their order. Columns that
    the schema does not name are left out, missing ones are an error, and so is a
    file of a folder whose header differs from the others'.
    ``columnNameOfCorruptRecord`` adds a column of that name with the line of each
    record that has a value its type cannot hold; that value is NULL.
    """
    reader = spark.read.option("header", True).options(**options)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    if schema is None:
        raise ValueError("give a schema or ask for inference")
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    header = reader.csv(path).columns
    if missing := [name for name in wanted.names if name not in header]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    fields = [wanted[name] if name in wanted.names else T.StructField(name, T.StringType()) for name in header]
    names = list(wanted.names)
    if malformed := options.get("columnNameOfCorruptRecord"):
        fields.append(T.StructField(malformed, T.StringType()))
        names.append(malformed)
    return reader.option("enforceSchema", False).schema(T.StructType(fields)).csv(path).select(*names)


def _misfit(value: Column, kind: T.DataType) -> Column:
    """Whether a CSV value is none of its type. Yes/no is true or false in any case, dates are ISO dates."""
    if isinstance(kind, T.BooleanType):
        return value.isNotNull() & ~F.lower(value).isin("true", "false")
    return value.isNotNull() & value.try_cast(kind).isNull()


def checked_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str, **options: str
) -> tuple[DataFrame, DataFrame]:
    """The records of CSV files, in two parts: those that fit the schema, and all others.

    Columns are found by name, as in ``read_csv``. The first part has the schema's columns. The
    second has a row per rejected record: ``file``, ``record`` (the line if it has the wrong number of
    fields, else its values as JSON), ``columns`` (the names of those that do not fit) and
    ``reason``. Both are map-only over one scan; no record is in both or in neither.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    reader = spark.read.option("header", True).options(**options)
    header = reader.csv(path).columns
    if missing := [name for name in wanted.names if name not in header]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    texts = T.StructType([T.StructField(name, T.StringType()) for name in [*header, LINE]])
    lines = reader.option("enforceSchema", False).option("columnNameOfCorruptRecord", LINE).schema(texts).csv(path)
    names = [F.when(_misfit(F.col(f.name), f.dataType), f.name) for f in wanted if not isinstance(f.dataType, T.StringType)]
    checked = lines.withColumns(
        {"_columns": F.concat_ws(",", *names), "_file": F.input_file_name(), "_values": F.to_json(F.struct(*header))}
    )
    whole = F.col(LINE).isNull()
    fits = whole & (F.col("_columns") == "")
    accepted = checked.where(fits).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])
    rejected = checked.where(~fits).select(
        F.col("_file").alias("file"),
        F.when(whole, F.col("_values")).otherwise(F.col(LINE)).alias("record"),
        F.when(whole, F.col("_columns")).otherwise("").alias("columns"),
        F.when(whole, "value of another type").otherwise("wrong number of fields").alias("reason"),
    )
    return accepted, rejected


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row, padding kept (the writer would strip it by default)."""
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("overwrite").option("header", True).options(**keep).csv(path)


def stamp(df: DataFrame, source_system: str) -> DataFrame:
    """Adds the ingest time and the name of the source system."""
    return df.withColumns({"created_timestamp": F.current_timestamp(), "source_system": F.lit(source_system)})


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder with size and time; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )
