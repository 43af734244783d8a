"""File, text and inline sources. Schemas are declared, never inferred on the read path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

CORRUPT = "_corrupt"


def _reader(spark: SparkSession, stream: bool, files_per_trigger: int | None = None):
    r = spark.readStream if stream else spark.read
    return r.option("maxFilesPerTrigger", files_per_trigger) if stream and files_per_trigger else r


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = False, sep: str = ",",
             trim: bool = True, stream: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    return (_reader(spark, stream, files_per_trigger).schema(schema).option("header", header).option("sep", sep)
            .option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim).csv(path))


def read_json(spark: SparkSession, path: str, schema: T.StructType, keep_bad: bool = True, stream: bool = False,
              files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines. Missing fields give NULL; a bad line keeps its text in ``_corrupt`` or is dropped."""
    s = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if keep_bad else schema
    return (_reader(spark, stream, files_per_trigger).schema(s).option("mode", "PERMISSIVE" if keep_bad else "DROPMALFORMED")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def read_text(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return _reader(spark, stream).text(path)


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None) -> DataFrame:
    """Bounded read of what a stream's storage holds now."""
    r = spark.read.format(fmt)
    return (r.schema(schema) if schema is not None else r).load(path)


def read_table_stream(spark: SparkSession, folder: str, table: str, schema: T.StructType,
                      files_per_trigger: int | None = None) -> DataFrame:
    """Stream over the parquet file(s) of one table in a folder of tables."""
    return (_reader(spark, True, files_per_trigger).schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(folder))


def with_metadata(df: DataFrame) -> DataFrame:
    """File position of each row: path, name, size, modification time."""
    return df.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_modification_time").alias("file_modified_at"))


def values(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def empty_like(df: DataFrame, add: dict[str, str] | None = None) -> DataFrame:
    """Empty frame with the schema of another one, plus new columns."""
    extra = [T.StructField(n, T._parse_datatype_string(t)) for n, t in (add or {}).items()]
    return df.sparkSession.createDataFrame([], T.StructType([*df.schema.fields, *extra]))


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Column comments carried in the schema."""
    return df.select(
        *[F.col(c).alias(c, metadata={**df.schema[c].metadata, "comment": comments[c]}) if c in comments else F.col(c) for c in df.columns])
