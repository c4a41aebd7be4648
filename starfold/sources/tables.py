"""Reading and writing tables: by extension, with metadata beside them, partitioned, in parts."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Column names that position lists use.
ALIASES = {"ra": ("ra", "RA", "_RAJ2000", "raj2000"), "dec": ("dec", "Dec", "DEC", "_DEJ2000", "dej2000"), "id": ("id", "_id", "obj_id", "ztf_id", "objectId")}
METADATA = "_metadata"


def load_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet or CSV (with a header) by the path's extension; anything else is an error."""
    if path.rstrip("/").endswith(".csv"):
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    if path.rstrip("/").endswith(".parquet"):
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    raise ValueError(f"neither .parquet nor .csv: {path}")


def save_table(df: DataFrame, path: str, metadata: dict | None = None, by: list[str] | None = None, rows_per_file: int = 0) -> None:
    """Writes by extension; ``by`` are partition columns, ``metadata`` goes as JSON into a folder beside the table."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer = writer.partitionBy(*by) if by else writer
    if path.rstrip("/").endswith(".csv"):
        writer.option("header", True).csv(path)
    elif path.rstrip("/").endswith(".parquet"):
        writer.parquet(path)
    else:
        raise ValueError(f"neither .parquet nor .csv: {path}")
    if metadata is not None:
        write_metadata(df.sparkSession, path, metadata)


def write_metadata(spark: SparkSession, path: str, metadata: dict) -> None:
    spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path.rstrip("/") + METADATA)


def merged(old: dict, new: dict) -> dict:
    """``old`` with the entries of ``new``: of objects under the same key the entries are merged, anything else is replaced."""
    out = dict(old)
    for key, value in new.items():
        known = out.get(key)
        out[key] = merged(known, value) if isinstance(known, dict) and isinstance(value, dict) else value
    return out


def update_metadata(spark: SparkSession, path: str, metadata: dict) -> dict:
    """Merges entries into the metadata beside a table, as runs over several fields add theirs to one record; gives the whole record.

    It is read, merged and written on the driver, so only one run may update a table's metadata at a time.
    """
    whole = merged(read_metadata(spark, path), metadata)
    write_metadata(spark, path, whole)
    return whole


def read_metadata(spark: SparkSession, path: str) -> dict:
    """The metadata beside a table; none where there are none."""
    try:
        rows = spark.read.text(path.rstrip("/") + METADATA).head(1)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return json.loads(rows[0][0]) if rows else {}


def with_known_names(df: DataFrame) -> DataFrame:
    """Renames the first known synonym of id, ra and dec."""
    found = {next((c for c in names if c in df.columns), None): own for own, names in ALIASES.items()}
    return df.withColumnsRenamed({c: own for c, own in found.items() if c and c != own})


def object_ids(spark: SparkSession, path: str) -> DataFrame:
    """(objectId LONG, ra, dec): ids never pass through a double; positions are NULL where the list has none."""
    raw = spark.read.option("header", True).csv(path)
    column = lambda c: F.col(c).cast("double") if c in raw.columns else F.lit(None).cast("double")
    return raw.select(F.col("objectId").cast("long").alias("objectId"), column("ra").alias("ra"), column("dec").alias("dec"))


def job_seconds(spark: SparkSession, path: str) -> DataFrame:
    """(file, seconds, sources, seconds_per_source) from job logs with lines ``runtime_seconds: x`` and ``n_sources_start: n``."""
    lines = spark.read.text(path).withColumn("file", F.input_file_name())
    number = lambda name: F.max(F.expr("try_cast(nullif(regexp_extract(value, '" + name + r"[^0-9]*([0-9.]+)', 1), '') as double)"))
    found = lines.groupBy("file").agg(number("runtime_seconds").alias("seconds"), number("n_sources_start").alias("sources"))
    return found.withColumn("seconds_per_source", F.try_divide("seconds", "sources"))
