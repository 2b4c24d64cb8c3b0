"""Files of a folder as uploads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

FILE_COLUMNS = ("path", "modificationTime", "length", "content")


def read_uploads(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files with path, length and bytes. Spark leaves out files of length zero."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(*FILE_COLUMNS)


def stream_uploads(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    schema = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    reader = (
        spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(*FILE_COLUMNS)


def list_files(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Objects that were exported as files: key below ``path``, and size; no bytes read."""
    root = path.rstrip("/") + "/"
    key = F.substring_index(F.col("path"), root, -1)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(key.alias("object_key"), F.col("length").alias("size"))
        .where(F.col("object_key").startswith(prefix))
    )
