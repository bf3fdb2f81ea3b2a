"""The documents schema, and tables seen as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METADATA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("server", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("application", T.StringType()),
    T.StructField("seq", T.LongType()),
])

# For collections whose metadata keys are not known beforehand.
OPEN_METADATA = T.MapType(T.StringType(), T.StringType())


def documents_schema(metadata: T.DataType = METADATA) -> T.StructType:
    return T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("filename", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("metadata", metadata),
    ])


DOCUMENTS = documents_schema()


def read_json_documents(spark: SparkSession, path: str, metadata: T.DataType = METADATA) -> DataFrame:
    """JSON documents, one per line, with whichever metadata keys they have."""
    return spark.read.schema(documents_schema(metadata)).json(path)


def with_lower(docs: DataFrame) -> DataFrame:
    """Adds the lower-cased copy of the content that is stored at load time."""
    return docs.withColumn("content_lc", F.lower("content"))


def prose(documents: DataFrame) -> DataFrame:
    """The ``documents`` table as documents; language is the type, source the server."""
    return documents.select(
        "doc_id",
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"),
        F.col("text").alias("content"),
        F.struct(F.col("lang").alias("type"), F.col("source").alias("server")).alias("metadata"))
