"""What the operators of this package share: the word rule and tables written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of a text: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII upper case and its lower case, for translate().
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; in local mode a temporary one where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="llm-"))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder: lineage ends here, and lost executors cost nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def same(left: Column, right: Column) -> Column:
    """Equality that also holds between two nulls."""
    return left.eqNullSafe(right)


def identity(*columns: Column | str) -> Column:
    """128 bits of a hash over the columns, as binary."""
    halves = (F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns))
    return F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
