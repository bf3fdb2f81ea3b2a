"""Parquet tables: read, append, rebuild, and load only when needed."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.sources.versions import Versions

# Bytes read for each file of a small table, the size from which files are left as they come, and of a row group; size and
# rows of a page of a table that is read by key.
FILE_BYTES, LARGE_FILE_BYTES, ROW_GROUP_BYTES = 1 << 20, 64 << 20, 16 << 20
PAGE_BYTES, PAGE_ROWS = 32 << 10, 2000

_OWN: dict[str, str] = {}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Full scan of one table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: the cluster's checkpoint folder.

    Only where none is named and everything runs on one machine, as in a test session, is a
    temporary folder taken; it goes when the program ends. No setting is changed.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _OWN:
        _OWN["folder"] = tempfile.mkdtemp(prefix="logsieve-")
        atexit.register(shutil.rmtree, _OWN["folder"], ignore_errors=True)
    return _OWN["folder"]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for this application's own tables in the shared folder."""
    return f"{shared_dir(spark)}/logsieve-{spark.sparkContext.applicationId}/{name}"


def library_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that later applications find again; use it for versioned tables."""
    return f"{shared_dir(spark)}/logsieve/{name}"


def append(rows: DataFrame, path: str) -> None:
    """Add a batch of rows; every task writes its own file."""
    rows.write.mode("append").parquet(path)


def rebuild(rows: DataFrame, path: str) -> None:
    """Drop what is there and write anew."""
    rows.write.mode("overwrite").parquet(path)


def has_column(table: DataFrame, name: str) -> bool:
    """Whether a column exists and at least one row has a value in it."""
    return name in table.columns and not table.filter(F.col(name).isNotNull()).select(name).limit(1).isEmpty()


def fields_present(table: DataFrame) -> DataFrame:
    """``field, present`` for every column: whether any row has a value in it, from one scan."""
    found = table.agg(*[F.coalesce(F.bool_or(F.col(c).isNotNull()), F.lit(False)).alias(c) for c in table.columns])
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).alias("present")) for c in table.columns])))


def row_count(table: DataFrame) -> int:
    """Exact count; for plain parquet it is read from the file footers."""
    return table.count()


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def source_files(rows: DataFrame) -> tuple[str, int]:
    """What the frame is read from: a digest of its files with their sizes and times, and their bytes.

    The files are listed by Spark, on whatever store they are; no content is read.
    """
    files = rows.inputFiles()
    if not files:
        return "none", 0
    listed = rows.sparkSession.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
    state = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                       F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("sum")).first()
    return f"{state['n']} files, {state['sum']}", state["bytes"]


def source_state(rows: DataFrame) -> str:
    return source_files(rows)[0]


def spread(rows: DataFrame, bytes_read: int, sorted_by: str | None = None) -> DataFrame:
    """A small table in as many files as tasks can run, so that scans of it use them all; large ones stay as they are.

    Sorted tables of any size are put into ranges of the key, one file each.
    """
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    files = max(min(tasks, 1 + bytes_read // FILE_BYTES), bytes_read // LARGE_FILE_BYTES)
    if sorted_by:
        return rows.repartitionByRange(files, sorted_by).sortWithinPartitions(sorted_by)
    return rows.repartition(files) if bytes_read < tasks * LARGE_FILE_BYTES else rows


def ensure_table(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                 expected_rows: int | None = None, required_columns: Iterable[str] = (),
                 reset: bool = False, sorted_by: str | None = None) -> DataFrame:
    """The newest version of the stored table when it still fits, else a new version; this and later applications use it.

    It fits when it was made from the same files in the same state, its columns and rows are those
    that were written, it has the expected number of rows, if one is given, and values in all
    required columns. ``reset`` always rebuilds. Queries that read an older version go on. A table
    that is ``sorted_by`` a key is written in small pages, so that few rows can be read by key.
    """
    rows, versions = build(), Versions(spark, path)
    state, size = source_files(rows)
    state = f"{state}, sorted by {sorted_by}"

    def write(folder: str) -> None:
        writer = spread(rows, size, sorted_by).write.option("parquet.block.size", ROW_GROUP_BYTES)
        if sorted_by:
            writer = writer.option("parquet.page.size", PAGE_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS)
        writer.parquet(f"{folder}/rows")
        written = spark.read.parquet(f"{folder}/rows")
        line = [(written.schema.json(), written.count())]
        spark.createDataFrame(line, "layout string, n long").coalesce(1).write.parquet(f"{folder}/layout")

    def fits(folder: str) -> bool:
        table, line = stored(spark, f"{folder}/rows"), stored(spark, f"{folder}/layout")
        found = line.first() if table is not None and line is not None else None
        if found is None or (found["layout"], found["n"]) != (table.schema.json(), row_count(table)):
            return False
        return (expected_rows is None or found["n"] == expected_rows) and all(has_column(table, c) for c in required_columns)

    folder = versions.publish(write, state).folder if reset else versions.ensure(state, write, fits)
    return spark.read.parquet(f"{folder}/rows")
