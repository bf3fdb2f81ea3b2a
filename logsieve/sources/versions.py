"""Tables that are rebuilt while others read them: each version in a folder of its own, published by a pointer written last.

A folder becomes a version only once its pointer, a table of one row, is complete; a writer that dies leaves a folder
that nobody reads. Readers hold the folder of the version that they opened, which never changes. Versions are found
again by any later application. Two writers at once publish two versions, both whole; the later pointer wins.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_POINTER = "number long, folder string, state string, published timestamp"


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    state: str


class Versions:
    """The published versions of what is stored at a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def all(self) -> list[Version]:
        """Newest first; one pointer for each version that was not removed."""
        try:
            rows = self.spark.read.schema(_POINTER).parquet(f"{self.path}/published/*").collect()
        except AnalysisException:  # nothing was published yet
            return []
        found = sorted(rows, key=lambda r: (r["number"], r["published"], r["folder"]), reverse=True)
        return [Version(r["number"], r["folder"], r["state"]) for r in found]

    def current(self) -> Version | None:
        found = self.all()
        return found[0] if found else None

    def publish(self, write: Callable[[str], None], state: str = "", keep: int = 2) -> Version:
        """Write into a new folder, point to it, and remove all but the newest ``keep`` versions.

        A reader may go on with its version until ``keep`` newer ones are published.
        """
        found = self.all()
        number, name = (found[0].number + 1 if found else 1), uuid.uuid4().hex
        folder = f"{self.path}/versions/{number:09d}-{name}"
        write(folder)
        row = self.spark.createDataFrame([(number, folder, state)], "number long, folder string, state string")
        row.withColumn("published", F.current_timestamp()).coalesce(1).write.parquet(f"{self.path}/published/{number:09d}-{name}")
        self.expire(keep)
        return Version(number, folder, state)

    def expire(self, keep: int = 2) -> list[Version]:
        """Remove all but the newest versions, each pointer before its folder."""
        gone = self.all()[max(1, keep):]
        for version in gone:
            name = version.folder.rsplit("/", 1)[1]
            remove(self.spark, f"{self.path}/published/{name}")
            remove(self.spark, version.folder)
        return gone

    def ensure(self, state: str, write: Callable[[str], None], fits: Callable[[str], bool] = lambda folder: True) -> str:
        """The folder of the current version if it was made from this state and still fits, else of a new one."""
        now = self.current()
        if now is not None and now.state == state and fits(now.folder):
            return now.folder
        return self.publish(write, state).folder


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
