"""A token table that takes appended, changed and deleted documents without being rebuilt.

Documents come in batches. Each batch becomes a segment, a token table of its own that is never changed. Deleting writes
the keys down with a number that counts up: a row of an older segment whose key was deleted later is dead, and is left
out when the index is read. Changing is deleting and appending in one step. When several segments of about one size have
come together they are merged into a larger one, without their dead rows; so a row is rewritten once for each size, and
there are never more than a few segments of each.

What belongs to the index at a time is a small list, published as a version: readers keep theirs, whatever is appended.
The statistics for relevance are kept for each segment and added up; they count live documents only.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.operators.textindex import DOCUMENT, TokenIndex, token_table, write_rows
from logsieve.sources.versions import Versions, remove

# Segments of one size that are merged, and the rows up to which all sizes count as the smallest.
FANOUT, SMALLEST = 4, 1_000_000

_SEGMENTS = "seq long, folder string, rows long, docs long, words long"
_DELETED = "seq long, folder string"


@dataclass(frozen=True)
class Segment:
    """``rows`` as written; ``docs`` and ``words`` of the documents that are still live."""

    seq: int
    folder: str
    rows: int
    docs: int
    words: int


@dataclass(frozen=True)
class Deleted:
    seq: int
    folder: str


class SegmentedIndex:
    """The index at a path; an object stays with the version that it opened or made."""

    def __init__(self, spark: SparkSession, path: str, content: str = "content", key: str = "doc_id",
                 fanout: int = FANOUT, smallest: int = SMALLEST):
        self.spark, self.path, self.content, self.key = spark, path.rstrip("/"), content, key
        self.fanout, self.smallest = fanout, smallest
        self.versions = Versions(spark, f"{self.path}/lists")
        now = self.versions.current()
        self.state = now.state if now else ""
        self._written: list[str] = []
        self.segments, self.deleted = self._list(now.folder) if now else ([], [])

    def _list(self, folder: str) -> tuple[list[Segment], list[Deleted]]:
        """A few rows: some segments of each size."""
        segments = self.spark.read.schema(_SEGMENTS).parquet(f"{folder}/segments").orderBy("seq").collect()
        deleted = self.spark.read.schema(_DELETED).parquet(f"{folder}/deleted").orderBy("seq").collect()
        return [Segment(**r.asDict()) for r in segments], [Deleted(**r.asDict()) for r in deleted]

    def _publish(self, state: str) -> None:
        def write(folder: str) -> None:
            for name, layout, rows in (("segments", _SEGMENTS, self.segments), ("deleted", _DELETED, self.deleted)):
                self.spark.createDataFrame([tuple(asdict(r).values()) for r in rows], layout).coalesce(1).write.parquet(f"{folder}/{name}")

        before = self.versions.all()
        lists = {v.folder: {r.folder for kind in self._list(v.folder) for r in kind} for v in before}
        self.versions.publish(write, state)
        self.state = state
        kept = {v.folder for v in self.versions.all()}
        used = {r.folder for r in (*self.segments, *self.deleted)}.union(*(lists[f] for f in lists if f in kept))
        for folder in set(self._written).union(*lists.values()) - used:
            remove(self.spark, folder)
        self._written = []

    @property
    def _next(self) -> int:
        return max((r.seq for r in (*self.segments, *self.deleted)), default=0) + 1

    # ---- changes

    def append(self, docs: DataFrame, state: str = "") -> "SegmentedIndex":
        """A new segment with these documents."""
        self._add(docs)
        self._merge()
        self._publish(state)
        return self

    def delete(self, keys: DataFrame, state: str = "") -> "SegmentedIndex":
        """The documents with these keys are gone; only their keys are written."""
        self._drop(keys)
        self._publish(state)
        return self

    def update(self, docs: DataFrame, state: str = "") -> "SegmentedIndex":
        """The documents replace all that have their keys, or are added."""
        self._drop(docs.select(self.key))
        self._add(docs)
        self._merge()
        self._publish(state)
        return self

    def _add(self, docs: DataFrame) -> None:
        self._write(token_table(docs, self.content, self.key, mark_documents=True), self._next)

    def _write(self, rows: DataFrame, seq: int) -> None:
        folder = f"{self.path}/segments/{uuid.uuid4().hex}"
        self._written.append(folder)
        write_rows(rows, folder, self.key)
        totals = self.spark.read.parquet(f"{folder}/corpus").first()
        n = self.spark.read.parquet(f"{folder}/postings").count()
        self.segments = sorted([*self.segments, Segment(seq, folder, n, totals["n"], totals["words"])], key=lambda s: s.seq)

    def _drop(self, keys: DataFrame) -> None:
        seq, folder = self._next, f"{self.path}/deleted/{uuid.uuid4().hex}"
        self._written.append(folder)
        keys.select(self.key).filter(F.col(self.key).isNotNull()).distinct().write.parquet(folder)
        if not self.segments:
            return
        # One row for each segment: what was live and is not any more.
        gone = self.documents().join(self.spark.read.parquet(folder), self.key, "left_semi").groupBy("seq").agg(
            F.count(F.lit(1)).alias("docs"), F.sum("dl").alias("words")).collect()
        lost = {r.seq: r for r in gone}
        self.segments = [replace(s, docs=s.docs - lost[s.seq].docs, words=s.words - lost[s.seq].words) if s.seq in lost else s
                         for s in self.segments]
        self.deleted = [*self.deleted, Deleted(seq, folder)]

    def _size(self, segment: Segment) -> int:
        return int(math.log(max(segment.rows, self.smallest) / self.smallest, self.fanout) + 1e-9)

    def _merge(self) -> None:
        """Merge as long as there are enough segments of one size, then forget deletions that no segment needs."""
        while True:
            sizes: dict[int, list[Segment]] = {}
            for segment in self.segments:
                sizes.setdefault(self._size(segment), []).append(segment)
            full = [group for _, group in sorted(sizes.items()) if len(group) >= self.fanout]
            if not full:
                break
            group = full[0]
            rows = self._live("postings", group).drop("seq").unionByName(
                self._live("documents", group).select(F.lit(DOCUMENT).alias("token"), self.key, F.lit(0).alias("tf"), "dl"))
            # What was deleted before the newest of them is left out already, and what comes later still counts.
            newest = max(s.seq for s in group)
            self.segments = [s for s in self.segments if s not in group]
            self._write(rows, newest)
        oldest = min((s.seq for s in self.segments), default=0)
        self.deleted = [d for d in self.deleted if d.seq > oldest]

    # ---- reading

    def _live(self, part: str, segments: list[Segment]) -> DataFrame:
        """Rows of a part with the segment's number, without those whose key was deleted later."""
        rows = None
        for segment in segments:
            own = self.spark.read.parquet(f"{segment.folder}/{part}").withColumn("seq", F.lit(segment.seq).cast("long"))
            rows = own if rows is None else rows.unionByName(own)
        later = [d for d in self.deleted if d.seq > min(s.seq for s in segments)]
        if not later:
            return rows
        dead = None
        for deleted in later:
            own = self.spark.read.parquet(deleted.folder).select(F.col(self.key).alias("_dead"), F.lit(deleted.seq).cast("long").alias("_since"))
            dead = own if dead is None else dead.unionByName(own)
        dead = dead.groupBy("_dead").agg(F.max("_since").alias("_since"))
        return rows.join(dead, (F.col(self.key) == F.col("_dead")) & (F.col("seq") < F.col("_since")), "left_anti")

    def documents(self) -> DataFrame:
        """``key, dl, seq`` of every live document."""
        return self._live("documents", self.segments)

    def index(self) -> TokenIndex:
        """All live rows as one token index: look-ups, relevance and joins work as on a rebuilt one."""
        if not self.segments:
            raise ValueError("nothing was appended yet")
        totals = [(sum(s.docs for s in self.segments), sum(s.words for s in self.segments))]
        corpus = self.spark.createDataFrame(totals, "n long, words long")
        return TokenIndex(self._live("postings", self.segments).drop("seq"), corpus, self.key, current=True)

    def report(self) -> DataFrame:
        """``segments, deleted, docs, words, rows``: what the index consists of."""
        line = (len(self.segments), len(self.deleted), sum(s.docs for s in self.segments),
                sum(s.words for s in self.segments), sum(s.rows for s in self.segments))
        return self.spark.createDataFrame([line], "segments int, deleted int, docs long, words long, rows long")
