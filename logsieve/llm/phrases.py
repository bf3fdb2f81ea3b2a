"""Lempel-Ziv phrase fingerprints: the phrases that a text is parsed into, hashed, and the smallest hashes kept.

A text is parsed from left to right into the shortest phrases that it has not had yet (a dictionary of phrases, each a
known phrase and one more character, as in LZ78). The fingerprint holds the smallest hashes of the phrase set, in hex.
The likeness of two fingerprints is the share of the smallest hashes of both that are in both: an estimate of the
Jaccard similarity of the phrase sets, and so of how well one text compresses the other.

Scale: a fingerprint needs its own text only. `edited_likeness` also needs the next document in order of keys: texts
move once, into runs of neighbours; the first document of a run is sent to the run before it as well. A run is a range
of keys, and for a key that fills several runs, or none, a range of a hash of the text. A task reads a run as a stream
and holds two documents at a time. Only the places at which runs begin come to the driver, at most about MOST_RUNS,
whatever the size of the input.

Edge cases: null and empty texts have no phrases and an empty fingerprint; two empty fingerprints are alike (1), an
empty and another not at all (0); equal keys follow each other by a hash of the text, null keys come after all others; the only
document of a table is its own next; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT = 128
RUN_CHARS, MOST_RUNS = 2_000_000, 50_000
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    while len(_powers[0]) <= n:
        have = len(_powers[0])
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _powers[i] = np.concatenate([_powers[i], _powers[i] * np.uint64(pow(base, have, 1 << 64))])
    return _powers[0][: n + 1], _powers[1][: n + 1]


class Parse:
    """The phrases of a text so far: the set, where each ends, and where the next begins."""

    def __init__(self, seen: set[str] | None = None, ends: list[int] | None = None, start: int = 0):
        self.seen, self.ends, self.start = seen or set(), ends or [], start

    def copy(self) -> Parse:
        return Parse(set(self.seen), list(self.ends), self.start)

    def run(self, text: str, cut: int | None = None) -> Parse | None:
        """Parses to the end; gives the state before the first phrase that reaches beyond `cut`.

        The dictionary holds every beginning of its phrases, so the length of the next one may be sought from the
        length of the last in either direction.
        """
        seen, ends, start, n, before, size = self.seen, self.ends, self.start, len(text), None, 4
        while start < n:
            end = start + size
            if end > n:
                end = n
            if text[start:end] in seen:
                end += 1
                while end <= n and text[start:end] in seen:
                    end += 1
            else:
                while end > start + 1 and text[start : end - 1] not in seen:
                    end -= 1
            if cut is not None and end > cut and before is None:
                before = Parse(set(seen), list(ends), start)
            if end > n:
                break
            seen.add(text[start:end])
            ends.append(end)
            size, start = end - start, end
        self.start = start
        return before if cut is None or before is not None else self.copy()


def signature(text: str, ends: list[int]) -> np.ndarray:
    """The smallest 32-bit hashes of the phrases, ascending."""
    if not ends:
        return np.zeros(0, np.uint32)
    codes = np.frombuffer(text[: ends[-1]].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    up, down = _powers_to(len(codes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(1)) * up[: len(codes)], dtype=np.uint64)])
    stop = np.array(ends)
    first = np.concatenate([np.zeros(1, stop.dtype), stop[:-1]])
    mixed = (sums[stop] - sums[first]) * down[first] + (stop - first).astype(np.uint64)
    for fold, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(fold))) * np.uint64(odd)
    return np.unique((mixed >> np.uint64(32)).astype(np.uint32))[:KEPT]


def shown(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def fingerprint(text: str | None) -> str:
    parse = Parse()
    parse.run(text or "")
    return shown(signature(text or "", parse.ends))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Of the smallest hashes of both sets, the share that both have."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    first = np.concatenate([np.ones(1, bool), ~twice])
    size = min(KEPT, int(first.sum()))
    last = both[first][size - 1]
    return float(np.count_nonzero(both[1:][twice] <= last) / size)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every document."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t.as_py()) for t in batch.column("_text")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("_key"), prints], names=["doc_id", "fingerprint"])

    return docs.select(docs[key].alias("_key"), docs[text].alias("_text")).mapInArrow(run, f"doc_id {kind}, fingerprint string")


def _starts(found: list[int], top: int | None, nameless: int, run_rows: float) -> list[tuple[int, int, int]]:
    """Where runs begin, in order: (without a key, ~key, hash). A key found at several places is cut by the hash."""
    counts = Counter(k for k in [*found, top] if k is not None)
    parts = [((0, ~key), n) for key, n in counts.items()]
    if nameless:
        parts.append(((1, 0), max(1, min(MOST_RUNS, round(nameless / run_rows)))))
    return sorted((*place, -(1 << 63) + j * (1 << 64) // n) for place, n in parts for j in range(n))


_PLACE = np.dtype([("nameless", "i1"), ("key", "i8"), ("hash", "i8")])


def _deal(starts: list[tuple[int, int, int]]):
    """The run of each document, and its place in the order of runs."""
    bounds = np.array(starts, _PLACE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_key")
            missing = keys.is_null().to_numpy(zero_copy_only=False)
            places = np.empty(len(keys), _PLACE)
            places["nameless"], places["hash"] = missing, batch.column("_hash").to_numpy()
            places["key"] = np.where(missing, 0, ~keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            own = np.maximum(np.searchsorted(bounds, places, side="right") - 1, 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(missing), pa.array(places["key"]), *batch.columns],
                                             names=["run", "nameless", "order", *batch.schema.names])

    return run


def _ahead(before: dict[tuple[int, int, int], int]):
    """All rows, and the first document of each run once more for the run before it; one from each task is enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = set()
        names = ["run", "ahead", "_key", "_hash", "_text"]
        for batch in batches:
            columns = [batch.column(c) for c in names[2:]]
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(np.zeros(batch.num_rows, bool)), *columns], names=names)
            for i, place in enumerate(zip(*(batch.column(c).to_pylist() for c in ("nameless", "order", "_hash")), strict=True)):
                at = before.get((int(place[0]), *place[1:]))
                if at is not None and at not in sent:
                    sent.add(at)
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([True]), *(c.slice(i, 1) for c in columns)], names=names)

    return run


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows by run and place: each document against its edited text and the document behind it."""
    made: list[dict] = []
    held, at, done = None, None, None

    def row(doc: tuple, following: tuple) -> dict:
        key, text, (sign, state, cut) = doc
        edited = text[:cut] + following[1][: len(text) - cut]
        parse = state.copy()
        parse.run(edited)
        changed = signature(edited, parse.ends)
        return {
            "doc_id": key, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
            "fingerprint": shown(sign), "edited_fingerprint": shown(changed),
            "near_edited": likeness(sign, changed), "near_next": likeness(sign, following[2][0]),
        }

    def parsed(text: str) -> tuple:
        cut = len(text) - len(text) // 2
        parse = Parse()
        state = parse.run(text, cut)
        return signature(text, parse.ends), state, cut

    kind = None
    for batch in batches:
        kind = kind or pa.schema([batch.schema.field("_key").with_name("doc_id"), ("n_chars", pa.int64()), *((c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")), ("near_edited", pa.float64()), ("near_next", pa.float64())])
        for run, ahead, key, text in zip(*(batch.column(c) for c in ("run", "ahead", "_key", "_text")), strict=True):
            run = run.as_py()
            if run != at:
                held, at, done = None, run, False
            if done:
                continue
            text = text.as_py() or ""
            now = (key.as_py(), text, parsed(text))
            if held is not None:
                made.append(row(held, now))
            held, done = now, ahead.as_py()
            if len(made) >= 1000:
                yield pa.RecordBatch.from_pylist(made, kind)
                made = []
    if made:
        yield pa.RecordBatch.from_pylist(made, kind)


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", run_chars: int = RUN_CHARS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    The edited text has its last half replaced by as much of the next document, in descending order of integer keys
    (after the last: the first). near_next is the likeness to that next document.
    """
    docs = docs.select(docs[key].cast("long").alias("_key"), F.xxhash64(docs[text]).alias("_hash"), docs[text].alias("_text"))
    chars, top, rows, named = docs.agg(F.sum(F.length("_text")), F.max("_key"), F.count(F.lit(1)), F.count("_key")).first()
    runs = int(min(MOST_RUNS, max(8, (chars or 0) // run_chars)))
    places = [i / runs for i in range(1, runs)]
    found = docs.agg(F.percentile_approx("_key", places, max(10_000, 10 * runs))).first()[0] or []
    deal = _deal(_starts(found, top, rows - named, max(1.0, rows / runs)))
    dealt = "run int, nameless boolean, order long, _key long, _hash long"
    firsts = docs.select("_key", "_hash").mapInArrow(deal, dealt).groupBy("run").agg(F.min(F.struct("nameless", "order", "_hash")).alias("first"))
    order = sorted((r.run, (int(r.first.nameless), r.first.order, r.first._hash)) for r in firsts.collect())  # a row for each run
    before = {first: order[i - 1][0] for i, (_, first) in enumerate(order)}
    sent = docs.mapInArrow(deal, f"{dealt}, _text string").mapInArrow(_ahead(before), "run int, ahead boolean, _key long, _hash long, _text string")
    order = ["run", "ahead", F.col("_key").desc_nulls_last(), "_hash", "_text"]
    return sent.repartition("run").sortWithinPartitions(*order).drop("_hash").mapInArrow(
        _compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
