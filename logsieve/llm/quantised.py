"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, reranking with the original vectors.

1. Rows with equal label and vector are one class, with their number and smallest id.
2. Iterative quantisation learns rotations on a sample: centred unit vectors are turned to their principal axes, then
   rotated so that the signs of the coordinates, half of them set, lie as near as possible to the coordinates themselves.
   Each of ROTATIONS random starts ends in a rotation of its own and gives BITS bits (as many as there are dimensions, if
   fewer). Every class is encoded with all of them.
3. A code is cut into parts of PART bits, each the address in a table of its own, for each label and vector length. Two
   vectors at the limit of 0.98 are 11.5 degrees apart and differ in 6% of their bits: they share one of the 12 parts in
   99 of 100 cases, nearer ones more often. Unlike vectors share an address by chance, once in 2^PART.
4. Members of an address are compared by the Hamming distance of their whole codes. Most have no near code and drop out.
5. The vectors of the others meet at the addresses where they have a near code, and exact cosines decide. A pair counts
   at the first address that it shares. An address answers with each member's number of linked vectors, and one row
   that names the member's group there: links never become rows, and are never all in one place.

Scale: an address with more than BLOCK members is cut into blocks, and a task gets pairs of blocks, a bounded number of
rows. So a group of near copies costs a product for each pair, as counting its links must, but no row for each pair.
Only the sample (SAMPLE vectors of at most LONGEST numbers) and the rotations reach the driver and the tasks.

Recall is measured in the tests against brute force, see README. No link below the limit is ever reported.

Edge cases: rows with a null label, and vectors that are null, empty, zero or hold null or non-finite components, link
with nothing; vectors of different lengths don't link. Rotations are learned for the most frequent length in the sample;
vectors of other lengths are encoded by fixed rotations of their first BITS components. Rows with equal ids are rows of
their own; a null id is never the smallest, and such a row is never kept. Without rows there are none; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.llm.common import same, stored
from logsieve.llm.graphs import components

COSINE = 0.98
BITS, ROTATIONS, PART = 64, 3, 16
#: Classes that the rotations are learned from, the longest of their vectors, and rounds of learning.
SAMPLE, LONGEST, LEARNING = 4096, 4096, 40
#: Members that are compared with each other at once, and rows that a task gets besides one pair of blocks.
BLOCK, TASK_ROWS = 512, 8192


def _fixed(bits: int, start: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(start).standard_normal((bits, bits)))[0]


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class Codes:
    """Learned rotations for one length of vectors, fixed ones for all others."""

    def __init__(self, sample: list[list[float]], bits: int = BITS, rotations: int = ROTATIONS, part: int = PART):
        self.bits, self.rotations, self.part = bits, rotations, part
        lengths = Counter(len(v) for v in sample if len(v) <= LONGEST)
        self.length = min(lengths, key=lambda n: (-lengths[n], n)) if lengths else 0
        if self.length:
            x = _unit(np.array([v for v in sample if len(v) == self.length], np.float64))
            self.mean = x.mean(0)
            self.axes = [self._learn(x - self.mean, start) for start in range(rotations)]

    def _learn(self, x: np.ndarray, start: int) -> np.ndarray:
        """Principal axes turned so that x @ axes is near to its signs."""
        _, vectors = np.linalg.eigh(x.T @ x)
        axes = vectors[:, ::-1][:, : self.bits]
        v, turn = x @ axes, _fixed(axes.shape[1], start)
        for _ in range(LEARNING):
            u, _, w = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
            turn = w.T @ u.T
        return axes @ turn

    def parts(self, vectors: np.ndarray) -> np.ndarray:
        """For vectors of one length: the parts of their codes, a row of 16-bit numbers for each vector."""
        x, length = _unit(vectors), vectors.shape[1]
        bits = min(self.bits, length)
        out = []
        for start in range(self.rotations):
            z = (x - self.mean) @ self.axes[start] if length == self.length else x[:, :bits] @ _fixed(bits, start)
            for at in range(0, bits, self.part):
                signs = z[:, at : at + self.part] >= 0
                out.append(signs @ (1 << np.arange(signs.shape[1])))
        return np.stack(out, axis=1).astype(np.uint16)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).astype(np.float64), np.asarray(column.value_lengths()).astype(np.int64)


def _encode(codes: Codes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = _lists(batch.column("v"))
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
            for length in np.unique(sizes):
                rows = np.flatnonzero(sizes == length)
                parts = codes.parts(flat[starts[rows][:, None] + np.arange(length)])
                yield pa.RecordBatch.from_pydict({
                    "cid": batch.column("cid").take(pa.array(rows)), "code": pa.array([p.tobytes() for p in parts], pa.binary()),
                    "parts": pa.array(parts.astype(np.int32).tolist(), pa.list_(pa.int32()))})

    return run


def _meetings(members: DataFrame) -> DataFrame:
    """Rows (address, ...) with the pair (lo, hi) of blocks in which they meet, their own block, and a task for the pair."""
    sizes = members.groupBy("address").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    sizes = stored(sizes.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")), "addresses")
    rows = sizes.agg(F.sum(F.col("members") * F.col("blocks"))).first()[0] or 0
    met = members.join(sizes.drop("members"), "address").withColumn("block", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    met = met.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other")
    return met.withColumn("task", F.pmod(F.xxhash64("address", "lo", "hi"), F.lit(max(1, int(rows) // TASK_ROWS))))


def _each_pair(solve: Callable[[pa.Table, pa.Table, bool], dict], layout: pa.Schema):
    """Runs solve(left, right, whether they are the same rows) for each pair of blocks in a task."""

    def run(table: pa.Table) -> pa.Table:
        table = table.drop_columns(["task"]).sort_by([("address", "ascending"), ("lo", "ascending"), ("hi", "ascending"), ("block", "ascending")])
        address = np.asarray(table.column("address").combine_chunks().dictionary_encode().indices)
        lo, hi, block = (table.column(c).to_numpy() for c in ("lo", "hi", "block"))
        new = np.flatnonzero((address[1:] != address[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
        out = []
        for a, b in zip([0, *new], [*new, len(address)], strict=True):
            middle = a + int(np.searchsorted(block[a:b], lo[a], side="right")) if lo[a] != hi[a] else b
            left = table.slice(a, middle - a)
            if lo[a] == hi[a]:
                found = solve(left, left, True)
            elif a < middle < b:
                found = solve(left, table.slice(middle, b - middle), False)
            else:
                continue
            out.append(pa.table(found, schema=layout))
        return pa.concat_tables(out) if out else layout.empty_table()

    return run


def _codes_of(table: pa.Table) -> np.ndarray:
    codes = table.column("code").to_pylist()
    return np.frombuffer(b"".join(codes), np.uint16).reshape(len(codes), -1)


def _first_shared(left: np.ndarray, right: np.ndarray, of: int) -> np.ndarray:
    """Whether the pairs (rows of left and right) share no part before that number."""
    return ~(left[:, :of] == right[:, :of]).any(1)


def _number(table: pa.Table) -> int:
    return int(table.column("address")[0].as_py().split("|", 1)[0])


_OPEN = pa.schema([("address", pa.string()), ("cid", pa.int64())])
_FOUND = pa.schema([("cid", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _near_codes(total_bits: int):
    """The members that have a near code at this address, and at no address before it."""
    most = total_bits // 6 + 2

    def solve(left: pa.Table, right: pa.Table, same_rows: bool) -> dict:
        a, b = _codes_of(left), _codes_of(right)
        distance = np.zeros((len(a), len(b)), np.uint16)
        for p in range(a.shape[1]):
            distance += np.bitwise_count(a[:, p][:, None] ^ b[:, p][None, :])
        near = distance <= most
        if same_rows:
            near &= np.triu(np.ones(near.shape, bool), 1)
        i, j = np.nonzero(near)
        first = _first_shared(a[i], b[j], _number(left))
        held = [left.column("cid").take(pa.array(np.unique(i[first]))), right.column("cid").take(pa.array(np.unique(j[first])))]
        cids = pa.chunked_array([c for h in held for c in h.chunks], pa.int64())
        return {"address": pa.array([left.column("address")[0].as_py()] * len(cids), pa.string()), "cid": cids}

    return solve


def _links(cosine: float):
    """Each member's number of linked vectors in the pair of blocks, and one member of its group there."""

    def matrix(table: pa.Table) -> np.ndarray:
        flat, sizes = _lists(table.column("v"))
        x = flat.reshape(len(sizes), -1)
        return x / np.abs(x).max(1, keepdims=True)

    def solve(left: pa.Table, right: pa.Table, same_rows: bool) -> dict:
        a, b = matrix(left), matrix(right)
        linked = (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]) >= cosine
        if same_rows:
            linked &= np.triu(np.ones(linked.shape, bool), 1)
        i, j = np.nonzero(linked)
        first = _first_shared(_codes_of(left)[i], _codes_of(right)[j], _number(left))
        i, j = i[first], j[first]
        shift = 0 if same_rows else len(a)
        rows = left if same_rows else pa.concat_tables([left, right])
        cid, n = rows.column("cid").to_numpy(), rows.column("n").to_numpy()
        j = j + shift
        links = np.bincount(i, n[j], len(cid)).astype(np.int64) + np.bincount(j, n[i], len(cid)).astype(np.int64)
        root, before = np.arange(len(cid)), None
        while before is None or (root != before).any():
            before = root.copy()
            np.minimum.at(root, i, root[j])
            np.minimum.at(root, j, root[i])
            root = root[root]
        held = np.flatnonzero(links)
        return {"cid": cid[held], "links": links[held], "root": cid[root[held]]}

    return solve


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE,
                    bits: int = BITS, rotations: int = ROTATIONS, part: int = PART) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for every vector."""
    if not 1 <= part <= 16:
        raise ValueError("a part has 1 to 16 bits")
    x = F.col("x")
    takes_part = x.isNotNull() & F.col("label").isNotNull() & F.exists(x, lambda c: c != 0) & F.forall(
        x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    rows = vectors.select(vectors[key].alias("vec_id"), vectors[vector].alias("x"), vectors[label].alias("label"))
    rows = rows.withColumn("valid", F.coalesce(takes_part, F.lit(False))).select(
        "vec_id", "x", "valid", F.when(F.col("valid"), F.col("label")).alias("label"), F.size("x").alias("len"),
        F.when(F.col("valid"), F.xxhash64("x")).otherwise(F.xxhash64("vec_id", "label")).alias("h1"), F.xxhash64(F.lit(7), "x").alias("h2"))
    identity = ["label", "len", "h1", "h2"]
    classes = rows.where("valid").groupBy(*identity).agg(
        F.first("x").alias("v"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    sample = classes.where(F.col("len") <= LONGEST).orderBy("h1", "h2").limit(SAMPLE).select("v").collect()
    codes = Codes([r.v for r in sample], bits, rotations, part)
    encoded = stored(classes.select("cid", "v").mapInArrow(_encode(codes), "cid long, code binary, parts array<int>"), "codes")

    place = classes.select("cid", F.concat_ws("|", F.col("len").cast("string"), F.col("label").cast("string")).alias("place"))
    members = encoded.join(place, "cid").select("cid", "code", "place", F.posexplode("parts").alias("number", "part"))
    address = F.concat_ws("|", F.col("number").cast("string"), F.col("part").cast("string"), "place")
    members = members.select(address.alias("address"), "cid", "code")
    met = _meetings(members).select("task", "address", "lo", "hi", "block", "cid", "code")
    open_ = met.groupBy("task").applyInArrow(_each_pair(_near_codes(bits * rotations), _OPEN), "address string, cid long")
    open_ = stored(open_.distinct(), "open")

    held = open_.join(classes.select("cid", "v", "n"), "cid").join(encoded.select("cid", "code"), "cid")
    met = _meetings(held).select("task", "address", "lo", "hi", "block", "cid", "code", "v", "n")
    found = stored(met.groupBy("task").applyInArrow(_each_pair(_links(cosine), _FOUND), "cid long, links long, root long"), "found")

    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = components(found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    named = named.select(F.col("node").alias("cid"), F.col("label").alias("group"))
    least = named.join(classes.select("cid", "least"), "cid").groupBy("group").agg(F.min("least").alias("component"))
    of = named.join(least, "group").select("cid", "component")
    done = classes.join(counts, "cid", "left").join(of, "cid", "left").select(
        *[F.col(c).alias(f"_{c}") for c in identity],
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "least").alias("component_id"))
    alike = (rows["label"] == F.col("_label")) & (rows["len"] == F.col("_len")) & (rows["h1"] == F.col("_h1")) & (rows["h2"] == F.col("_h2"))
    joined = rows.drop("x").join(done, alike, "left")
    component = F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         (F.col("vec_id").isNotNull() & same(F.col("vec_id"), component)).alias("kept"))
