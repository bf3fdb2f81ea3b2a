"""N-gram Jaccard join by vertical partitioning: partial counts in fragments of the n-gram order, summed afterwards.

1. Every document becomes the set of 64-bit hashes of its shingles. The hash order is cut into fragments of equal
   width. A batch of documents sends each fragment its n-grams, once per batch; a fragment finds those that another
   batch has as well, and returns how many each document has there. Summed over the fragments, this is the number of a
   document's n-grams that occur elsewhere. A document with fewer than `similarity` of its n-grams among them can't
   have a partner and is done: in a corpus, most are.
2. The others are collapsed to one node for each distinct set. Their n-grams are put in global order, rare ones first,
   and a node's prefix (the n-grams one of which any partner must share) gives candidates.
3. A candidate pair's overlap is counted fragment by fragment and summed.
4. Groups of many near copies aren't expanded into pairs. Every node is first compared with a few hubs of its n-grams,
   the smallest under a seeded order. Then only members of one n-gram that these links leave in different components
   are compared, block of nodes against block, and a block answers with the links that join components: no link
   between components is lost, and pairs never become rows.

Scale: texts move only where a document has candidates; a frequent n-gram costs a posting for each batch, not for each
document; exact copies meet in a grouped minimum. Tables in between are written to the shared folder.

Edge cases: null and empty texts have an empty set and are linked with nothing; texts with fewer words than `n` count
as one shingle; rows with equal sets are linked; null or repeated keys are allowed, a row without key joins its group
and the group's id is the smallest key that is not null (rows are told apart by 128 bits of a hash of key and text); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.llm.common import WORD, identity, stored
from logsieve.llm.graphs import components

N, SIMILARITY = 5, 80
#: N-grams that a batch holds at once, and text bytes for each fragment of the order.
BATCH, FRAGMENT_BYTES, SEGMENTS, HUBS = 1_000_000, 16_000_000, 4, 3
#: Nodes and n-grams of a block, n-grams of the order that a block's overlaps are counted over at once, n-grams of a task.
BLOCK, BLOCK_GRAMS, COLUMNS, TASK_GRAMS = 256, 262_144, 4096, 2_097_152
_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_MANY = np.uint16(0xFFFF)


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; words are runs without ASCII white space, A-Z in lower case."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(n, len(words))
    m = len(words) - k + 1
    out = np.full(m, k, np.uint64)
    for j in range(k):
        out = (out ^ (out >> np.uint64(29))) * _ODD[j % 5] + hashes[j : j + m]
    out = (out ^ (out >> np.uint64(31))) * _ODD[1]
    return np.unique(out ^ (out >> np.uint64(29)))


def digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _send(n: int, fragments: int):
    """For each batch and fragment: low halves of the n-grams, and the document that has each (or `many` have)."""

    def batch_rows(number: int, keys: pa.Array, marks: list[int], held: list[np.ndarray]) -> Iterator[dict]:
        digests = [digest(g) for g in held]
        sets: list[np.ndarray] = []
        own_of: dict[bytes, int] = {}
        for grams, d in zip(held, digests, strict=True):
            if d not in own_of:
                own_of[d] = len(sets)
                sets.append(grams)
        grams = np.concatenate(sets)
        own = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
        order = np.argsort(grams, kind="stable")
        grams, own = grams[order], own[order]
        starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]][: len(grams)])
        runs = np.diff(np.r_[starts, len(grams)])
        local = np.bincount(own[np.repeat(runs > 1, runs)], minlength=len(sets)).astype(np.uint32)
        grams, own = grams[starts], np.where(runs > 1, _MANY, own[starts])
        place = ((grams >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
        cuts = np.searchsorted(place, np.arange(fragments + 1, dtype=np.uint64))
        low = grams.astype(np.uint32)
        which = [own_of[d] for d in digests]
        meta = pa.table({"doc_id": keys, "row": pa.array(marks, pa.binary()), "n": pa.array([len(g) for g in held], pa.int32()), "digest": pa.array(digests, pa.binary()),
                         "own": pa.array(which, pa.int32()), "local": pa.array(local[which], pa.int32())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, meta.schema) as out:
            out.write_table(meta)
        home = number % fragments
        for f in range(fragments):
            a, b = cuts[f], cuts[f + 1]
            if b > a or f == home:
                yield {"fragment": f, "batch": number, "grams": low[a:b].tobytes(), "own": own[a:b].tobytes(), "meta": sink.getvalue().to_pybytes() if f == home else None}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, keys, marks, held, size = TaskContext.get().partitionId() << 32, [], [], [], 0
        kind = None

        def flush() -> Iterator[pa.RecordBatch]:
            rows = list(batch_rows(number, pa.array(keys, kind), marks, held))
            for at in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist(rows[at : at + 64], _SENT)

        for batch in batches:
            kind = batch.column("_key").type
            for key, mark, text in zip(batch.column("_key").to_pylist(), batch.column("_row").to_pylist(), batch.column("_text"), strict=True):
                grams = shingles(text.as_py(), n)
                keys.append(key)
                marks.append(mark)
                held.append(grams)
                size += len(grams)
                if size >= BATCH or len(held) == _MANY - 1:
                    yield from flush()
                    number, keys, marks, held, size = number + 1, [], [], [], 0
        if held:
            yield from flush()

    return run


_SENT = pa.schema([("fragment", pa.int32()), ("batch", pa.int64()), ("grams", pa.binary()), ("own", pa.binary()), ("meta", pa.binary())])


def _count_fragment(table: pa.Table) -> pa.Table:
    """How many of a batch's n-grams in this fragment other batches have as well, for each of its documents."""
    grams = [np.frombuffer(x, np.uint32) for x in table.column("grams").to_pylist()]
    owns = [np.frombuffer(x, np.uint16) for x in table.column("own").to_pylist()]
    every = np.sort(np.concatenate(grams))
    again = np.unique(every[1:][every[1:] == every[:-1]])
    counts = []
    for g, own in zip(grams, owns, strict=True):
        place = np.searchsorted(again, g)
        place[place == len(again)] = 0
        found = (again[place] == g) & (own != _MANY) if len(again) else np.zeros(len(g), bool)
        counts.append(np.bincount(own[found]).astype(np.uint32).tobytes())
    return pa.table({"batch": table.column("batch").cast(pa.int64()), "counts": pa.array(counts, pa.binary()), "meta": table.column("meta").cast(pa.binary())})


def _sum_batch(table: pa.Table) -> pa.Table:
    meta = pa.ipc.open_stream(next(m for m in table.column("meta").to_pylist() if m is not None)).read_all()
    own = meta.column("own").to_numpy()
    total = np.zeros(own.max() + 1, np.int64)
    for data in table.column("counts").to_pylist():
        part = np.frombuffer(data, np.uint32)
        total[: len(part)] += part
    shared = total[own] + meta.column("local").to_numpy()
    return meta.select(["doc_id", "row", "n", "digest"]).append_column("shared", pa.array(shared.astype(np.int32)))


def shared_counts(docs: DataFrame, n: int = N) -> DataFrame:
    """(doc_id, row, n, digest, shared) for every row of (_key, _row, _text).

    shared: how many of the n-grams another row may have. Rows with equal sets in different batches count as well,
    and so may (at one in thousands) n-grams whose hashes agree in part: it is never too low.
    """
    size = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    kind = docs.schema["_key"].dataType.simpleString()
    sent = docs.mapInArrow(_send(n, max(8, size // FRAGMENT_BYTES)), "fragment int, batch long, grams binary, own binary, meta binary")
    counts = sent.groupBy("fragment").applyInArrow(_count_fragment, "batch long, counts binary, meta binary")
    return counts.groupBy("batch").applyInArrow(_sum_batch, f"doc_id {kind}, row binary, n int, digest binary, shared int")


def _sets(n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t, n) for t in part.column("_text").to_pylist()]
                keep = [digest(s) == d for s, d in zip(sets, part.column("digest").to_pylist(), strict=True)]
                rows = [(d, s.view(np.int64)) for s, d, k in zip(sets, part.column("digest").to_pylist(), keep, strict=True) if k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in rows], pa.binary()), pa.array([s for _, s in rows], kind)], names=["digest", "grams"]
                )

    return run


def _may_link(a: str, b: str, similarity: int) -> Column:
    """Length and position filter for rows (n, i) that share the n-gram at place i as their first one in global order."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    reach = F.least(n - F.col(f"{a}.i"), m - F.col(f"{b}.i"))
    return (100 * F.least(n, m) >= similarity * F.greatest(n, m)) & ((100 + similarity) * reach >= similarity * (n + m))


def _verified(pairs: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) that are links: partial overlaps by segment of the n-gram order, summed for each pair."""
    part = F.explode(F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)), lambda s: F.struct(
        s.alias("segment"), F.filter("grams", lambda g: F.pmod(F.shiftright(g, 40), F.lit(SEGMENTS)) == s).alias("grams"))))
    segments = nodes.select("node", "n", part.alias("p")).select("node", "n", "p.*").where(F.size("grams") > 0)
    a = segments.select(F.col("node").alias("a"), F.col("n").alias("na"), "segment", F.col("grams").alias("ga"))
    b = segments.select(F.col("node").alias("b"), F.col("n").alias("nb"), "segment", F.col("grams").alias("gb"))
    partial = pairs.join(a, "a").join(b, ["b", "segment"]).withColumn("common", F.size(F.array_intersect("ga", "gb")))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return total.where((100 + similarity) * F.col("common") >= similarity * (F.col("na") + F.col("nb"))).select("a", "b")


def _pair(a: str, b: str) -> list[Column]:
    return [F.greatest(f"{a}.node", f"{b}.node").alias("a"), F.least(f"{a}.node", f"{b}.node").alias("b")]


def _hub_pairs(prefixes: DataFrame, similarity: int) -> DataFrame:
    """Each node with a few hubs of the n-grams in its prefix: as many rows as there are postings at most, for each hub."""
    hubs = None
    for seed in range(HUBS):
        first = F.min(F.struct(F.xxhash64("node", F.lit(seed)).alias("h"), "node", "n", "i")).alias("hub")
        found = prefixes.groupBy("gram").agg(first, F.count(F.lit(1)).alias("members")).where("members > 1")
        hub = found.select("gram", "hub.node", "hub.n", "hub.i").alias("y")
        pairs = prefixes.alias("x").join(hub, F.col("x.gram") == F.col("y.gram"))
        pairs = pairs.where((F.col("x.node") != F.col("y.node")) & _may_link("x", "y", similarity)).select(*_pair("x", "y"))
        hubs = pairs if hubs is None else hubs.unionByName(pairs)
    return hubs.distinct()


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left and right sets: partial counts by segment of the n-gram order, summed."""
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(common), COLUMNS):
        part = common[at : at + COLUMNS]
        sides = []
        for sets in (left, right):
            side = np.zeros((len(sets), len(part)), np.float32)
            for i, grams in enumerate(sets):
                place = np.searchsorted(part, grams)
                place[place == len(part)] = 0
                side[i, place[part[place] == grams]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _link_blocks(similarity: int):
    """Links between nodes of two blocks that join components: at most one less than the two have components."""

    def side(rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        lists = rows.column("grams").combine_chunks()
        flat, ends = np.asarray(lists.flatten()), np.cumsum(np.asarray(lists.value_lengths()))
        return np.split(flat, ends[:-1]), *(rows.column(c).to_numpy() for c in ("n", "label", "node"))

    def links(left: pa.Table, right: pa.Table) -> Iterator[tuple[int, int]]:
        (sets_a, n_a, label_a, node_a), (sets_b, n_b, label_b, node_b) = side(left), side(right)
        label = {x: x for x in (*label_a.tolist(), *label_b.tolist())}

        def find(x: int) -> int:
            while label[x] != x:
                label[x] = label[label[x]]
                x = label[x]
            return x

        linked = (100 + similarity) * _overlaps(sets_a, sets_b) >= similarity * (n_a[:, None].astype(np.int64) + n_b[None, :])
        linked &= label_a[:, None] != label_b[None, :]
        for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
            x, y = find(int(label_a[i])), find(int(label_b[j]))
            if x != y:
                label[x] = y
                yield int(node_a[i]), int(node_b[j])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("a", "ascending"), ("b", "ascending"), ("block", "ascending")])
        a, b, block = (table.column(c).to_numpy() for c in ("a", "b", "block"))
        new = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
        found: list[tuple[int, int]] = []
        for at, to in zip([0, *new.tolist()], [*new.tolist(), len(a)], strict=True):
            of = {x: table.slice(at + lo, hi - lo) for x in (a[at], b[at]) for lo, hi in [np.searchsorted(block[at:to], [x, x + 1])]}
            if all(len(x) for x in of.values()):
                found += links(of[a[at]], of[b[at]])
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return run


def _rest_links(prefixes: DataFrame, labels: DataFrame, nodes: DataFrame, similarity: int) -> DataFrame:
    """Links between members of one n-gram that are still in different components, found by blocks of nodes.

    A node's home is the most frequent of its n-grams with members of several components; there it is one of the
    largest component or one of the others. A home is cut into blocks of about BLOCK nodes, or fewer with BLOCK_GRAMS
    n-grams. Two blocks meet if they share such an n-gram and one of them has it outside the largest component there.
    """
    rows = prefixes.select("gram", "node", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = (
        rows.groupBy("gram", "label")
        .agg(F.count(F.lit(1)).alias("members"))
        .groupBy("gram")
        .agg(F.max(F.struct("members", "label")).alias("major"), F.sum("members").alias("members"), F.count(F.lit(1)).alias("labels"))
        .where("labels > 1")
        .select("gram", "members", F.col("major.label").alias("major"))
    )
    rows = stored(rows.join(mixed, "gram").withColumn("minor", F.col("label") != F.col("major")), "mixed")
    homes = rows.groupBy("node", "label", "n").agg(F.max(F.struct("members", "gram", "minor")).alias("home"))
    homes = homes.select("node", "label", "n", F.col("home.gram").alias("home"), F.col("home.minor").alias("outside"))
    parts = homes.groupBy("home", "outside").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_GRAMS)).alias("parts"))
    block = F.xxhash64("home", "outside", F.pmod(F.xxhash64("node"), "parts"))
    blocks = stored(homes.join(parts, ["home", "outside"]).select("node", "label", "n", block.alias("block")), "blocks")

    met = rows.join(blocks.select("node", "block"), "node").groupBy("gram", "block").agg(F.max("minor").alias("minor"))
    x, y = met.where("minor").select("gram", F.col("block").alias("x")), met.select("gram", F.col("block").alias("y"))
    pairs = stored(x.join(y, "gram").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "pairs")
    sides = pairs.withColumn("block", F.explode(F.array_distinct(F.array("a", "b"))))
    sizes = blocks.groupBy("block").agg(F.sum("n").alias("grams"))
    sent = sides.join(sizes, "block").agg(F.sum("grams")).first()[0] or 0
    sides = sides.withColumn("task", F.pmod(F.xxhash64("a", "b"), F.lit(max(1, int(sent) // TASK_GRAMS))))
    members = sides.join(blocks.drop("n"), "block").join(nodes, "node").select("task", "a", "b", "block", "node", "label", "n", "grams")
    return members.groupBy("task").applyInArrow(_link_blocks(similarity), "a long, b long")


def groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = N, similarity: int = SIMILARITY
) -> DataFrame:
    """(doc_id, n_shingles, component_id, row, group) of every document; `similarity` in hundredths.

    row: 128 bits of a hash of key and text; group: a digest that all documents of the component share.
    """
    docs = docs.select(docs[key].alias("_key"), docs[text].alias("_text"), identity(docs[key], docs[text]).alias("_row"))
    counted = stored(shared_counts(docs, n), "shared")
    classes = counted.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.min("row").alias("holder"), F.max("shared").alias("shared"), F.first("n").alias("n")
    )
    classes = stored(classes, "classes")
    open_ = classes.where(100 * F.col("shared") >= similarity * F.col("n")).select("digest", F.col("holder").alias("_open"))
    open_ = stored(open_, "open")  # so that its size is known before any text is shuffled
    held = docs.join(open_, F.col("_row") == F.col("_open")).groupBy("_row", "digest").agg(F.first("_text").alias("_text"))
    sets = held.select("_text", "digest").mapInArrow(_sets(n), "digest binary, grams array<long>")
    sets = stored(sets.dropDuplicates(["digest"]).withColumn("node", F.monotonically_increasing_id()), "sets")

    postings = sets.select("node", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    shared = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ordered = F.array_sort(F.collect_list(F.struct("df", "gram")))
    nodes = postings.join(shared, "gram").groupBy("node", "n").agg(ordered.alias("o")).select("node", "n", F.col("o.gram").alias("grams"))
    nodes = stored(nodes.where(100 * F.size("grams") >= similarity * F.col("n")), "nodes")
    alone = F.col("n") - F.size("grams")
    length = F.col("n") - F.ceil(similarity * F.col("n") / 100) + 1 - alone
    prefixes = nodes.where(length > 0).select("node", "n", alone.alias("alone"), F.posexplode(F.slice("grams", 1, length.cast("int"))))
    prefixes = stored(prefixes.select("node", "n", F.col("col").alias("gram"), (F.col("alone") + F.col("pos")).alias("i")), "prefixes")

    first = stored(_verified(_hub_pairs(prefixes, similarity), nodes, similarity), "links")
    labels = components(first)
    rest = stored(_rest_links(prefixes, labels, nodes, similarity), "links")
    labels = components(first.unionByName(rest))

    named = sets.select("node", "digest").join(classes.select("digest", "least"), "digest").join(labels, "node")
    least = named.groupBy("label").agg(F.min("least").alias("component"), F.min("digest").alias("group"))
    linked = named.join(least, "label").select("digest", "component", "group")
    every = classes.select("digest", "least").join(linked, "digest", "left").select(
        "digest", F.coalesce("component", "least").alias("component"), F.coalesce("group", "digest").alias("group")
    )
    rows = counted.join(every, "digest", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"), "row", "group")


def representatives(docs: DataFrame, n: int = N, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of `docs` (doc_id, text, ...) that stay: of each group the one with the smallest doc_id.

    Rows without words all stay; a null doc_id counts as the largest; of rows with equal doc_id and text one stays.
    """
    found = groups(docs, n=n, similarity=similarity).where("n_shingles > 0")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least")
    kept = found.groupBy("group").agg(least).select(F.col("least.row").alias("__kept"))
    own = next(name for name in ("__row", *(f"__row{i}" for i in range(len(docs.columns) + 1))) if name not in docs.columns)
    rows = docs.withColumn(own, identity("doc_id", "text"))
    named = rows.join(kept, rows[own] == kept["__kept"], "left_semi").dropDuplicates([own])
    wordless = rows.where(~F.coalesce(F.col("text"), F.lit("")).rlike(WORD))
    return named.unionByName(wordless).select(*docs.columns)
