"""Substring dedup by content-defined chunks of a gear rolling hash.

A gear hash rolls over the words of a text, joined by single spaces; a chunk ends at a word where the hash is smaller
than at its neighbours. What is cut depends on the bytes around, so that an insertion shifts no later cut and a passage
is cut alike wherever it stands, repeated lines and table rows too. Where no word stands out (one or two words over and
over), the smallest hash of the next LONGEST words ends the chunk.

Chunks alone are too short to tell a passage: a large corpus has nearly all of them somewhere. So each chunk begins a
chain, the least number of neighbouring chunks with `least_words` words, and each chunk ends one; chains are matched by a
digest of their chunks' digests. The first document that has a chain, in the order of keys, is its holder. A chain of
any other document is repeated word for word, in one piece, at one place of the holder. Chains that continue each other
in both documents are joined: a passage is one piece of one earlier document. Passages of a document may overlap where
different documents hold their parts.

A passage that two documents share is found unless the chunks at its ends, which reach beyond it, leave fewer than
`least_words` words; README has the rates. Shorter repeats, such as one line that many documents carry, stay.

Scale: a batch of documents sends the first occurrence of each chain to the fragment of its digest, and further ones
past it, spread over all fragments; so a chain in a third of all documents costs a fragment one row for each batch.
Only chains that occur again become rows, and those of one digest are dealt out where they are many (the join has both
sides from disk, so that Spark can split it). Passages are built within a document.

Edge cases: null and empty texts have no chunks; texts under `least_words` words have no chains; repeats inside one
document stay; rows with equal key and text count as one document; null keys come first; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logsieve.llm.common import WORD, same, stored

LEAST_WORDS = 24
#: Words of a chunk, at least and at most (a text's last chunk aside). The hash has 16 bits and so spans 16 bytes.
SHORTEST, LONGEST = 3, 12
BATCH_CHAINS, FRAGMENT_BYTES = 400_000, 16_000_000
#: A 16-bit number for each byte, by rule: the middle bits of a multiplied and folded counter.
GEAR = (((np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ** np.uint64(3)) >> np.uint64(40)).astype(np.uint16)


def chunk_ends(data: bytes) -> tuple[list[int], np.ndarray]:
    """For words joined by single spaces: how many words end with each chunk, and the byte after each word."""
    codes = np.frombuffer(data, np.uint8)
    rolled = GEAR[codes]
    for step in (1, 2, 4, 8):
        if len(rolled) > step:
            rolled = rolled.copy()
            rolled[step:] += rolled[:-step] << np.uint16(step)
    after = np.append(np.flatnonzero(codes == 32), len(codes))
    at = rolled[after - 1]
    near, most = SHORTEST - 1, np.iinfo(at.dtype).max
    beside = np.lib.stride_tricks.sliding_window_view(np.pad(at, near, constant_values=most), 2 * near + 1)
    lowest = (beside[:, :near].min(1) > at) & (beside[:, near:].min(1) == at)
    ends, last, n = [], 0, len(after)
    for word in [*(np.flatnonzero(lowest[near:]) + SHORTEST).tolist(), n + SHORTEST]:
        while word - last > LONGEST and n - last > LONGEST:
            window = at[last + SHORTEST - 1 : min(last + LONGEST, word - SHORTEST)][::-1]
            last += SHORTEST + len(window) - 1 - int(window.argmin())
            ends.append(last)
        if word <= n:
            last = word
            ends.append(last)
    if last < n:
        ends.append(n)
    return ends, after


def chunks(text: str | None) -> list[tuple[int, int, int]]:
    """(digest, first word, words) of each chunk; only the last may be shorter than SHORTEST words."""
    data = b" ".join((text or "").encode().split())
    if not data:
        return []
    ends, after = chunk_ends(data)
    found, first = [], 0
    for end in ends:
        begin = int(after[first - 1]) + 1 if first else 0
        found.append((xxhash.xxh3_64_intdigest(data[begin : int(after[end - 1])]), first, end - first))
        first = end
    return found


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.cumprod(np.full(n - 1, base, np.uint64))
    return out


def chains(text: str | None, least_words: int = LEAST_WORDS) -> dict[str, np.ndarray]:
    """digest, start (word) and words of the shortest chains that begin or end with each chunk of a text."""
    found = chunks(text)
    n = len(found)
    digest = np.array([d for d, _, _ in found], np.uint64)
    first, words = (np.array([c[i] for c in found], np.int64) for i in (1, 2))
    end = first + words
    from_, to = np.searchsorted(first, end - least_words, side="right") - 1, np.searchsorted(end, first + least_words, side="left")
    pairs = np.unique(np.concatenate([np.flatnonzero(to < n) * n + to[to < n], from_[from_ >= 0] * n + np.flatnonzero(from_ >= 0)]))
    begins, last = pairs // max(n, 1), pairs % max(n, 1)
    # Sums of digest * base^-place, so that a difference of two, times base^place, is the same wherever the chain stands.
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(digest * _powers(_BACK, n), dtype=np.uint64)])
    mixed = (sums[last + 1] - sums[begins]) * _powers(_BASE, n)[begins]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return {"digest": mixed ^ (mixed >> np.uint64(32)), "start": first[begins].astype(np.int32), "words": (end[last] - first[begins]).astype(np.int16)}


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _send(fragments: int, least_words: int):
    """For each batch and fragment: the batch's first occurrences of digests there, and a share of its further ones."""

    def rows(keys: pa.Array, prints: np.ndarray, held: list[dict]) -> Iterator[pa.RecordBatch]:
        columns = {name: np.concatenate([h[name] for h in held]) for name in ("digest", "start", "words")}
        digest = columns["digest"]
        owner = np.repeat(np.arange(len(held)), [len(h["digest"]) for h in held])
        order = np.argsort(digest, kind="stable")
        new = np.r_[True, digest[order][1:] != digest[order][:-1]]
        again = np.zeros(len(digest), bool)
        again[order[~new]] = True
        many = np.zeros(len(digest), bool)
        many[order[new]] = np.r_[~new[1:], False][new]
        place = ((digest >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
        place = np.where(again, np.arange(len(digest)) % fragments, place).astype(np.int64)
        columns["digest"] = digest.view(np.int64)
        table = pa.table({"doc_id": keys.take(pa.array(owner)), "print": prints[owner], **columns, "again": again, "many": many})
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(fragments + 1))
        table = table.take(order)
        for f in range(fragments):
            if cuts[f + 1] > cuts[f]:
                part = _pack(table.slice(cuts[f], cuts[f + 1] - cuts[f]).combine_chunks())
                yield pa.RecordBatch.from_pydict({"fragment": pa.array([f], pa.int32()), "rows": pa.array([part], pa.binary())})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints, held, size, kind = [], [], [], 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            if size:
                yield from rows(pa.array(keys, kind), np.array(prints, np.int64), held)

        for batch in batches:
            kind = batch.column("_key").type
            for key, mark, text in zip(batch.column("_key").to_pylist(), batch.column("_print").to_pylist(), batch.column("_text"), strict=True):
                found = chains(text.as_py(), least_words)
                if len(found["digest"]):
                    keys.append(key)
                    prints.append(mark)
                    held.append(found)
                    size += len(found["digest"])
                if size >= BATCH_CHAINS:
                    yield from flush()
                    keys, prints, held, size = [], [], [], 0
        yield from flush()

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """The rows of a fragment whose digest occurs more than once, and those that were only passed on."""
    parts = [pa.ipc.open_stream(x).read_all() for x in table.column("rows").to_pylist()]
    rows = pa.concat_tables(parts)
    digest = rows.column("digest").to_numpy()
    again, many = (rows.column(c).to_numpy() for c in ("again", "many"))
    firsts = np.sort(digest[~again])
    twice = np.unique(firsts[1:][firsts[1:] == firsts[:-1]])
    keep = again | many
    if len(twice):
        place = np.searchsorted(twice, digest)
        place[place == len(twice)] = 0
        keep |= ~again & (twice[place] == digest)
    return rows.filter(pa.array(keep)).drop_columns(["again", "many"])


def repeated_chains(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, print, digest, start, words) of every chain of (_key, _text, _print) that occurs more than once."""
    size = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    kind = docs.schema["_key"].dataType.simpleString()
    sent = docs.mapInArrow(_send(max(8, size // FRAGMENT_BYTES), least_words), "fragment int, rows binary")
    return sent.groupBy("fragment").applyInArrow(
        _repeated, f"doc_id {kind}, print long, digest long, start int, words short"
    )


def passages(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, print, start_word, n_words, first_doc_id, first_print, first_start_word) of each repeated passage.

    print: xxhash64 of the text; the first ones: the earlier document that has the passage, and where.
    """
    rows = docs.select(docs[key].alias("_key"), docs[text].alias("_text"), F.xxhash64(docs[text]).alias("_print"))
    found = stored(repeated_chains(rows, least_words), "chains")
    owner = F.struct("doc_id", "print")
    first = found.groupBy("digest").agg(F.min(F.struct("doc_id", "print", "start")).alias("first"), F.max(owner).alias("last"))
    held = F.struct("first.doc_id", "first.print")
    first = stored(first.where(~same(held, F.col("last"))).select("digest", "first"), "holders")
    repeats = found.join(first, "digest").where(~same(owner, held))
    repeats = repeats.select(
        *("doc_id", "print", "start"), (F.col("start") + F.col("words")).alias("end"), F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.print").alias("first_print"), (F.col("start") - F.col("first.start")).alias("shift"),
    )
    place = ["doc_id", "print", "first_doc_id", "first_print", "shift"]
    repeats = repeats.groupBy(*place, "start").agg(F.max("end").alias("end"))
    near = W.partitionBy(*place).orderBy("start")
    begins = F.when(F.lag("end").over(near) >= F.col("start"), 0).otherwise(1)
    runs = repeats.withColumn("begins", begins).withColumn("run", F.sum("begins").over(near))
    whole = runs.groupBy(*place, "run").agg(F.min("start").alias("start_word"), F.max("end").alias("end"))
    return whole.select("doc_id", "print", "start_word", (F.col("end") - F.col("start_word")).alias("n_words"),
                        "first_doc_id", "first_print", (F.col("start_word") - F.col("shift")).alias("first_start_word"))


_WORDS = re.compile(WORD)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given runs of words (first word, words), which may overlap, and the white space behind them."""
    at = [m.start() for m in _WORDS.finditer(text)] + [len(text)]
    kept, done = [], 0
    for first, words in sorted(spans):
        kept.append(text[done : at[first]])
        done = max(done, at[first + words])
    return "".join([*kept, text[done:]])


def _strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        spans = batch.column("__spans").to_pylist()
        new = [without(t, [(s["start_word"], s["n_words"]) for s in x]) if x else t for t, x in zip(texts, spans, strict=True)]
        names = [n for n in batch.schema.names if n not in ("__spans", "__print")]
        columns = {n: batch.column(n) for n in names} | {"text": pa.array(new, batch.column("text").type)}
        if "n_chars" in columns:
            old, kind = columns["n_chars"].to_pylist(), columns["n_chars"].type
            columns["n_chars"] = pa.array([len(t) if x else n for t, x, n in zip(new, spans, old, strict=True)], kind)
        keep = pa.array([not x or bool(t.strip(" \t\n\r\x0b\x0c")) for t, x in zip(new, spans, strict=True)], pa.bool_())
        yield pa.RecordBatch.from_pydict(columns).filter(keep)


def without_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The columns of `docs` (doc_id, text, ...), texts without repeated passages; a text that was nothing else goes."""
    span = F.struct(F.col("start_word").cast("int").alias("start_word"), F.col("n_words").cast("int").alias("n_words"))
    spans = passages(docs, least_words=least_words).groupBy("doc_id", "print").agg(F.collect_list(span).alias("__spans"))
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("print").alias("__other"), "__spans")
    rows = docs.withColumn("__print", F.xxhash64("text"))
    joined = rows.join(spans, same(rows["doc_id"], F.col("__id")) & (rows["__print"] == F.col("__other")), "left")
    return joined.select(*docs.columns, "__spans").mapInArrow(_strip, docs.schema)
