r"""Token ids in files of length-delimited binary records, with a separate offset index.

A record is: length of the payload (8 bytes, little endian), masked checksum of these 8 bytes (4), the payload, masked
checksum of the payload (4), a line feed. The payload is one byte (1: the key is there, 2: the ids are wide), the key
(8 bytes, signed, 0 for null) and the ids, 2 bytes each, or 4 where one needs more. The checksum is CRC-32; masked means rotated right by 15 bits plus a constant, so
that a checksum over bytes that hold checksums stays sound. Files come in ascending order of keys, null keys first.
The index is a table of (file, offset, length, doc_id, first, n_tokens, ids_crc32); `read_selected` uses it.

A text is encoded word by word: the tokenizer's normaliser and pattern never join characters across ASCII white space,
so each worker keeps the ids of words that it has seen lately, about CACHED words, and asks the library for the others. A
tokenizer for which this doesn't hold is refused.

Scale: texts move once, into ranges of keys, and rows without a key or with one key into ranges of a hash of their text
(equal rows are dealt as they come), so that no key fills a task or a file; files are written and committed by Spark, in any file system that it
writes, and read with its binary reader. A file holds about FILE_CHARS characters of text. Starts are sums over files,
added up in two levels, never in one task.

Edge cases: a null or empty text has the end id alone; equal keys follow each other by a hash of the text; an empty table gives no
rows; other columns are ignored. A damaged record raises an error that names the file and the offset.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logsieve.llm.common import new_path, stored

FILE_CHARS = 16_000_000
CACHED = 1_000_000
#: Bytes of text that are cut into words at once, words that are encoded together, and the mark between them.
BATCH_BYTES, TOGETHER, MARK = 8_000_000, 300, b"|"
_HEAD = struct.Struct("<QI")
_KEY = struct.Struct("<Bq")
_words: dict[tuple[str, int], list[dict[bytes, bytes]]] = {}
_splits: dict[str, bool] = {}
_ends: dict[str, np.ndarray] = {}
_tokenizers: dict[str, object] = {}


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(key: int | None, ids: bytes) -> bytes:
    """A record, from ids of 4 bytes each, without the line feed, which the writer adds."""
    numbers = np.frombuffer(ids, "<u4")
    wide = bool(numbers.max(initial=0) > 0xFFFF)
    payload = _KEY.pack((key is not None) + 2 * wide, key or 0) + (ids if wide else numbers.astype("<u2").tobytes())
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes, offset: int) -> tuple[int | None, bytes, int]:
    """(key, ids of 4 bytes each, offset of the next record)."""
    if len(data) < offset + _HEAD.size:
        raise ValueError(f"record at {offset}: cut off")
    length, check = _HEAD.unpack_from(data, offset)
    if masked(data[offset : offset + 8]) != check:
        raise ValueError(f"record at {offset}: the length is damaged")
    start, end = offset + _HEAD.size, offset + _HEAD.size + length
    payload = data[start:end]
    if len(data) < end + 5 or struct.unpack_from("<I", data, end)[0] != masked(payload) or data[end + 4] != 10:
        raise ValueError(f"record at {offset}: the payload is damaged")
    flags, key = _KEY.unpack_from(payload)
    ids = payload[_KEY.size :]
    return (key if flags & 1 else None), (ids if flags & 2 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()), end + 5


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def check_tokenizer(path: str) -> None:
    """Raises unless the tokenizer gives the ids of a text word by word."""
    tokenizer = _tokenizer(path)
    for text in ("ab cd", " ab\tcd\n", "a  b, c.d 1 2\x0b3", "x | y|z", "É e\u0301 \u3000z don't"):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        if ids != [i for w in text.encode().split() for i in tokenizer.encode(w.decode(), add_special_tokens=False).ids]:
            raise ValueError(f"{path}: this tokenizer joins characters across white space")


def splits_stops(path: str) -> bool:
    """Whether a stop behind a letter is encoded by itself, so that words with and without one need to be known once."""
    if path not in _splits:
        encode = lambda text: _tokenizer(path).encode(text, add_special_tokens=False).ids
        _splits[path] = all(encode(f"ab{p} c{p}\nDéF{p} it's{p} x") == encode(f"ab {p} c {p}\nDéF {p} it's {p} x") for p in ".,;:!?")
    return _splits[path]


def _word_ends(path: str) -> np.ndarray:
    """For each id, whether it ends a run of letters; all False where the tokenizer doesn't mark such ids."""
    if path not in _ends:
        tokenizer = _tokenizer(path)
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None) or ""
        vocabulary = tokenizer.get_vocab()
        ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        ids = tokenizer.encode("ab Cdé xyzzyxyzzy", add_special_tokens=False).ids
        _ends[path] = ends if ends[ids].sum() == 3 else np.zeros_like(ends)
    return _ends[path]


def _encode_words(path: str, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Each word with its ids. Words are encoded together: runs of letters end with an id that only ends such runs; others
    have a mark between them, which is one id and in none of them."""
    tokenizer, ends = _tokenizer(path), _word_ends(path)
    mark = tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
    letters, plain, rest = [], [], []
    for word in words:
        (letters if word.isalpha() or not word.isascii() and word.decode().isalpha() else plain if MARK not in word else rest).append(word)
    if not ends.any():
        plain, letters = letters + plain, []
    if len(mark) != 1:
        plain, rest = [], plain + rest
    for group, between in ((letters, b" "), (plain, b" " + MARK + b" ")):
        for at in range(0, len(group), TOGETHER):
            part = group[at : at + TOGETHER]
            ids = np.array(tokenizer.encode_batch_fast([between.join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            data = ids.tobytes()
            if between == b" ":
                stops = ((np.flatnonzero(ends[ids]) + 1) * 4).tolist()
                starts = [0, *stops[:-1]]
            else:
                cuts = np.flatnonzero(ids == mark[0]) * 4
                starts, stops = [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)]
            if len(stops) != len(part):  # not as this tokenizer was found to be
                rest += part
                continue
            yield from zip(part, (data[a:b] for a, b in zip(starts, stops, strict=True)), strict=True)
    for word, found in zip(rest, tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False), strict=True):
        yield word, np.array(found.ids, "<u4").tobytes()


def encode_texts(path: str, texts: list[str | None] | pa.Array, cached: int = CACHED) -> list[bytes]:
    """Ids of each text, 4 bytes each. Only the distinct words of all texts become Python objects."""
    known, before = _words.setdefault((path, cached), [{}, {}])
    array = pa.array(texts, pa.large_string()).fill_null("")
    if splits_stops(path):
        array = pc.replace_substring_regex(array, r"([A-Za-z])([.,;:!?])([ \t\n\r])", r"\1 \2\3")
    lists = pc.ascii_split_whitespace(array)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    known[b""] = b""
    known.update(_encode_words(path, [w for w in words if w not in known and w not in before]))
    known.update((w, before[w]) for w in words if w not in known)
    sizes = np.fromiter((len(known[w]) for w in words), np.int64, len(words)) // 4
    flat, starts = np.frombuffer(b"".join(map(known.__getitem__, words)), "<u4"), np.cumsum(sizes) - sizes
    at, offsets = coded.indices.to_numpy(), lists.offsets.to_numpy()
    del words, coded, lists, array
    if 2 * len(known) > cached:  # words that don't come again go with the older half
        _words[path, cached] = [{}, known]
    n = sizes[at]
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
    kind = np.int32 if len(flat) + ends[-1] < 1 << 31 else np.int64
    places = np.repeat((starts[at] - ends[:-1]).astype(kind), n)
    places += np.arange(ends[-1], dtype=kind)
    data = flat[places].tobytes()
    bounds = (ends[offsets - offsets[0]] * 4).tolist()
    return [data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with BATCH_BYTES of text together, or one longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(sizes.astype(np.int64)) - sizes) // BATCH_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", file_chars: int = FILE_CHARS) -> None:
    """Writes the ids of every document, with the end id, in ascending order of integer keys."""
    docs = docs.select(docs[key].cast("long").alias("_key"), docs[text].alias("_text"))
    end = np.array([end_id], "<u4").tobytes()

    check_tokenizer(tokenizer)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _pieces(batches):
            ids = encode_texts(tokenizer, part.column("_text"))
            made = [frame(k, i + end) for k, i in zip(part.column("_key").to_pylist(), ids, strict=True)]
            del ids
            pa.default_memory_pool().release_unused()
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])

    chars = docs.agg(F.sum(F.length("_text"))).first()[0] or 0
    order = [F.col("_key").asc_nulls_first(), "_hash", "_number"]
    ordered = docs.withColumn("_hash", F.xxhash64("_text")).withColumn("_number", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(max(8, chars // file_chars), *order).sortWithinPartitions(*order).select("_key", "_text")
    framed = ordered.mapInArrow(run, "record binary")
    framed.select(F.col("record").cast("string")).write.option("lineSep", "\n").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(number.alias("file"), "content")


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "offset", "length", "doc_id", "first", "n_tokens", "ids_crc32"]
    for batch in batches:
        for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
            data, offset, first, rows = content.as_py(), 0, 0, []
            while offset < len(data):
                try:
                    key, ids, after = unframe(data, offset)
                except ValueError as error:
                    raise ValueError(f"file {file}, {error}") from None
                rows.append((file, offset, after - offset, key, first, len(ids) // 4, zlib.crc32(ids)))
                offset, first = after, first + len(ids) // 4
            for at in range(0, len(rows), 10_000):
                columns = zip(*rows[at : at + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """Reads and checks every record of the files, and writes the offset index to the shared folder."""
    kinds = "file long, offset long, length long, doc_id long, first long, n_tokens long, ids_crc32 long"
    return stored(_files(spark, path).mapInArrow(_scan, kinds), "index")


def file_starts(index: DataFrame, group: int = 4096) -> DataFrame:
    """(file, before): ids in all files before; summed in groups of files, then over groups."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("ids")).withColumn("group", F.floor(F.col("file") / group))
    before = F.coalesce(F.sum("ids").over(W.partitionBy("group").orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    groups = files.groupBy("group").agg(F.sum("ids").alias("all"))
    base = F.coalesce(F.sum("all").over(W.orderBy("group").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    groups = groups.select("group", base.alias("base"))
    return files.withColumn("inside", before).join(groups, "group").select("file", (F.col("base") + F.col("inside")).alias("before"))


def placed(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record."""
    rows = index.join(file_starts(index), "file")
    return rows.select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def read_selected(path: str, index: DataFrame) -> DataFrame:
    """(doc_id, ids) of the records that the given rows of the index point to, in whatever order they come."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, offsets in zip(batch.column("content"), batch.column("offsets").to_pylist(), strict=True):
                found = [unframe(content.as_py(), o)[:2] for o in offsets]
                ids = pa.array([np.frombuffer(i, "<u4").astype(np.int64) for _, i in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), ids], names=["doc_id", "ids"])

    wanted = index.groupBy("file").agg(F.collect_list("offset").alias("offsets"))
    rows = _files(index.sparkSession, path).join(wanted, "file").select("content", "offsets")
    return rows.mapInArrow(run, "doc_id long, ids array<long>")


def token_records(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Writes the files and their index, reads them back, and returns `placed`."""
    path = new_path(docs.sparkSession, "records")
    write(docs, path, tokenizer, end_id)
    return placed(build_index(docs.sparkSession, path))
