"""SentencePiece encoding and decoding over a table of distinct chunks.

Where no piece of the model has a whitespace mark behind another character, no piece can cross the place where a mark
follows a word. A text is then the sequence of its chunks (marks and the word behind them), and each distinct chunk
needs to be segmented once. Documents are packed into blocks of some megabytes. Each block sends its distinct chunks,
hashed into fragments, to the task that segments the fragment's distinct chunks; the ids come back to the block and
are joined by position, and so are the decoded chunks: the ids of a byte sequence never reach over a mark. A model without that property is refused.

Scale: a text moves once, compressed, and a chunk once for each block and direction, however often it occurs; no
vocabulary is broadcast. Blocks and fragments grow in number with the input, not in size. A block is a run of rows of
an input partition, which Spark makes again in the same way after a loss; a chunk that a block should still lack is
segmented in place.

Edge cases: a null text counts as empty and encodes to the end id alone; rows with equal or null keys are encoded each
on its own; a text without spaces is one chunk; an empty table gives no rows; `keys` names the columns to carry over.
"""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
BLOCK_CHARS = 16_000_000
FRAGMENT_CHARS = 16_000_000
_RUN = re.compile(f"{MARK}(?:{MARK}*[^{MARK}]*)")
_MODELS: dict[str, object] = {}

OUTPUTS = {
    "ids": "ids array<int>",
    "decoded": "n_tokens long, decoded string",
    "digest": "n_tokens long, ids_sha256 string, decoded_sha256 string",
}


def processor(model: str):
    """The model, loaded once in each worker."""
    if model not in _MODELS:
        import sentencepiece

        _MODELS[model] = sentencepiece.SentencePieceProcessor(model_file=model)
    return _MODELS[model]


def check_model(model: str) -> None:
    """Refuses a model whose chunks depend on each other or on how a text is normalised."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec = pb.ModelProto()
    with open(model, "rb") as file:
        spec.ParseFromString(file.read())
    norm = spec.normalizer_spec
    crossing = any(MARK in p.piece.lstrip(MARK) for p in spec.pieces)
    changes = norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix
    custom = any(p.type == pb.ModelProto.SentencePiece.USER_DEFINED for p in spec.pieces)
    if crossing or changes or custom or not norm.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("the model's pieces can cross whitespace marks, or it rewrites texts")


def chunks(text: str) -> list[str]:
    """The chunks of a text, each without its first mark; further marks are spaces."""
    if not text:
        return []
    if "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    marked = MARK + text.replace(" ", MARK)
    return [run[1:].replace(MARK, " ") for run in _RUN.findall(marked)]


def segment(model: str, words: list[str]) -> list[list[int]]:
    """Ids of chunks; the library puts the first mark back."""
    sp = processor(model)
    ids = sp.encode(words, num_threads=1)
    if "" in words:
        mark = sp.piece_to_id(MARK)
        alone = [mark] if mark != sp.unk_id() else [sp.piece_to_id(f"<0x{b:02X}>") for b in MARK.encode()]
        ids = [alone if w == "" else i for w, i in zip(words, ids, strict=True)]
    return ids


def _pack(table: pa.Table) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue()


def _unpack(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_all()


def _blocks(batches: Iterable[pa.RecordBatch], chars: int) -> Iterator[tuple[int, pa.Table]]:
    """Runs of rows with about `chars` bytes of text, numbered within the application's partitions."""
    first, number, rows, held = TaskContext.get().partitionId() << 32, 0, [], 0
    for batch in batches:
        at = 0
        lengths = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_pylist()
        for i, n in enumerate(lengths):
            held += n
            if held >= chars:
                rows.append(batch.slice(at, i + 1 - at))
                yield first + number, pa.Table.from_batches(rows)
                number, rows, held, at = number + 1, [], 0, i + 1
        if at < batch.num_rows:
            rows.append(batch.slice(at))
    if rows:
        yield first + number, pa.Table.from_batches(rows)


def _send_texts(chars: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches, chars):
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "rows": pa.array([_pack(rows)], pa.binary())})

    return run


def _fragment_words(rows: pa.Table, fragments: int) -> dict[int, list[str]]:
    """The distinct chunks of a block in order, by fragment."""
    words: set[str] = set()
    for text in rows.column("_text").to_pylist():
        words.update(chunks(text or ""))
    parts: dict[int, list[str]] = {}
    for word in sorted(words):
        parts.setdefault(zlib.crc32(word.encode()) % fragments, []).append(word)
    return parts


def _send_words(chars: int, fragments: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(batches, chars):
            parts = _fragment_words(rows, fragments)
            for fragment, words in parts.items():
                packed = _pack(pa.table({"word": pa.array(words, pa.string())}))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([fragment], pa.int32()), pa.array([packed], pa.binary())],
                    names=["block", "fragment", "words"],
                )

    return run


def _check(words: list[str]) -> int:
    return zlib.crc32("\0".join(words).encode())


def _segment_fragment(model: str):
    """Segments the distinct chunks of a fragment and answers each block: ids and their number in the block's order."""

    def run(table: pa.Table) -> pa.Table:
        sent = [_unpack(x).column("word").to_pylist() for x in table.column("words").to_pylist()]
        words = list(set(chain.from_iterable(sent)))
        ids = segment(model, words)
        odd = {w: d for w, d in zip(words, processor(model).decode(ids, num_threads=1), strict=True) if w != d}
        of = dict(zip(words, ids, strict=True))
        packed = []
        for part in sent:
            got = [of[w] for w in part]
            flat = np.fromiter(chain.from_iterable(got), np.int32)
            strange = [(i, odd[w]) for i, w in enumerate(part) if w in odd]
            packed.append(_pack(pa.table({
                "ids": [flat.astype(np.uint16 if flat.max(initial=0) < 65536 else np.int32).tobytes()],
                "counts": [np.fromiter(map(len, got), np.int32, len(got)).tobytes()], "check": [_check(part)],
                "odd_at": pa.array([[i for i, _ in strange]], pa.list_(pa.int32())),
                "odd": pa.array([[d for _, d in strange]], pa.list_(pa.string())),
            })))
        return pa.table({"block": table.column("block").cast(pa.int64()), "fragment": table.column("fragment").cast(pa.int32()), "known": pa.array(packed, pa.binary())})

    return run


class _Known(dict):
    """Ids of a block's chunks in decimal; a chunk that should be missing is segmented in place."""

    def __init__(self, model: str, parts: dict[int, list[str]], known: pa.Table):
        self.model, self.odd = model, {}
        number = [str(i) for i in range(processor(model).get_piece_size())]
        for fragment, data in zip(known.column("fragment").to_pylist(), known.column("known").to_pylist(), strict=True):
            words, (row,) = parts.get(fragment, []), _unpack(data).to_pylist()
            if _check(words) != row["check"]:
                continue
            counts = np.frombuffer(row["counts"], np.int32)
            kind = np.uint16 if len(row["ids"]) == 2 * counts.sum() else np.int32
            shown = [number[i] for i in np.frombuffer(row["ids"], kind).tolist()]
            ends = np.cumsum(counts).tolist()
            self.update((w, " ".join(shown[a:b])) for w, a, b in zip(words, [0, *ends], ends, strict=False))
            self.odd.update((words[i], d) for i, d in zip(row["odd_at"], row["odd"], strict=True))

    def __missing__(self, word: str) -> str:
        ids = segment(self.model, [word])[0]
        self[word] = " ".join(map(str, ids))
        decoded = processor(self.model).decode(ids)
        if decoded != word:
            self.odd[word] = decoded
        return self[word]

    def line(self, words: list[str], end: int) -> str:
        """Ids of a text in decimal, with the end id."""
        return " ".join([*map(self.__getitem__, words), str(end)])

    def decoded(self, words: list[str]) -> str:
        return " ".join([self.odd.get(w, w) for w in words] if self.odd else words)


def _join_block(model: str, keys: list[str], output: str, fragments: int, schema: pa.Schema):
    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        end, made = processor(model).eos_id(), []
        for data in texts.column("rows").to_pylist():
            rows = _unpack(data)
            table = _Known(model, _fragment_words(rows, fragments), known)
            out: dict[str, list] = {f.name: [] for f in schema if f.name not in keys}
            for text in rows.column("_text").to_pylist():
                words = chunks(text or "")
                line = table.line(words, end)
                if output == "ids":
                    out["ids"].append(np.fromiter(map(int, line.split(" ")), np.int32))
                    continue
                out["n_tokens"].append(line.count(" ") + 1)
                if output == "decoded":
                    out["decoded"].append(table.decoded(words))
                else:
                    out["ids_sha256"].append(sha(line))
                    out["decoded_sha256"].append(sha(table.decoded(words)))
            values = [pa.array(v, schema.field(n).type) for n, v in out.items()]
            made.append(pa.table([rows.column(k) for k in keys] + values, names=[*keys, *out]).cast(schema))
        return pa.concat_tables(made) if made else schema.empty_table()

    return run


def encode(
    docs: DataFrame,
    model: str,
    output: str = "ids",
    keys: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    block_chars: int = BLOCK_CHARS,
    fragment_chars: int = FRAGMENT_CHARS,
) -> DataFrame:
    """`keys` and one of OUTPUTS for each row of `docs`: ids with the end id, decoded texts, or digests of both."""
    from pyspark.sql.pandas.types import to_arrow_schema

    check_model(model)
    keys = list(keys)
    rows = docs.select(*[docs[k] for k in keys], docs[text].alias("_text"))
    total = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    fragments = max(8, total // fragment_chars)
    out = T.StructType([*rows.select(*keys).schema, *T.StructType.fromDDL(OUTPUTS[output])])
    texts = rows.mapInArrow(_send_texts(block_chars), "block long, rows binary")
    words = rows.select("_text").mapInArrow(_send_words(block_chars, fragments), "block long, fragment int, words binary")
    known = words.groupBy("fragment").applyInArrow(_segment_fragment(model), "block long, fragment int, known binary")
    join = _join_block(model, keys, output, fragments, to_arrow_schema(out))
    return texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(join, out)
