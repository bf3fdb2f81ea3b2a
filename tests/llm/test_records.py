import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logsieve.llm import records

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = ["", None, " ", "Hello  World!!", "it's 42 <|endoftext|>x\n\ty", "É́ Σας ΑΣ σ", " a b\x0bc\x1cd", "日本語 \U0001f600", "w " * 5000, "z" * 9000]


def whole(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


@given(st.text(alphabet=st.sampled_from(list("ab|.,İΣσ's 1!́ \u0085\x0b\x1c\n日<|>")), max_size=30))
@settings(max_examples=300, deadline=None)
def test_words_give_the_ids_of_the_whole_text(text):
    assert np.frombuffer(records.encode_texts(PATH, [text])[0], "<u4").tolist() == whole(text)[:-1]


def test_tokenizers_that_join_words_are_refused():
    records.check_tokenizer(PATH)
    with pytest.raises(ValueError):
        records.check_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_stops_are_words_of_their_own():
    assert records.splits_stops(PATH)
    texts = ["one, two. Two! it's, o'clock; a.b c.. d.) e,\tf.\r\n3. x", "end.", "é. ß, 日."]
    assert [np.frombuffer(g, "<u4").tolist() for g in records.encode_texts(PATH, texts)] == [whole(t)[:-1] for t in texts]


def test_small_cache():
    got = records.encode_texts(PATH, ["a b", "c d a", "b e", "a|b | c||", "|", None], cached=2)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [whole(t)[:-1] for t in ("a b", "c d a", "b e", "a|b | c||", "|", None)]


def test_files_are_read_back(spark, tmp_path):
    rows = [(None if i == 3 else i * 7 % 10, t, "clash") for i, t in enumerate(TEXTS)] + [(1, "again", "x"), (1, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    path = str(tmp_path / "records")
    records.write(docs, path, PATH, end_id=1, file_chars=20)
    index = records.build_index(spark, path)
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for key, text, _ in rows:
        ids = whole(text)
        want.append((str(key), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((str(r.doc_id), *r[1:]) for r in records.placed(index).collect()) == sorted(want)
    some = index.where("doc_id in (1, 4)")
    got = sorted((r.doc_id, r.ids) for r in records.read_selected(path, some).collect())
    assert got == sorted((k, whole(t)) for k, t, _ in rows if k in (1, 4))


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert records.token_records(docs, PATH, 1).collect() == []


def test_damage_is_found():
    data = records.frame(5, b"\1\0\0\0" * 3) + b"\n"
    assert records.unframe(data, 0) == (5, b"\1\0\0\0" * 3, len(data))
    for key, ids in ((None, [1, 70_000]), (-3, [65_535]), (0, [])):
        packed = np.array(ids, "<u4").tobytes()
        assert records.unframe(records.frame(key, packed) + b"\n", 0)[:2] == (key, packed)
    for at in (0, 9, 20, len(data) - 3):
        with pytest.raises(ValueError):
            records.unframe(data[:at] + bytes([data[at] ^ 4]) + data[at + 1 :], 0)
    with pytest.raises(ValueError):
        records.unframe(data[:-4], 0)


@pytest.mark.parametrize("key", [None, 5])
def test_one_key_is_dealt_over_files(spark, tmp_path, key):
    rows = [(key, f"word{i % 400} and some more words") for i in range(2000)] + [(9, "x"), (1, "y")]
    path = str(tmp_path / "records")
    records.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path, PATH, end_id=1, file_chars=3000)
    index = records.build_index(spark, path)
    sizes = [r["count"] for r in index.groupBy("file").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 500
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in records.placed(index).collect())
    assert [g[1] for g in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    assert all(a[0] + a[2] == b[0] for a, b in zip(got, got[1:]))
