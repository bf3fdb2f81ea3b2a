import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from logsieve.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, " ", "  ", "a", " a", "a ", "a  b   c", "▁", "a▁b ▁ c", "x\ny\t z", "naïve 日本語 \x00 ​", "<s> </s> <unk>",
         "Grüße aus Köln", "word " * 3000, "y" * 20000, "\U0001f600 \U0001f600"]


def whole(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = sp.encode(text or "") + [sp.eos_id()]
    return ids, sp.decode(ids)


@given(st.text(alphabet=st.sampled_from(list(" ▁ab.Zé\n日\x00<>0")), max_size=40))
@settings(max_examples=300, deadline=None)
def test_chunks_give_the_ids_of_the_whole_text(text):
    words = pieces.chunks(text)
    assert [i for ids in pieces.segment(MODEL, words) for i in ids] == whole(text)[0][:-1]


@pytest.mark.parametrize("block_chars", [40, 8_000_000])
def test_encode_agrees_with_the_library(spark, block_chars):
    rows = [(i if i != 3 else None, t, "other") for i, t in enumerate(TEXTS)] + [(1, "a b", "x"), (1, "a b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 string").repartition(3)
    want = sorted((str(i), *whole(t)) for i, t, _ in rows)
    got = pieces.encode(docs, MODEL, "ids", block_chars=block_chars, fragment_chars=50).collect()
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == sorted((k, ids) for k, ids, _ in want)
    got = pieces.encode(docs, MODEL, "digest", block_chars=block_chars).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted(map(tuple, ((str(r.doc_id), *r[1:]) for r in got))) == sorted(
        (k, len(ids), sha(" ".join(map(str, ids))), sha(back)) for k, ids, back in want
    )


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.encode(docs, MODEL, "decoded").collect() == []
