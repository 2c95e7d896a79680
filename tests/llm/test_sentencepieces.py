import hashlib

import public_tokenizers
import sentencepiece

from adlake.llm import sentencepieces as S

ODD = ["", None, " ", "  ", "a ", " a", "a  b", "a   ", "▁", "a▁b", "▁▁x ", "\n", "a\n b", "\t x y", "中文 \U0001f600\U0001f600", "<s> </s> <unk>", "x" * 5000, "ab " * 3000, "é \u0000 q", "  \n  \n"]


def brute(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(S.MODEL))
    ids = sp.encode(text or "")
    return ids, sp.decode(ids)


def test_odd_texts_equal_the_library(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(0, "", "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = S.encode_decode(df).collect()
    assert len(got) == len(rows)
    for r in got:
        ids, text = brute(r.text)
        assert r.ids == ids and r.decoded == text, repr(r.text)[:60]


def test_full_table_starts_over():
    small = S.ChunkTable(public_tokenizers.path(S.MODEL), entries=3)
    for t in ["a b c d e f", "g h a b", "z a  z"]:
        ids, text = small.encode(t)
        assert ids == b"".join(i.to_bytes(4, "little") for i in brute(t)[0]) and text == brute(t)[1]


def test_query_against_the_library(spark, sf001):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    got = S.op4_sentencepiece(spark, sf001).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids, text = brute(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table(spark):
    assert S.encode_decode(spark.createDataFrame([], "doc_id long, text string")).collect() == []
