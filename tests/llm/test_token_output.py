import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from adlake.llm import token_output as O

ODD = ["", None, " ", "It's I'LL 'S 't x's \"'s", "a<|endoftext|>b", "ÀÉÿ ß µª º²½ 12 3", "中文 ABC Σας", "\x1c\x1d a\x85b\xa0c\x0bd\x00e", "x" * 3000, "don't!!! ..,'ve'", "é é"]


TOK = Tokenizer.from_file(public_tokenizers.path(O.VOCABULARY))


def brute(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


def test_words_equal_the_library():
    words = O.WordTable(public_tokenizers.path(O.VOCABULARY), entries=50)
    rng = random.Random(5)
    fuzz = ["".join(chr(rng.choice([rng.randrange(256), 32, 39, rng.randrange(97, 123)])) for _ in range(60)) for _ in range(600)]
    fuzz += ["".join(rng.choice(["'", "s", "re", "l", "'ll", " ", "é", "7", "-", "x"]) for _ in range(30)) for _ in range(600)]
    for k in range(0, len(ODD + fuzz), 40):
        batch = (ODD + fuzz)[k : k + 40]
        for t, ids in zip(batch, words.encode(batch)):
            assert np.frombuffer(ids, words.kind).tolist() == brute(t), repr(t)


def test_coding_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = O.pack(v)
        assert len(control) == -(-n // 4)
        assert (O.unpack(control, data, n) == v).all()


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    path = tempfile.mkdtemp(prefix="tokens-") + "/t"
    O.write(O.encode(df), path, block_ids=100)
    got = sorted(O.read(spark, path).collect(), key=lambda r: r.start)
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order) and len(got) == len(rows)
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    want = sorted((-1 if i is None else i, zlib.crc32(np.array([*brute(t), 1], "<u4").tobytes())) for i, t, _ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, zlib.crc32(r.ids)) for r in got) == want


def test_files_round_trip(spark):
    check(spark, [(90 - i, t, "x") for i, t in enumerate(ODD)] + [(90, "same id", "x"), (None, "no id", "x")])


def test_empty_table(spark):
    check(spark, [])


def test_query_against_the_library(spark, sf001):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    got = {r.doc_id: r for r in O.op7_token_output(spark, sf001).collect()}
    at = 0
    for i in sorted(texts):
        ids = [*brute(texts[i]), 1]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(got) == len(texts)
