import random

import public_tokenizers

from adlake.llm import token_counts as C

PATH = public_tokenizers.path(C.VOCABULARY)


def brute(text, sections):
    """Counts per section (in characters, as given), and outside."""
    enc, _ = C.encoding(PATH)
    raw = text.encode()
    owner, at = [], [0]
    for c in text:
        at.append(at[-1] + len(c.encode()))
    owner = [None] * len(raw)
    for k in sorted(range(len(sections)), key=lambda k: (min(max(sections[k][0], 0), len(text)), k)):
        a, b = (at[min(max(x, 0), len(text))] for x in sections[k])
        for i in range(a, b):
            owner[i] = k if owner[i] is None else owner[i]
    n, outside, pos = [0] * len(sections), 0, 0
    for token in enc.encode_ordinary(text):
        size = len(enc.decode_single_token_bytes(token))
        held = [o for o in owner[pos : pos + size] if o is not None]
        pos += size
        if held:
            n[max(dict.fromkeys(held), key=held.count)] += 1
        else:
            outside += 1
    assert pos == len(raw)
    return n, outside


TEXTS = ["", "\n", "\n\n\n\n", "one two\nthree   \n\n  four", "été \U0001f600\U0001f600\n中文字\n", " a\n b \n" * 40, "x" * 30000, "a b " * 20000]


def lines(text):
    out, a = [], 0
    for part in text.split("\n"):
        out.append((a, min(a + len(part) + 1, len(text))))
        a += len(part) + 1
    return out


def test_lines_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*TEXTS, None])], "doc_id long, text string, n_tokens string")
    for r in C.attribute(df).collect():
        text = r.text or ""
        n, outside = brute(text, lines(text))
        assert [s["n_tokens"] for s in r.section_tokens] == n and r.n_outside == outside == 0
        assert [(s["start"], s["end"]) for s in r.section_tokens] == lines(text)
        assert r.n_tokens == sum(n)


def test_given_sections_against_brute_force():
    rng = random.Random(2)
    for text in TEXTS[:6] + ["The quick brown fox, unbelievably,  jumped\n\n over été \U0001f600"]:
        for _ in range(60):
            spans, a = [], 0
            while a < len(text) and rng.random() < 0.9:
                a += rng.randrange(4)
                b = a + rng.randrange(6)
                spans.append((a, b))
                a = b - rng.choice([0, 0, 0, 1]) if b > a else b
            given = [{"name": str(k), "start": x, "end": y} for k, (x, y) in enumerate(spans)]
            rows, total, outside = C.count(text, given, True, PATH)
            n, out = brute(text, spans)
            assert ([r["n_tokens"] for r in rows], outside) == (n, out) and total == sum(n) + out, (text, spans)


def test_null_sections_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", None), (1, "a b", [("t", 0, 99), (None, None, 1)])], "doc_id long, text string, s array<struct<name:string,start:long,end:long>>")
    got = sorted(((len(r.section_tokens), r.n_outside) for r in C.attribute(df, sections_col="s").collect()))
    assert got == [(0, 2), (2, 0)]
    assert C.attribute(df.limit(0)).collect() == []


def test_query(spark, sf001):
    got = C.op3_token_counts(spark, sf001).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    by = {}
    for r in got:
        by.setdefault(r.doc_id, {})[r.line] = r.n_tokens
    assert len(by) == len(texts)
    for i in sorted(texts)[:60]:
        assert [by[i][k] for k in range(len(by[i]))] == brute(texts[i], lines(texts[i]))[0]
