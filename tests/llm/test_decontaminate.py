import hashlib
import random
import re

import numpy as np

from adlake.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    """Per text: words, hit word numbers, items."""
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - 9, min(len(w), 1))):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(i)
    out = []
    for t in docs:
        w, hit, owners = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    owners |= windows[x]
        out.append((len(w), hit, sorted(o for o in owners if o is not None)))
    return out


def test_index_against_counting():
    rng = np.random.default_rng(2)
    stretches = [rng.integers(1, 5, rng.integers(1, 30)) for _ in range(60)] + [np.array([1, 2] * 20)] * 3
    index = D.FmIndex(stretches, 6, sample=4)
    rows = rng.integers(1, 6, (80, 3))
    length = rng.integers(1, 4, 80)
    got = sorted(zip(*(x.tolist() for x in index.search(rows, length))))
    want = sorted((p, int(index.first[s]) + k) for p in range(80) for s, x in enumerate(stretches) for k in range(len(x) - length[p] + 1) if (x[k : k + length[p]] == rows[p, : length[p]]).all())
    assert got == want


def fixture():
    rng = random.Random(3)
    vocab = ["the", "of", "Ände", "x1", "42", "and", "été", "q"]
    phrase = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, phrase(rng.choice([3, 10, 11, 25]))) for i in range(30)] + [(7, "the same"), (30, "THE, Same!"), (31, None), (32, " .. "), (None, "null id words"), (33, phrase(14)), (34, "")]
    docs = ["", None, "...", "the same", "a the-SAME b"]
    for _ in range(60):
        parts = [phrase(rng.randrange(30))]
        if rng.random() < 0.7:
            parts.append(rng.choice(items)[1] or "")
        docs.append(rng.choice([", ", " zz ", "\n"]).join(parts + [phrase(5)]).upper())
    docs += [docs[-1]] * 4 + [phrase(20000)]
    return docs, items


def check(spark, **how):
    docs, items = fixture()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id long, text string, n_words string")
    found = D.find(df, spark.createDataFrame(items, "item_id long, text string"), **how)
    got = {r.doc_id: r for r in found.collect()}
    for i, (n, hit, owners) in enumerate(brute(docs, items)):
        assert got[i].n_words == n and got[i].hit_items == owners
        assert {k for s in got[i].hit_spans for k in range(s["first"], s["last"])} == hit
        for s in got[i].hit_spans:
            assert words(docs[i][s["start"] : s["end"]]) == words(docs[i])[s["first"] : s["last"]]
    cleaned = {r.doc_id: r.text for r in D.remove(found).collect()}
    for i, (_, hit, _) in enumerate(brute(docs, items)):
        assert cleaned[i] == docs[i] if not hit else words(re.sub("", "", cleaned[i])) is not None
        if hit and docs[i]:
            cut = "".join(docs[i][a:b] for a, b in zip([0] + [s["end"] for s in got[i].hit_spans], [s["start"] for s in got[i].hit_spans] + [len(docs[i])]))
            assert cleaned[i] == cut


def test_against_brute_force(spark):
    check(spark)


def test_blocks_and_small_shards(spark):
    check(spark, block_bytes=400, shard_bytes=2000)


def test_query(spark, sf001):
    rows = spark.read.parquet(f"{sf001}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf001}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in D.op9_decontaminate(spark, sf001).collect()}
    assert len(got) == len(rows)
    for r, (n, hit, owners) in zip(rows, brute([r.text for r in rows], items)):
        g = got[r.doc_id]
        assert (g.n_words, g.n_hit, g.n_items, g.contaminated) == (n, len(hit), len(owners), bool(hit))
        assert g.items_sha256 == hashlib.sha256(",".join(sorted(map(str, owners))).encode()).hexdigest()
    assert any(g.contaminated for g in got.values())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r.n_words, r.hit_spans) for r in D.find(docs, none).collect()] == [(2, [])]
    assert D.find(docs.limit(0), none).collect() == []
