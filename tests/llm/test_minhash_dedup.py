import random
import re

import numpy as np

from adlake.llm import minhash_dedup as M


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1))))


def brute(rows):
    """doc_id -> (set size, component), by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, rows, monkeypatch=None):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df).collect()}
    want = brute(rows)
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}
    return want


def test_sets_are_shingles():
    texts = ["A b\tc\nd e F a b c d e", "", None, "one two", "ONE  two", "a\x85b c\xa0d", "x " * 2000, "é É"]
    for t, s in zip(texts, M.shingle_sets(texts)):
        assert len(s) == len(shingles(t))
    assert (M.shingle_sets(["One two"])[0] == M.shingle_sets(["one\ttwo"])[0]).all()


def test_min_and_max_match_as_often_as_the_sets_overlap():
    rng = np.random.default_rng(3)
    hashes = M._mixed(rng.integers(0, 1 << 63, 300, np.uint64))
    a, b = np.sort(hashes[:250]), np.sort(hashes[50:])
    p = M.permutations(3000)
    share = np.mean([[(a * f).min() == (b * f).min(), (a * f).max() == (b * f).max()] for f in p])
    assert abs(share - 200 / 300) < 0.03


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "UNIT", 8)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    texts = ["", None, "  ", "one two", "one two", "ONE two", "solo"]
    base = [word() for _ in range(60)]
    for _ in range(60):  # near copies of one text, about half of their pairs below the threshold
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(60)] = word()
        texts.append(" ".join(t))
    for _ in range(30):
        t = [word() for _ in range(rng.randrange(5, 80))]
        texts.append(" ".join(t))
        texts.append(" ".join(t[: len(t) - rng.randrange(4)]))
    texts += [texts[-1]] * 5 + [" ".join(word() for _ in range(30000))] * 2
    order = list(range(len(texts)))
    rng.shuffle(order)
    want = check(spark, list(zip(order, texts)))
    assert len({c for _, c in want.values()}) < len(texts) - 40


def test_query_against_brute_force(spark, sf001):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in M.op6_minhash_dedup(spark, sf001).collect()}
    assert got == brute(rows)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (None, "a b c"), (2, None), (1, "a b c")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in M.near_duplicates(df).collect())
    assert got == [(0, None, True), (0, None, True), (1, 1, True), (2, 2, True)]
    assert M.near_duplicates(df.limit(0)).collect() == []


def test_rows_of_one_id_are_one_document(spark):
    w, z = "a b c d e f", "u v w x y z z"
    df = spark.createDataFrame([(1, w), (1, w), (2, w), (2, z), (3, z), (4, z + " q r s"), (5, "other"), (5, None)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df).collect())
    assert got == [(1, 2, 1, True), (2, 3, 1, False), (3, 3, 1, False), (4, 6, 4, True), (5, 1, 5, True)]
