import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlake.llm import lm_scoring as L


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), ""]


def brute(rows, mu=L.MU, d=L.DISCOUNT):
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    texts = [words(t) for _, t in rows]
    one, two, three, after = Counter(), Counter(), Counter(), {}
    for h, t in zip(held, texts, strict=True):
        if h:
            continue
        one.update(t)
        p = ["^", "^", *t]
        one["^"] += 1
        for a, b, c in zip(p, p[1:], p[2:], strict=False):
            three[a, b, c] += 1
            two[b, c] += 1
            after.setdefault((a, b), Counter())[c] += 1
    texts_, n = one.pop("^", 0), sum(one.values()) - one["^"]
    del one["^"]
    out = []
    for (i, _), h, t in zip(rows, held, texts, strict=True):
        p, base, score = ["^", "^", *t], 0.0, 0.0
        for a, b, c in zip(p, p[1:], p[2:], strict=False):
            p1 = (one[c] + 0.1) / (n + 0.1 * (len(one) + 1))
            p2 = (two[b, c] + mu * p1) / ((texts_ if b == "^" else one[b]) + mu)
            seen = after.get((a, b))
            total = sum(seen.values()) if seen else 0
            p3 = (max(three[a, b, c] - d, 0) + d * len(seen) * p2) / total if total else p2
            base, score = base + math.log10(p1), score + math.log10(p3)
        out.append((i, h, len(t), sum(one[w] > 0 for w in t), n, base, score))
    return out


def check(spark, rows, **how):
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, row int, block string").repartition(3)
    got = L.score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, **how).collect()
    order = lambda r: (r[0] is None, r[0], *r[1:5], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=order), sorted(brute(rows), key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-11)
        assert abs(g[6] - w[6]) <= 2 * w[2] / L.STEP  # half a step for each of three values


def corpus(n=120):
    rng = random.Random(5)
    names = ["the", "The", "a", "été", "漢字", "x\x00y", " wide", *("w%d" % i for i in range(60))]
    rows = []
    for i in range(n):
        k = rng.choice([0, 1, 2, 3, 40, 200])
        rows.append((i, "".join(rng.choices(names, weights=[30, 9, 9] + [1] * (len(names) - 3))[0] + rng.choice([" ", "\n", "\t ", "\x0b"]) for _ in range(k))))
    rows += [(200 + i, "of the " * 300 + "w1 w2") for i in range(6)] + [(3, rows[3][1]), (7, None), (8, ""), (9, " \r\x0c"), (None, "the a the"), (None, None)]
    return rows


@pytest.mark.parametrize("how", [{}, {"block": 64, "shards": 5}])
def test_against_brute_force(spark, how):
    check(spark, corpus(), **how)


def test_empty_tables_and_nothing_to_learn(spark):
    check(spark, [])
    check(spark, [(None, "a b")])
    check(spark, [(1, None)])


def test_held_out_texts_score_above_the_base(spark, sf001):
    df = spark.read.parquet(f"{sf001}/documents.parquet")
    r = L.score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_monotone_sequences():
    rng = np.random.default_rng(1)
    for n, top in [(0, 1), (1, 1), (1, 1 << 50), (300, 20), (1000, 1 << 20), (5000, 5001), (64, 1 << 40)]:
        values = np.sort(rng.integers(0, top, n))
        if n == 1000:
            values[:700] = values[699] + np.arange(-699, 1)  # a dense stretch
            values = np.sort(np.abs(values))
        s = L.Monotone(*L.Monotone.arrays(values))
        assert s[np.arange(n)].tolist() == values.tolist()
        ask = np.unique(np.concatenate([values, values + 1, np.maximum(values - 1, 0), [0, top, 3 * top + 7]]))
        place, found = s.successor(ask)
        assert found.tolist() == np.isin(ask, values).tolist()
        assert place.tolist() == np.searchsorted(values, ask).tolist()


def test_codes_of_numbers_and_probabilities():
    rng = np.random.default_rng(1)
    for top in (1, 300, 1 << 33, 1 << 60):
        a = rng.integers(0, top, 1000)
        assert L.unpacked(L.packed(a)).tolist() == a.tolist()
    assert L.unpacked(L.packed(np.zeros(0, np.int64))).tolist() == []
    p = np.array([0, 1, 0.5, 1e-9, 1e-30])
    back = L.restored(L.quantised(p))
    assert back[0] == 0 and back[1] == 1 and 0 < back[4] < 1e-15
    assert np.abs(np.log10(back[1:4] / p[1:4])).max() <= 0.5001 / L.STEP


def test_what_the_trie_answers():
    rng = np.random.default_rng(8)
    seen = {}
    for _ in range(4000):
        g = tuple(int(x) for x in 2 + rng.zipf(1.3, 3) % 300)
        seen[g] = int(rng.integers(0, 4))
    grams = sorted(seen)
    pairs = sorted({g[:2] for g in grams})
    total = {u: 10 + u for u, _ in pairs}
    firsts = sorted(total)
    cols = {"u": firsts, "u_count": [total[u] for u in firsts], "u_size": [sum(p[0] == u for p in pairs) for u in firsts], "v": [p[1] for p in pairs], "size": [sum(g[:2] == p for g in grams) for p in pairs], "w": [g[2] for g in grams], "seen": [seen[g] for g in grams]}
    row = {"shard": 4, "block": 9, **{k: L.packed(np.array(v)) for k, v in cols.items()}}
    out, trie = L.answered(pa.Table.from_pylist([row, row | {"block": 10}]))
    c2 = {p: 2 * sum(seen[g] for g in grams if g[:2] == p) for p in pairs}
    t2 = {p: sum(seen[g] > 0 for g in grams if g[:2] == p) for p in pairs}
    for r in out.to_pylist():
        second, back, third = (L.restored(L.unpacked(r[k])) for k in ("second", "backoff", "third"))
        np.testing.assert_allclose(second, [c2[p] / (total[p[0]] + L.MU) for p in pairs], rtol=3e-4)
        np.testing.assert_allclose(back, [L.DISCOUNT * t2[p] / c2[p] if c2[p] else 1 for p in pairs], rtol=3e-4)
        np.testing.assert_allclose(third, [max(2 * seen[g] - L.DISCOUNT, 0) / c2[g[:2]] if c2[g[:2]] else 0 for g in grams], rtol=3e-4)
    # Compact: below the 24 bytes that three numbers take.
    assert len(trie) < 12 * sum(n > 0 for n in seen.values())


def test_rising_queries_select_once_for_a_shared_high_part(monkeypatch):
    rng = np.random.default_rng(5)
    values = np.sort(rng.integers(0, 50_000, 4_000))
    n, bits, low, high, ones = L.Monotone.arrays(values)
    held = L.Monotone(n, bits, low, high, ones)
    asked = []
    select = L._select
    monkeypatch.setattr(L, "_select", lambda words, k: asked.append(len(k)) or select(words, k))
    for queries in (np.arange(0, 50_200), rng.integers(0, 50_200, 5_000), values[:0]):
        asked.clear()
        place, found = held.successor(queries)
        assert (place == np.searchsorted(values, queries)).all()
        assert (found == np.isin(queries, values)).all()
        if len(queries) > 5_000:  # rising: one select for each high part, not two for each query
            assert sum(asked) <= (int(queries[-1]) >> bits) + 2
    every = np.arange(n)
    assert (held[every] == values).all()


def test_select_finds_every_one_of_a_word():
    rng = np.random.default_rng(6)
    words = np.concatenate([rng.integers(0, 2**64, 200, dtype=np.uint64), np.array([1, 1 << 63, 2**64 - 1], np.uint64)])
    for w in words.tolist():
        places = [i for i in range(64) if w >> i & 1]
        got = L._select(np.full(len(places), w, np.uint64), np.arange(len(places)))
        assert got.tolist() == places
