import math

import numpy as np

from adlake.llm import embed_dedup as E


def brute(rows, threshold=0.93):
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = (np.array(v, float) / np.linalg.norm(np.array(v, float)), label)
    links = {i: set() for i, _, _ in rows}
    ids = sorted(good)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            (u, x), (w, y) = good[a], good[b]
            if x == y and len(u) == len(w) and float(u @ w) >= threshold:
                links[a].add(b)
                links[b].add(a)
    root = {}
    for i in sorted(links, key=lambda x: (x is None, x)):
        if i in root:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = i
                todo += links[x]
    return {i: (len(links[i]), root[i], root[i] == i) for i in links}


def check(spark, rows, **how):
    df = spark.createDataFrame([(i, v, la, "x") for i, v, la in rows], "vec_id long, embedding array<float>, label int, first string")
    got = E.near_duplicates(df, **how).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute(rows)
    assert len(got) == len({i for i, _, _ in rows})


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[rng.integers(12)] + rng.normal(size=16) * rng.choice([0.1, 0.25, 0.4])).astype(np.float32).tolist(), int(rng.integers(3))) for i in range(400)]
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(150)] + [(1000, rows[0][1], rows[0][2])]
    rows += [(2000, [2 * x for x in rows[0][1]], rows[0][2]), (2001, None, 1), (2002, [0.0] * 16, 1), (2003, [None] + [1.0] * 15, 1), (2004, [float("nan")] + [1.0] * 15, 1), (2005, [float("inf")] + [1.0] * 15, 1), (2006, rows[0][1], None), (2007, [1.0, 2.0], 1), (2008, [1.0, 2.0], 1), (2009, [], 1), (None, rows[0][1], rows[0][2])]
    check(spark, rows, block=32, dimensions=3)


def test_far_blocks_are_skipped(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(size=(64, 8)) * 0.01 + np.eye(8)[k] for k in range(8)])
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id long, vector array<double>, label int")
    classes = df.select("label", df.vec_id.alias("first"), E.F.lit(1).cast("long").alias("n"), "vector")
    bound = math.sqrt(2 - 2 * E.THRESHOLD)
    blocks = E._blocks(classes, {8: E._axes(classes, 8, 7)}, bound, 16)
    boxes = E.written(blocks.select("label", "dim", "lo", "hi", (E.F.row_number().over(E.W.partitionBy("label").orderBy("part", "seq")) - 1).cast("long").alias("rank")), "boxes")
    n = boxes.count()
    assert E._interval_pairs(boxes, bound).count() < n * (n + 1) // 2 / 2


def test_query_against_brute_force(spark, sf001):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf001}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.op5_embedding_dedup(spark, sf001).collect()}
    assert got == brute(rows)


def test_empty_table(spark):
    assert E.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_rows_of_one_id_are_one_vector(spark):
    u, v = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, v, 0), (2, v, 0), (2, u, 0), (3, [0.99, 0.05, 0.0], 0), (4, u, 1), (4, None, 0)]
    got = E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.component_id, r.kept) for r in got) == [(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)]
