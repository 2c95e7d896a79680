import numpy as np

from adlake.llm import quality as Q


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    y = (rng.random(20000) < 0.7).astype(int)
    right = np.array([0.9, 0.8, 0.7, 0.85])
    v = np.where(rng.random((20000, 4)) < right, y[:, None], 1 - y[:, None])
    v[rng.random(v.shape) < 0.2] = -1
    patterns, inverse, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    good, table, share = Q.expectation_maximisation(patterns, counts.astype(float))
    assert abs(share - 0.7) < 0.03
    assert np.abs(table[1, :, 2] / (table[1, :, 1] + table[1, :, 2]) - right).max() < 0.04
    majority = np.mean((np.where(v < 0, 0, 2 * v - 1).sum(1) > 0) == y)
    assert np.mean((good[inverse.ravel()] >= 0.5) == y) >= majority


def test_statistics():
    s = Q.shapes(["Aa bb bb. ###", None, "", "| x | ABC", "x"])
    assert s.statistics[:, 0].tolist() == [4, 0, 0, 4, 1]
    assert s.statistics[0, 3] == 0 and s.statistics[0, 4] == 1 and s.statistics[3, 5] == 0.5
    assert Q.shapes(["go go go go"]).statistics[0, 3] == 0.75
    assert (Q.shapes([None, ""]).statistics == 0).all()


def test_query_against_labels(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in Q.op2_quality(spark, d).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert np.mean([got[i].accepted == bool(y) for i, y in labels.items()]) > 0.98
    assert np.mean([got[i].accepted for i, y in labels.items() if y]) > 0.98


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (2, "  ", "x"), (3, "A plain sentence, as it were. And one more.", "x"), (4, "#### " * 60000, "x")], "doc_id long, text string, quality string")
    got = {(r.doc_id, r.text and r.text[:3]): r.accepted for r in Q.score(df, Q.fit(df)).collect()}
    assert not got[1, None] and not got[1, ""] and not got[2, "  "] and len(got) == 5
    assert Q.score(df.limit(0), Q.fit(df.limit(0))).collect() == []


def test_training_holds_few_texts_at_once(monkeypatch):
    """The driver trains on shares of features that it makes of a few texts at
    a time; cutting the texts changes no number."""
    import numpy as np

    from adlake.llm import quality

    texts = [f"Word{i} aa, bb bb {i * 7} " * (1 + i % 5) for i in range(300)]
    posterior = np.linspace(0, 1, len(texts))
    held, shapes = [], quality.shapes
    monkeypatch.setattr(quality, "shapes", lambda t: held.append(len(t)) or shapes(t))
    model = quality.train(texts, posterior, None)
    assert sum(held) == len(texts) and max(held) <= quality.TEXTS
    for one, cut in zip(quality.features(texts, len(texts)), quality.features(texts, 7), strict=True):
        assert one.tolist() == cut.tolist()
    assert model.weights.any()
    held.clear()
    whole = model._score(texts)
    assert model.score(texts).tolist() == whole.tolist() and held[0] == 300 and max(held[1:]) <= quality.TEXTS
