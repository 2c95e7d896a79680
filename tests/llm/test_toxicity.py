import random
import zlib

import numpy as np

from adlake.llm import toxicity as X


def test_passages():
    texts = ["one two. two two three! a\nb", "", " .. ", " ".join(f"w{'abcdefgh'[i % 8]}{'xyz'[i % 3]}" for i in range(60)), "x x x x"]
    index, distinct, first, bound = X.passages([X._lower(t) for t in texts], length=25)
    words = [sorted(distinct[i].decode() for i in index[a:b]) for a, b in zip(first, [*first[1:], len(index)])]
    assert words[:4] == [["one", "two"], ["three", "two"], ["a"], ["b"]]
    assert words[-1] == ["x"] and bound.tolist() == [0, 4, 4, 4, 7, 8]


def corpus(n, rng, named=0.9):
    """Insults decide; one group is mostly named beside insults."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    texts, labels = [], []
    for _ in range(n):
        t = [[word() for _ in range(12)] for _ in range(rng.randrange(1, 12))]
        bad = rng.random() < 0.3
        if bad:
            t[rng.randrange(len(t))][3] = rng.choice(["scumbag", "moronic", "vilest"])
        if rng.random() < (named if bad else 0.05):
            t[rng.randrange(len(t))][5] = "muslims"
        texts.append(". ".join(" ".join(x) for x in t))
        labels.append(int(bad))
    return texts, labels


def test_held_out_accuracy_and_neutral_mentions():
    rng = random.Random(1)
    texts, labels = corpus(900, rng)
    more, truth = corpus(300, rng)
    plain, fair = (X.Scorer(X.train(texts, labels, counterfactual=c)) for c in (0.0, 1.0))
    assert np.mean((fair.score(more) >= X.CUT) == np.array(truth)) > 0.97
    groups = ["muslims", "christians", "women", "deaf"]
    spread = [np.ptp([s.word(g.encode()) for g in groups]) for s in (plain, fair)]
    assert spread[1] < 0.3 * spread[0]
    neutral = [f"the {g} went home early that day" for g in groups]
    assert fair.score(neutral).max() < X.CUT
    assert fair.score(["a vilest thing " + "and so on " * 30000, "", None, " "]).tolist()[0] > 0.9


def test_penalty_against_literally_swapped_sentences():
    """Swapping a name in a sentence changes the logit by the difference of
    two word weights, which is what training penalises; the mean squared change
    over all literal swaps falls by far more than it would without."""
    rng = random.Random(2)
    texts, labels = corpus(600, rng)
    logit = lambda s, t: np.log(p := s.score(t)) - np.log(1 - p)
    sentences = [x for t in texts for x in t.split(". ") if "muslims" in x.split(" ")][:150]
    change = {}
    for c in (0.0, 1.0):
        s = X.Scorer(X.train(texts, labels, counterfactual=c))
        base = logit(s, sentences)
        swapped = np.array([logit(s, [x.replace("muslims", n) for x in sentences]) - base for n in X.IDENTITY])
        weights = np.array([s.word(n.encode()) - s.word(b"muslims") for n in X.IDENTITY])
        np.testing.assert_allclose(swapped, np.repeat(weights[:, None], len(sentences), axis=1), atol=1e-6)
        change[c] = (swapped**2).mean()
    assert change[0.0] > 1e-3 and change[1.0] < 0.01 * change[0.0], change


def test_query(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in X.op1_toxicity(spark, d).collect()}
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    assert sorted(got) == sorted(r.doc_id for r in docs)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= X.CUT)
    held = [i for i in labels if got[i].held_out]
    assert np.mean([got[i].predicted == labels[i] for i in held]) > 0.93


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (None, "scum", "x"), (2, "loser", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 1), (9, 0)], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    got = X.score(docs, model).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert X.score(docs.limit(0), X.fit(docs.limit(0), labels.limit(0))).collect() == []
