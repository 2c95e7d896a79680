"""Toxicity by a counterfactually regularised classifier.

A text is a set of passages (sentences, and of long ones pieces of bounded
length); its score is that of its worst passage, so a long clean text does
not drown one insult and does not add up noise.  A passage's logit is the sum
of its words' weights, a word's weight the sum over its hashed features (the
word and its character n-grams).

Training sees labelled texts only: a soft maximum over passages first, the
maximum then.  Wherever a labelled passage names a group of people, the name
is swapped for each other name of the list, and the squared change of the
score is penalised: which group is named must not matter, so neutral mentions
of one that is often insulted are not taken for insults.

Fitting uses a bounded sample of labelled rows (SAMPLE rows of each label, the
smallest hashes of their ids, texts up to SAMPLE_CHARS); scoring covers every
whole text and has no bounds.

Defined results: null or wordless texts get the score of an empty passage;
labels that are null are not used; without any labels every score is 0.5 or
less; repeated labels count once each; other columns are not read."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import bounded_batches, table, tokens

SAMPLE = 1500
SAMPLE_CHARS = 20_000
#: Words of a passage at most.
PASSAGE = 24
GRAMS = (4, 5)
#: Strengths: of the counterfactual penalty, and of the weights' own.
COUNTERFACTUAL, RIDGE = 1.0, 1e-3
#: Of a feature's counts, to be learnt at all: chi-squared with one degree,
#: and how much likelier a toxic text holds it.
SIGNIFICANCE = 16.0
LIFT = 8.0
CUT = 0.3
#: Entries of a worker's word table before it starts over.
TABLE_ENTRIES = 500_000

# Names of groups of people, in the languages of the corpus.
IDENTITY = (
    "women men girls boys muslims christians jews hindus buddhists atheists catholics protestants gays lesbians homosexuals heterosexuals transgender bisexuals blacks whites asians africans europeans americans arabs latinos immigrants refugees foreigners disabled deaf blind elderly youths "
    "frauen männer muslime christen juden schwule lesben schwarze weiße ausländer flüchtlinge behinderte "
    "femmes hommes musulmans chrétiens juifs noirs blancs étrangers réfugiés handicapés "
    "mujeres hombres musulmanes cristianos judíos negros blancos extranjeros refugiados"
).split()

_MEMBERS = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])
_ENDS = np.array([chr(c) in ".!?\n" for c in range(256)])


def features(word: bytes) -> list[int]:
    """Hashes of the word and of its n-grams, its ends marked; a multiset."""
    w = b"^" + word + b"$"
    return [crc32(w)] + [crc32(w[i : i + n]) for n in GRAMS for i in range(len(w) - n + 1)]


def passages(raw: list[bytes], length: int = PASSAGE) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(word numbers by passage, distinct words, where each passage starts in
    the numbers, first passage of each text and the number of all); raw texts
    are lower case."""
    t = tokens(raw, _MEMBERS)
    column = t.column()
    n = len(t.first)
    ends = np.cumsum(_ENDS[t.data])  # sentence marks and text ends up to each byte
    sentence = ends[t.first] if n else np.zeros(0, np.int64)
    new = np.concatenate([[True], sentence[1:] != sentence[:-1]]) if n else np.zeros(0, bool)
    start = np.flatnonzero(new)
    within = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
    opens = within % length == 0
    bound = np.searchsorted(np.flatnonzero(opens), t.bound)
    # A word counts once in a passage, however often it is repeated there.
    many = max(1, len(column.dictionary))
    pairs = np.unique((np.cumsum(opens) - 1) * many + column.indices.to_numpy())
    passage, index = pairs // many, pairs % many
    first = np.flatnonzero(np.diff(passage, prepend=-1))
    return index, column.dictionary.to_pylist(), first, bound


def _lower(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


@dataclass
class Model:
    weights: dict[int, float]  # of features that have one
    bias: float
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


class Scorer:
    """A worker's model with the weights of the words that it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.weights = model.weights
        self.known: dict[bytes, float] = {}

    def word(self, word: bytes) -> float:
        return sum([self.weights.get(i, 0.0) for i in features(word)])

    def score(self, texts: list[str | None]) -> np.ndarray:
        index, distinct, first, bound = passages([_lower(t) for t in texts])
        weight = list(map(self.known.get, distinct))
        for k, w in enumerate(distinct):
            if weight[k] is None:
                weight[k] = self.known[w] = self.word(w)
        if len(self.known) > TABLE_ENTRIES:
            self.known.clear()
        logit = np.full(len(texts), -np.inf)
        some = np.flatnonzero(np.diff(bound))
        if len(some):
            by_passage = np.add.reduceat(np.array(weight)[index], first)
            logit[some] = np.maximum.reduceat(by_passage, bound[some])
        return 1 / (1 + np.exp(-np.clip(np.where(np.isfinite(logit), logit, 0.0) + self.model.bias, -50, 50)))


def _evidence(held: np.ndarray, n: np.ndarray) -> np.ndarray:
    """First weights: of features held oftener by toxic texts, where the
    likelihood ratio statistic of their counts passes SIGNIFICANCE and the
    ratio of the shares passes LIFT, the log of that ratio, dealt over the
    features that a word has."""
    expected = held.sum(0) * (n / n.sum())[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        statistic = 2 * np.nansum(held * np.log(held / expected), axis=0)
    ratio = np.log((held[1] + 0.1) / (n[1] + 0.2)) - np.log((held[0] + 0.1) / (n[0] + 0.2))
    return np.where((statistic > SIGNIFICANCE) & (ratio > np.log(LIFT)), ratio / 8, 0.0)


_SCORERS: dict[str, Scorer] = {}


def scorer(model: Model) -> Scorer:
    """The worker's scorer of this model; one model is kept at a time."""
    if model.name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.name] = Scorer(model)
    return _SCORERS[model.name]


def train(texts: list[str], labels: list[int], counterfactual: float = COUNTERFACTUAL, soft: int = 80, hard: int = 80, rate: float = 0.05) -> Model:
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return Model({}, -1.0 if not len(y) or y.max() == 0 else 1.0)
    index, distinct, first, bound = passages([_lower(t) for t in texts])
    keep = np.flatnonzero(np.diff(bound))
    y, starts = y[keep], bound[keep]
    owner = np.repeat(np.arange(len(keep)), np.diff(bound)[keep])
    number = {w: k for k, w in enumerate(distinct)}
    # Swaps: every name in a labelled passage against every other name.
    names = [n.encode() for n in IDENTITY]
    for n in names:
        if n not in number:
            number[n] = len(distinct)
            distinct.append(n)
    named = np.array([number[n] for n in names])
    seen = np.bincount(index, minlength=len(distinct))[named]
    # Mean over swaps of the squared change is a variance of the names' weights.
    share = seen / max(1, seen.sum())

    each = [features(w) for w in distinct]
    size = np.array([len(f) for f in each])
    hashes, flat = np.unique(np.concatenate([np.array(f, np.int64) for f in each]), return_inverse=True)
    many = len(hashes)
    at = np.cumsum(size) - size
    each = np.split(flat, at[1:])
    word_of = np.repeat(np.arange(len(distinct)), size)
    length = np.diff(np.append(first, len(index)))
    passage_of = np.repeat(np.arange(len(first)), length)
    # Only features that toxic texts hold significantly oftener get a weight.
    by_text = [np.unique(np.concatenate([each[w] for w in np.unique(index[a:b])])) for a, b in zip(np.append(first, len(index))[starts], np.append(first, len(index))[bound[keep + 1]], strict=True)]
    held = np.zeros((2, many))
    for f, t in zip(by_text, y, strict=True):
        held[int(t), f] += 1
    theta = _evidence(held, np.array([(y == 0).sum(), (y == 1).sum()], float))
    active = theta > 0
    bias = float(np.log(y.mean() / (1 - y.mean())))
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    m, v, mb, vb = np.zeros(many), np.zeros(many), 0.0, 0.0
    for step in range(1, soft + hard + 1):
        word = np.add.reduceat(theta[flat], at)
        logit = np.add.reduceat(word[index], first) + bias
        top = np.maximum.reduceat(logit, starts)
        if step <= soft:
            alpha = np.exp(logit - top[owner])
            alpha /= np.add.reduceat(alpha, starts)[owner]
        else:
            alpha = (logit == top[owner]).astype(float)
            alpha /= np.add.reduceat(alpha, starts)[owner]
        pooled = np.add.reduceat(alpha * logit, starts)
        g = balance * (1 / (1 + np.exp(-np.clip(pooled, -50, 50))) - y) / len(y)
        by_passage = alpha * g[owner]
        by_word = np.bincount(index, weights=by_passage[passage_of], minlength=len(distinct))
        if seen.sum() and counterfactual:
            change = word[named] - word[named].mean()
            np.add.at(by_word, named, 2 * counterfactual * (share + 1 / len(named)) * change)
        grad = np.where(active, np.bincount(flat, weights=by_word[word_of], minlength=many) + RIDGE * theta, 0.0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        gb = float(g.sum())
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    some = np.flatnonzero(theta)
    return Model(dict(zip(hashes[some].tolist(), theta[some].tolist(), strict=True)), bias)


def held_out(id_: F.Column) -> F.Column:
    return F.crc32(id_.cast("string")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Train on at most ``sample`` labelled texts of each label that are not
    held out; ids deal rows out and are no input of the score."""
    known = labels.where(F.col(label_col).isNotNull() & ~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).distinct()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    # The rows are chosen by id before texts move: twice the bound, as some are too long.
    ids = known.where("y = 1").orderBy(F.xxhash64("id")).limit(2 * sample).unionByName(known.where("y = 0").orderBy(F.xxhash64("id")).limit(2 * sample))
    chosen = rows.join(F.broadcast(ids), "id")  # at most 4 * sample ids
    got = [r for y in (0, 1) for r in chosen.where(F.col("y") == y).orderBy(F.xxhash64("id"), "text").limit(sample).collect()]
    return train([r.text for r in got], [r.y for r in got])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # no more than the sample's features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = scorer(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(mine.score(b.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every whole text, with the held-out quarter marked."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


__all__ = ["Model", "Scorer", "fit", "held_out", "op1_toxicity", "passages", "score", "train"]
