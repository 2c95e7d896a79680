"""Quality from overlapping heuristic labellers.

1. Each labeller looks at a whole text and says good, bad or nothing.
2. Expectation-maximisation estimates, without any label, how often each
   labeller speaks and errs on good and on bad texts, and the share of good
   ones.  It runs on how many texts have each pattern of votes: counts over
   the whole corpus, at most 3 ** labellers rows.
3. A linear scorer on hashed token shapes ("Aa,", "a###", a repeated token)
   is trained on the posteriors, with a bounded sample of texts (SAMPLE, the
   smallest hashes of their texts); it scores every whole text.

The scorer sees shapes that no labeller counts, so it also decides on texts
on which the labellers are silent or split.

Defined results: null or blank texts are rejected with score 0; ties of the
posterior (no labeller spoke anywhere) accept; repeated rows are scored each;
other columns stay, those named like an output are replaced; an empty table
gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.llm.common import bounded_batches, table, tokens, written

#: Texts that the scorer is trained on, at most; longer ones than SAMPLE_CHARS are not taken.
SAMPLE = 4000
SAMPLE_CHARS = 20_000
#: Texts whose tokens are held at once, in a task and in the driver.
TEXTS = 64
#: Hashed shape features.
DIMENSIONS = 1 << 14
ACCEPT = 0.2

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Byte kinds of a shape: upper, lower (and all beyond ASCII), digit, else the byte itself.
_KIND = np.array([ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c >= 128 else ord("0") if 48 <= c <= 57 else c for c in range(256)], np.uint8)
_ODD = np.array([c < 128 and not chr(c).isalnum() and chr(c) not in " \t\n\r\v\f.,;:'\"-()?" for c in range(256)])
_UPPER = np.array([65 <= c <= 90 for c in range(256)])
_LETTER = np.array([chr(c).isalpha() and c < 128 for c in range(256)])
_STOP = np.array([chr(c) in ".?!" for c in range(256)])

STATISTICS = ("words", "odd", "upper", "repeat", "same", "bars", "marks", "plain")


def slices(texts: list, at_once: int = TEXTS) -> Iterator[list]:
    return (texts[i : i + at_once] for i in range(0, len(texts), at_once))


@dataclass
class Shapes:
    """Statistics of texts, and their hashed shape features: text, feature."""

    statistics: np.ndarray
    owner: np.ndarray
    feature: np.ndarray


def shapes(texts: list[str | None]) -> Shapes:
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    t = tokens(raw, ~_SPACE)
    n = np.diff(t.bound)
    owner = np.repeat(np.arange(len(texts)), n)
    stats = np.zeros((len(texts), len(STATISTICS)))
    stats[:, 0] = n
    if not len(owner):
        return Shapes(stats, owner, owner)
    some = np.maximum(n, 1)
    ends = np.cumsum([len(r) + 1 for r in raw])

    def share(flags: np.ndarray, by: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])[np.concatenate([[0], ends])]
        return np.diff(total) / np.maximum(by, 1)

    stats[:, 1] = share(_ODD[t.data], n)
    letters = np.diff(np.concatenate([[0], np.cumsum(_LETTER[t.data])])[np.concatenate([[0], ends])])
    stats[:, 2] = share(_UPPER[t.data], letters)
    word = t.column().indices.to_numpy()
    again = np.concatenate([[False], (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])])
    stats[:, 3] = np.bincount(owner, weights=again, minlength=len(texts)) / some
    pairs = np.unique(owner * (int(word.max()) + 1) + word) // (int(word.max()) + 1)
    stats[:, 4] = np.bincount(pairs, minlength=len(texts)) / some  # distinct words
    size = t.last - t.first
    bar = (size == 1) & np.isin(t.data[t.first], [ord(c) for c in "|/\\>*#-=_"])
    stats[:, 5] = np.bincount(owner, weights=bar, minlength=len(texts)) / some
    stats[:, 6] = share(_STOP[t.data], n)

    strange = np.concatenate([[0], np.cumsum(_ODD[t.data])])
    small = np.concatenate([[0], np.cumsum(_LETTER[t.data] & ~_UPPER[t.data] | (t.data >= 128))])
    plain = (strange[t.last] == strange[t.first]) & ((small[t.last] > small[t.first]) | (size < 2)) & ~again
    stats[:, 7] = np.bincount(owner, weights=plain, minlength=len(texts)) / some

    # Shapes: runs of one kind become one byte.
    kinds = _KIND[t.data]
    held = t.inside & np.concatenate([[True], (kinds[1:] != kinds[:-1]) | ~t.inside[:-1]])
    upto = np.concatenate([[0], np.cumsum(held)])
    bounds = np.append(upto[t.first], upto[-1])
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(t.first), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(kinds[held])]).dictionary_encode()
    code = np.array([crc32(x) for x in column.dictionary.to_pylist()], np.int64)[column.indices.to_numpy()]
    one = code % DIMENSIONS
    before = np.concatenate([[0], np.where(owner[1:] == owner[:-1], code[:-1], 0)])
    two = (code * 31 + before * 17 + 7) % DIMENSIONS
    double = np.full(int(again.sum()), crc32(b"repeated") % DIMENSIONS)
    return Shapes(stats, np.concatenate([owner, owner, owner[again]]), np.concatenate([one, two, double]))


def votes(s: np.ndarray) -> np.ndarray:
    """What each labeller says of each text: 1 good, 0 bad, -1 nothing.  Four
    know one kind of rubbish each and never praise; three judge the text as a
    whole and overlap with them and with each other."""
    words, odd, upper, repeat, distinct, bars, marks, plain = s.T
    say = lambda bad, good: np.where(bad, 0, np.where(good, 1, -1))
    never = np.zeros(len(s), bool)
    return np.stack(
        [
            say(odd > 0.3, never),
            say(upper > 0.4, never),
            say(repeat > 0.1, never),
            say(bars > 0.08, never),
            say(plain < 0.75, plain > 0.9),
            say((odd > 0.2) | (upper > 0.3) | (bars > 0.05) | (repeat > 0.08) | ((distinct < 0.25) & (words < 400)), (odd < 0.1) & (upper < 0.2) & (bars < 0.01) & (repeat < 0.04)),
            say((marks > 0.6) | (marks < 0.005) & (words > 60), (marks > 0.01) & (marks < 0.35) & (odd < 0.15) & (repeat < 0.1)),
        ],
        axis=1,
    ).astype(np.int8)


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good by pattern, P(vote | class) as [class, labeller,
    vote + 1], share of good).  Starts from labellers that are right in most
    of their votes; counts are smoothed, so that no estimate is 0 or 1."""
    m = patterns.shape[1]
    table_ = np.zeros((2, m, 3))
    table_[0], table_[1] = [0.5, 0.4, 0.1], [0.5, 0.1, 0.4]
    share, good = 0.8, np.zeros(len(patterns))
    for _ in range(rounds):
        like = np.stack([np.log(table_[c][np.arange(m), patterns + 1]).sum(1) for c in (0, 1)]) + np.log([[1 - share], [share]])
        good = 1 / (1 + np.exp(np.clip(like[0] - like[1], -500, 500)))
        weight = np.stack([1 - good, good]) * counts
        for c in (0, 1):
            for v in range(3):
                table_[c, :, v] = ((patterns + 1 == v) * weight[c][:, None]).sum(0) + 0.5
            table_[c] /= table_[c].sum(1, keepdims=True)
        share = (weight[1].sum() + 1) / (counts.sum() + 2)
    return good, table_, share


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    accuracy: np.ndarray  # of the labellers: P(vote | class)

    def score(self, texts: list[str | None]) -> np.ndarray:
        return np.concatenate([self._score(part) for part in slices(texts)]) if texts else np.zeros(0)

    def _score(self, texts: list[str | None]) -> np.ndarray:
        s = shapes(texts)
        n = s.statistics[:, 0]
        total = np.bincount(s.owner, weights=self.weights[s.feature], minlength=len(texts))
        out = 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + self.bias, -50, 50)))
        return np.where(n > 0, out, 0.0)


def features(texts: list[str], at_once: int = TEXTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, share of the text's tokens), in order of both."""
    parts, first = [], 0
    for some in slices(texts, at_once):
        s = shapes(some)
        key, count = np.unique(s.owner * DIMENSIONS + s.feature, return_counts=True)
        row = key // DIMENSIONS
        parts.append((row + first, key % DIMENSIONS, count / np.maximum(s.statistics[:, 0], 1)[row]))
        first += len(some)
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def train(texts: list[str], posterior: np.ndarray, accuracy: np.ndarray, steps: int = 300, rate: float = 0.1, ridge: float = 1e-5) -> Model:
    """Logistic regression on soft labels; features are shares of tokens."""
    weights, bias = np.zeros(DIMENSIONS), 0.0
    if texts:
        row, col, x = features(texts)
        share = min(max(float(posterior.mean()), 1e-3), 1 - 1e-3)
        balance = posterior * 0.5 / share + (1 - posterior) * 0.5 / (1 - share)
        m, v, mb, vb = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), 0.0, 0.0
        for step in range(1, steps + 1):
            z = np.bincount(row, weights=x * weights[col], minlength=len(texts)) + bias
            g = balance * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - posterior) / len(texts)
            grad = np.bincount(col, weights=x * g[row], minlength=DIMENSIONS) + ridge * weights
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            weights -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            gb = float(g.sum())
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    return Model(weights, bias, accuracy)


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Model:
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            said = votes(np.concatenate([shapes(part).statistics for part in slices(b.column(0).to_pylist())]))
            code = ((said.astype(np.int64) + 1) * 3 ** np.arange(said.shape[1])).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array([int(x) for x in b.column(1).to_pylist()], pa.int64())], ["pattern", "hash"])

    source = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash")).where("trim(text) <> ''")
    voted = written(source.mapInArrow(vote, "pattern long, hash long"), "votes")
    rows = voted.groupBy("pattern").count().orderBy("pattern").collect()  # 3 ** labellers at most
    m = votes(np.zeros((1, len(STATISTICS)))).shape[1]
    code = np.array([r["pattern"] for r in rows], np.int64)
    patterns = (code[:, None] // 3 ** np.arange(m)) % 3 - 1
    good, accuracy, _ = expectation_maximisation(patterns, np.array([r["count"] for r in rows], float))
    posterior = dict(zip(code.tolist(), good.tolist(), strict=True))
    # The sample is chosen by hash before texts move.
    chosen = voted.select("hash", "pattern").distinct().orderBy("hash").limit(sample)
    texts = source.where(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(chosen), "hash").dropDuplicates(["hash"]).orderBy("hash").collect()
    return train([r.text for r in texts], np.array([posterior[r.pattern] for r in texts]), accuracy)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with quality (0 to 1) and accepted."""
    docs = docs.drop("quality", "accepted")
    names = docs.columns
    at, shared = names.index(text_col), docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = shared.value.score(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(q), pa.array(q >= ACCEPT)], [*names, "quality", "accepted"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("quality", T.DoubleType()), T.StructField("accepted", T.BooleanType())]))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt without labels."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs)).drop("text")
