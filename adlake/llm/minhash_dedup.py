"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its
minimum and its maximum, so half as many hash evaluations make a signature;
both are unbiased matches of the Jaccard similarity, and together they vary
less than two minima.  Bands of consecutive values propose candidates, full
shingle sets decide.

1. One pass over the texts: shingle hashes, a digest of the whole set, bands.
2. Documents with equal sets form a class; its smallest id stands for it.
3. Representatives that share a band are candidates.  No pair list is made:
   a band group's members go with its smallest one to comparison units of
   bounded size, which compare full sets in memory and return only links
   that join what was apart.  Groups whose members then still belong to more
   than one component are compared whole, in pairs of bounded blocks.  What is
   in one component already needs no comparison, as components are the result.
4. Components over links, moved back to all members of the classes.

Defined results: words are runs of anything but ASCII white space, A-Z
lower-cased; a text with fewer words than a shingle has its whole sequence as
the only shingle; null or wordless texts have an empty set and link with
nothing; rows without an id link with nothing and have no component; rows
with the same id are one document and give one row: it links wherever one of
its texts does, and n_shingles is that of its largest set; input columns beside id and text are not
read, an empty table gives an empty result.  Shingles are compared by 64-bit
hashes; a link at exactly the threshold is missed with probability
(1 - t**ROWS)**bands, at most MISS, and less above it."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import bounded_batches, components, table, written

WORDS = 5
#: Link at 100 * intersection >= PERCENT * union, unless told otherwise.
PERCENT = 85
#: Signature values of a band, half of them minima, half maxima; and bands (of PERCENT).
ROWS = 8
BANDS = 28
#: Greatest share of pairs at exactly the threshold that no band brings together.
MISS = 0.00015
#: Documents of a comparison unit, or of each of the two blocks of one.
UNIT = 128
#: Buckets of the filter before texts move; its broadcast holds a long for each at most.
BUCKETS = 1 << 19
#: Columns of the dense piece of an incidence matrix.
COLUMNS = 4096

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text.  The texts are
    split together and a distinct word is hashed once for all of them."""
    raw = [t.encode("utf-8", "surrogatepass").translate(_FOLD) if t else b"" for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    inside = ~_SPACE[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    place = np.flatnonzero(inside)
    starts = np.flatnonzero(begin[place])
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(place)).astype(np.int64)), pa.py_buffer(data[place])]).dictionary_encode()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in column.dictionary.to_pylist()], np.uint64)
    word = hashes[column.indices.to_numpy()]
    upto = np.searchsorted(place[starts], np.cumsum([len(r) + 1 for r in raw]))
    out, lo = [], 0
    for hi in upto.tolist():
        w = word[lo:hi]
        n = max(1, len(w) - words + 1)
        # The sum's multiplier depends on the place in the shingle, its start on the length.
        sums = np.full(n, min(words, len(w)), np.uint64)
        for k in range(min(words, len(w))):
            sums = sums * _MIX + w[k : k + n]
        out.append(np.unique(_mixed(sums)) if len(w) else np.zeros(0, np.uint64))
        lo = hi
    return out


def permutations(n: int) -> np.ndarray:
    """Odd multipliers; with 64-bit overflow each permutes the hashes."""
    return np.random.default_rng(7).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def bands(sets: list[np.ndarray], rows: int = ROWS, count: int = BANDS) -> np.ndarray:
    """A 64-bit key per set (not empty) and band."""
    flat = np.concatenate(sets)
    first = np.cumsum([0, *(len(s) for s in sets[:-1])])
    keys = np.zeros((len(sets), count), np.uint64)
    for band, factors in enumerate(permutations(count * rows // 2).reshape(count, -1)):
        key = np.full(len(sets), band, np.uint64)
        for f in factors:
            y = flat * f
            for value in (np.minimum.reduceat(y, first), np.maximum.reduceat(y, first)):
                key = _mixed(key * _MIX + value)
        keys[:, band] = key
    return keys.view(np.int64)


def band_count(percent: int) -> int:
    """Bands that a threshold needs for MISS; BANDS at PERCENT."""
    return 1 if percent >= 100 else math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def _sketched(docs: DataFrame, id_col: str, text_col: str, count: int = BANDS) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(b.column(1).to_pylist())
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if full:
                for i, k in zip(full, bands([sets[i] for i in full], count=count).tolist(), strict=True):
                    keys[i] = k
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, shingles): full sets as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in shingle_sets(b.column(1).to_pylist())], pa.binary())], ["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id long, shingles binary")


def links_among(sets: list[np.ndarray], label: np.ndarray, side: np.ndarray | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join labels: a spanning forest of the similar pairs with
    different labels (and on different sides, if given)."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), size)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    common = np.zeros((n, n), np.float64)
    if len(column):
        column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
        cut = np.searchsorted(column, np.arange(0, column[-1] + 1, COLUMNS).tolist() + [column[-1] + 1])
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            piece = np.zeros((n, COLUMNS), np.float32)
            piece[owner[a:b], column[a:b] % COLUMNS] = 1
            common += piece @ piece.T
    union = size[:, None] + size[None, :] - common
    similar = (100 * common >= percent * union) & (label[:, None] != label[None, :])
    if side is not None:
        similar &= side[:, None] != side[None, :]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(similar, 1))), strict=True):
        a, b = root(int(label[i])), root(int(label[j]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def _compared(members: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) found in the units of ``members``: (unit, side, doc_id,
    label); sides null: all pairs, else pairs of different sides."""

    def run(unit: pa.Table) -> pa.Table:
        ids, label = unit["doc_id"].to_numpy(), unit["label"].to_numpy()
        side = None if unit["side"].null_count else unit["side"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in unit["shingles"]]
        at = np.array(links_among(sets, label, side, percent), np.int64).reshape(-1, 2)
        return pa.table({"a": ids[at[:, 0]], "b": ids[at[:, 1]]})

    return members.join(sets, "doc_id").groupBy("unit").applyInArrow(run, "a long, b long")


def _among(ids: DataFrame, source: DataFrame) -> DataFrame:
    """The rows of ``source`` that may be among ``ids``, so that few texts
    move: a filter by a broadcast of at most BUCKETS longs."""
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))
    some = ids.select(bucket.alias("bucket")).distinct()
    return source.join(F.broadcast(some), bucket == F.col("bucket"), "left_semi")


def _first_units(grouped: DataFrame) -> DataFrame:
    """Each member of a band group beside the group's smallest: units of one
    such centre and at most about UNIT members."""
    pairs = grouped.where("doc_id <> centre").select("centre", "doc_id").distinct()
    many = pairs.groupBy("centre").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / UNIT).cast("int")
    members = pairs.join(many, "centre").select("centre", F.pmod(F.xxhash64("doc_id"), parts).cast("long").alias("part"), "doc_id")
    centres = many.select("centre", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long"))).alias("part"), F.col("centre").alias("doc_id"))
    unit = F.struct("centre", "part").alias("unit")
    return members.unionByName(centres).select(unit, F.lit(None).cast("int").alias("side"), "doc_id", F.col("doc_id").alias("label"))


def _open_units(grouped: DataFrame, label: DataFrame) -> DataFrame:
    """Band groups whose members are in more than one component, as pairs of
    blocks of about UNIT members."""
    labelled = grouped.join(label.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
    labelled = written(labelled.select("band", "doc_id", F.coalesce("root", "doc_id").alias("label")), "labelled")
    open_ = labelled.groupBy("band").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    open_ = written(open_.select("band", F.ceil(F.col("n") / UNIT).cast("int").alias("blocks")), "open")
    at = labelled.join(open_, "band").withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    # Block i meets every block: unit (min, max); within one block all pairs.
    spread = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("mine") == F.col("other"), F.lit(None)).otherwise(F.when(F.col("mine") < F.col("other"), 0).otherwise(1))
    unit = F.struct("band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")).alias("unit")
    return spread.select(unit, side.cast("int").alias("side"), "doc_id", "label")


def _same_ids(sketch: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes that hold rows of one id: such rows are one
    document, whatever their texts."""
    held = sketch.where("doc_id is not null").join(classes, "digest").select("doc_id", "first")
    several = held.groupBy("doc_id").agg(F.min("first").alias("a"), F.max("first").alias("last")).where("a <> last")
    return several.select("doc_id", "a").join(held, "doc_id").where("first <> a").select("a", F.col("first").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id
    reachable by links of ``percent`` or more), kept (it is that one)."""
    sketch = written(_sketched(docs, id_col, text_col, band_count(percent)), "sketch")
    classes = written(sketch.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first")), "classes")
    first = sketch.join(classes.select(F.col("first").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi")
    rows = first.select("doc_id", F.posexplode("bands").alias("at", "key")).select(F.xxhash64("at", "key").alias("band"), "doc_id")
    groups = written(rows.groupBy("band").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last")).where("centre <> last").select("band", "centre"), "groups")
    grouped = written(rows.join(groups, "band").distinct(), "grouped")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ids = written(grouped.select("doc_id").distinct(), "candidates")
    sets = written(_sets(_among(ids, source).join(ids, "doc_id", "left_semi")), "sets")
    found = written(_compared(_first_units(grouped), sets, percent).unionByName(_same_ids(sketch, classes)), "links")
    label = components(found, "a", "b")
    more = _compared(_open_units(grouped, label), sets, percent)
    label = components(found.unionByName(more), "a", "b")
    member = sketch.join(classes, "digest", "left").select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("first"))
    out = member.join(label.select(F.col("node").alias("first"), "root"), "first", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("root", "first").alias("component_id"))
    named = out.where("doc_id is not null").groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"))
    unnamed = out.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return named.unionByName(unnamed).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the near duplicates among all documents."""
    bounded_batches(spark)
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)
