"""Filter interaction audit by a Gray-code walk over filter subsets.

Each document fails some of five filters: a mask of five bits.  Documents are
counted per part and mask, with the good and the toxic ones among them, so a
part is at most 32 cells.  A walk in Gray-code order visits all 32 subsets of
filters and toggles one filter at a time: every cell keeps a counter of the
active filters that it fails, and the running survivors change only by cells
whose counter leaves or reaches zero.  The 32 states are stored; every step of
every order of the filters is a difference of two of them.

Filters (the letter is where a document fails): A under 200 words; B fewer
distinct words than half of all; C more than 3 in 100 code points are A-Z;
D holds one of # $ % & * |; E the text of a smaller doc_id.  Words are runs of
other than ASCII white space.

Defined results: a null text is empty; a null part is the part ''; each row
counts, repeated ones too; rows without an id are nobody's copy and have no
copies, and no labels; a document is good (toxic) if any row of labels for its
id says so.  An empty table has no rows.  Other columns are not read."""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import bounded_batches, table, written

FILTERS = "ABCDE"
MIN_WORDS = 200
MARKS = b"#$%&*|"
#: Bytes of a character after its first.
CONTINUED = bytes(range(0x80, 0xC0))
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ROW = "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_mask(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = raw.split()  # bytes split at exactly the six ASCII white space marks
    points = len(raw.translate(None, CONTINUED))
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    marks = len(raw) - len(raw.translate(None, MARKS))
    fails = (len(words) < MIN_WORDS, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 3 * points, marks > 0)
    return sum(1 << k for k, f in enumerate(fails) if f)


def _facts(docs: DataFrame) -> DataFrame:
    """A narrow row per document: id, part, mask of A to D, digest of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [t or b"" for t in b.column(2).cast(pa.large_binary()).to_pylist()]
            masks = pa.array([text_mask(t) for t in raw], pa.int32())
            digests = pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), masks, digests], ["doc_id", "part", "mask", "digest"])

    return docs.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def _cells(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask of five bits, n, good, toxic).  Copies are found by the
    smallest id of each text, joined on id and text together: no key is hot."""
    named = facts.where("doc_id is not null").groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    first = facts.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("q"), (F.col("toxic") == 1).alias("t")).where("doc_id is not null and (q or t)")
    marked = marked.groupBy("doc_id").agg(F.coalesce(F.max("q"), F.lit(False)).alias("q"), F.coalesce(F.max("t"), F.lit(False)).alias("t"))
    named = named.join(first, ["doc_id", "digest"], "left").join(marked, "doc_id", "left")
    copy: Column = F.when(F.col("is_first"), 0).otherwise(1 << FILTERS.index("E"))
    count = lambda c: F.when(F.coalesce(F.col(c), F.lit(False)), F.col("n")).otherwise(0)
    known = named.select("part", F.col("mask").bitwiseOR(copy).alias("mask"), "n", count("q").alias("good"), count("t").alias("toxic"))
    zero = F.lit(0).cast("long")
    unnamed = facts.where("doc_id is null").select("part", "mask", F.lit(1).cast("long").alias("n"), zero.alias("good"), zero.alias("toxic"))
    return known.unionByName(unnamed).groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))


def subset_states(cells: dict[int, np.ndarray], filters: int) -> np.ndarray:
    """Counts of the survivors of each of the 2^filters subsets, by a walk
    that toggles one filter at a time."""
    masks = np.array(sorted(cells), np.int64)
    counts = np.array([cells[m] for m in masks.tolist()], object).reshape(len(masks), -1)
    failing = np.zeros(len(masks), np.int64)  # of each cell, active filters that it fails
    alive = counts.sum(axis=0)
    states = np.empty((1 << filters, counts.shape[1]), object)
    subset = 0
    states[subset] = alive
    for step in range(1, 1 << filters):
        bit = (step & -step).bit_length() - 1  # which bit a Gray code changes here
        fails = masks >> bit & 1 == 1
        subset ^= 1 << bit
        if subset >> bit & 1:
            alive = alive - counts[fails & (failing == 0)].sum(axis=0)
            failing[fails] += 1
        else:
            failing[fails] -= 1
            alive = alive + counts[fails & (failing == 0)].sum(axis=0)
        states[subset] = alive
    return states


def steps(cells: dict[int, np.ndarray], filters: str = FILTERS) -> list[tuple]:
    """Rows of every step of every order: differences of subset states."""
    states, size = subset_states(cells, len(filters)), len(filters)
    full, orders = (1 << size) - 1, math.factorial(size)
    removed = lambda s, k: states[s] - states[s | 1 << k]
    # A subset of s filters precedes filter k in s! (size - 1 - s)! orders.
    weight = [math.factorial(s) * math.factorial(size - 1 - s) for s in range(size)]
    shapley = [sum(weight[s.bit_count()] * removed(s, k)[0] for s in range(full + 1) if not s >> k & 1) for k in range(size)]
    assert sum(shapley) == orders * removed_in_all(states)
    rows = []
    for order in itertools.permutations(range(size)):
        before = 0
        for step, k in enumerate(order, 1):
            gone = removed(before, k)
            before |= 1 << k
            fails = removed(0, k)[0]
            rows.append(("".join(filters[x] for x in order), step, filters[k], states[before][0], gone[0], fails - gone[0], removed(full ^ 1 << k, k)[0], gone[1], gone[2], shapley[k]))
    return rows


def removed_in_all(states: np.ndarray) -> int:
    return states[0][0] - states[-1][0]


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """600 rows (120 orders of five steps) for each part of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    cells = _cells(written(_facts(docs), "audit-facts"), labels)
    # At most 32 cells a part.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in ROW.split(", ")]
        kinds = [{"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[f.split()[1]] for f in ROW.split(", ")]
        for b in batches:
            for part, held in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = [(part, *r) for r in steps({c["mask"]: (c["n"], c["good"], c["toxic"]) for c in held})]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return parts.mapInArrow(run, ROW)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in all their orders, per language."""
    bounded_batches(spark)
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
