"""Near-duplicate embeddings by an epsilon grid order join.

Cosine at or above a threshold is a bound on the distance of unit vectors,
and distances can only shrink when projected on a few principal dimensions.
Unit vectors are put in the order of their grid cells on the leading
principal dimensions (cell side: the distance bound) and cut into blocks of
that sequence.  The join starts with the whole sequence of a label against
itself and halves both intervals again and again; a pair of intervals whose
bounding boxes lie further apart than the bound is dropped.  What is left are
pairs of blocks, which are compared exactly, in double precision.

Equal vectors are one class before the join, so a very common vector costs a
single row there.  A pair of blocks returns link counts per vector and only
those links that join what was apart: no pair list is made.

Defined results: only vectors with equal labels (and as many components) are
compared; a null label or vector, a null or non-finite component or a zero
vector links with nothing; rows with the same id are one vector, linked
wherever one of them is, with the most n_links that one of them has; a null id
has no component; other input columns are not read."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlake.llm.common import bounded_batches, components, table, written

THRESHOLD = 0.93
#: Leading principal dimensions of the grid and of the bounding boxes.
DIMENSIONS = 12
#: Vectors of a block.
BLOCK = 512


def _units(rows: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that no square vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _axes(vectors: DataFrame, dim: int, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading principal axes of unit vectors with ``dim`` components:
    each task returns one sum of products (dim * dim numbers)."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            if b.num_rows:
                u = _units(_matrix(b.column(0)))
                n, first, second = n + len(u), first + u.sum(0), second + u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([[*first, *second.ravel()]], pa.list_(pa.float64()))], ["n", "sums"])

    parts = vectors.where(F.size("vector") == dim).select("vector").mapInArrow(moments, "n long, sums array<double>")
    # Summed by place before it is collected: dim + dim * dim numbers, however many tasks there are.
    total = parts.select("n", F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).orderBy("at").collect()
    n, sums = total[0]["n"], np.array([r["x"] for r in total])
    mean = sums[:dim] / n
    spread = sums[dim:].reshape(dim, dim) / n - np.outer(mean, mean)
    return mean, np.linalg.eigh(spread)[1][:, ::-1][:, :keep]


def _blocks(classes: DataFrame, axes: dict[int, tuple[np.ndarray, np.ndarray]], side: float, size: int) -> DataFrame:
    """The classes in epsilon grid order, a row per block."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells, points, units = [], [], []
            for v in b.column(3).to_pylist():
                u = _units(np.array([v], np.float64))
                mean, axis = axes[len(v)]
                p = ((u - mean) @ axis)[0]
                cells.append(np.floor(p / side).astype(np.int64).tolist())
                points.append(p.tolist())
                units.append(u.tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([len(v) for v in b.column(3).to_pylist()], pa.int32()), pa.array(cells, pa.list_(pa.int64())), pa.array(points, pa.list_(pa.float64())), pa.array(units, pa.binary())], ["label", "first", "n", "dim", "cell", "point", "unit"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, []

        def block() -> pa.RecordBatch:
            points = np.array([r["point"] for r in held])
            row = {
                "label": pa.array([held[0]["label"]], b.schema.field("label").type),
                "dim": pa.array([held[0]["dim"]], pa.int32()),
                "part": pa.array([part], pa.int32()),
                "seq": pa.array([seq], pa.int32()),
                "lo": pa.array([points.min(0).tolist()], pa.list_(pa.float64())),
                "hi": pa.array([points.max(0).tolist()], pa.list_(pa.float64())),
                "firsts": pa.array([[r["first"] for r in held]], pa.list_(pa.int64())),
                "ns": pa.array([[r["n"] for r in held]], pa.list_(pa.int64())),
                "units": pa.array([b"".join(r["unit"] for r in held)], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(list(row.values()), list(row))

        for b in batches:
            for r in b.to_pylist():
                if held and (len(held) == size or (r["label"], r["dim"]) != (held[0]["label"], held[0]["dim"])):
                    yield block()
                    seq, held = seq + 1, []
                held.append(r)
        if held:
            yield block()

    kind = classes.schema["label"].dataType.simpleString()
    placed = classes.select("label", "first", "n", "vector").mapInArrow(place, f"label {kind}, first long, n long, dim int, cell array<long>, point array<double>, unit binary")
    order = ["label", "dim", "cell", "first"]
    # Written first: the sampling of the ranges would compute it again.
    placed = written(placed, "placed").repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.mapInArrow(cut, f"label {kind}, dim int, part int, seq int, lo array<double>, hi array<double>, firsts array<long>, ns array<long>, units binary")


def _near(a: str, b: str, bound: float) -> F.Column:
    """The boxes of a and b are within the bound of each other."""
    gap = F.transform(F.arrays_zip(F.col(f"{a}.lo").alias("al"), F.col(f"{a}.hi").alias("ah"), F.col(f"{b}.lo").alias("bl"), F.col(f"{b}.hi").alias("bh")), lambda x: F.greatest(F.lit(0.0), x["al"] - x["bh"], x["bl"] - x["ah"]))
    return F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g) <= bound * bound + 1e-9


def _interval_pairs(boxes: DataFrame, bound: float) -> DataFrame:
    """(label, dim, i, j), i <= j: numbers of blocks that may hold links."""
    depth = max(0, math.ceil(math.log2((boxes.agg(F.max("rank")).first()[0] or 0) + 1)))
    key = ["label", "dim"]
    pairs = None
    for level in range(depth, -1, -1):
        width = F.lit(1 << level).cast("long")
        at = boxes.select(*key, F.floor(F.col("rank") / width).cast("long").alias("node"), F.posexplode(F.arrays_zip("lo", "hi")).alias("axis", "span"))
        at = at.groupBy(*key, "node", "axis").agg(F.min("span.lo").alias("lo"), F.max("span.hi").alias("hi"))
        at = at.groupBy(*key, "node").agg(F.array_sort(F.collect_list(F.struct("axis", "lo", "hi"))).alias("s"))
        at = at.select(*key, "node", F.struct(F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi")).alias("box"))
        if pairs is None:
            pairs = at.select(*key, F.col("node").alias("i"), F.col("node").alias("j"))
        else:
            halves = F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))
            pairs = pairs.select(*key, "i", "j", F.explode(halves).alias("x")).select(*key, "i", "j", "x", F.explode(halves).alias("y"))
            pairs = pairs.select(*key, (2 * F.col("i") + F.col("x")).alias("i"), (2 * F.col("j") + F.col("y")).alias("j")).where("i <= j")
            pairs = pairs.join(at.select(*key, F.col("node").alias("i"), F.col("box").alias("a")), [*key, "i"])
            pairs = pairs.join(at.select(*key, F.col("node").alias("j"), F.col("box").alias("b")), [*key, "j"])
            pairs = pairs.where(_near("a", "b", bound)).select(*key, "i", "j")
        pairs = written(pairs, "intervals")
    return pairs


def links_between(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of unit vectors have at least that cosine; products within
    rounding of the threshold are summed anew without error."""
    cosine = left @ right.T
    found = cosine >= threshold
    for i, j in zip(*(x.tolist() for x in np.nonzero(np.abs(cosine - threshold) < 1e-12)), strict=True):
        found[i, j] = math.fsum((left[i] * right[j]).tolist()) >= threshold
    return found


def _compared(pairs: DataFrame, threshold: float) -> DataFrame:
    """(first, more, other): links that a pair of blocks adds to a class, and
    the spanning links with ``other``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a, b = np.array(r["a_firsts"]), np.array(r["b_firsts"])
                found = links_between(np.frombuffer(r["a_units"]).reshape(len(a), -1), np.frombuffer(r["b_units"]).reshape(len(b), -1), threshold)
                same = r["i"] == r["j"]
                if same:
                    np.fill_diagonal(found, False)
                rows = [(a, found @ np.array(r["b_ns"]))] + ([] if same else [(b, found.T @ np.array(r["a_ns"]))])
                first = np.concatenate([x[n > 0] for x, n in rows])
                more = np.concatenate([n[n > 0] for _, n in rows])
                forest = _forest(a, b, found)
                yield pa.RecordBatch.from_arrays([pa.array([*first.tolist(), *(x for x, _ in forest)], pa.int64()), pa.array([*more.tolist(), *(0 for _ in forest)], pa.int64()), pa.array([*(None for _ in first), *(y for _, y in forest)], pa.int64())], ["first", "more", "other"])

    return pairs.mapInArrow(run, "first long, more long, other long")


def _forest(a: np.ndarray, b: np.ndarray, found: np.ndarray) -> list[tuple[int, int]]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(found)), strict=True):
        x, y = root(int(a[i])), root(int(b[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(a[i]), int(b[j])))
    return out


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, dimensions: int = DIMENSIONS, block: int = BLOCK) -> DataFrame:
    """One row per vector: id, n_links (other vectors linked directly),
    component_id (smallest id reachable), kept (it is that one)."""
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    classes = written(source.where(sound).groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count_distinct("vec_id").alias("n")), "classes")
    dims = [r[0] for r in classes.select(F.size("vector")).distinct().collect()]  # lengths of vectors: one, as a rule
    member = source.where(sound).join(classes, ["label", "vector"]).select("vec_id", "first", "n").unionByName(source.where(~sound).select("vec_id", F.col("vec_id").alias("first"), F.lit(1).cast("long").alias("n")))
    bound = math.sqrt(2 - 2 * threshold)
    axes = {d: _axes(classes, d, min(d, dimensions)) for d in dims}
    blocks = written(_blocks(classes, axes, bound, block), "blocks")
    # One row per block: few beside the vectors.
    numbered = blocks.select("label", "dim", "part", "seq", "lo", "hi", (F.row_number().over(W.partitionBy("label", "dim").orderBy("part", "seq")) - 1).cast("long").alias("rank"))
    numbered = written(numbered, "boxes")
    pairs = _interval_pairs(numbered.select("label", "dim", "rank", "lo", "hi"), bound)
    full = blocks.join(numbered.select("label", "dim", "part", "seq", "rank"), ["label", "dim", "part", "seq"])
    full = written(full.select("label", "dim", "rank", "firsts", "ns", "units"), "blocks")
    side = lambda at, x: full.select("label", "dim", F.col("rank").alias(at), *(F.col(c).alias(f"{x}_{c}") for c in ("firsts", "ns", "units")))
    bounded_batches(vectors.sparkSession, 4)  # a row is a pair of blocks
    joined = pairs.join(side("i", "a"), ["label", "dim", "i"]).join(side("j", "b"), ["label", "dim", "j"])
    found = written(_compared(joined.select("i", "j", "a_firsts", "a_ns", "a_units", "b_firsts", "b_ns", "b_units"), threshold), "links")
    more = found.where("more > 0").groupBy("first").agg(F.sum("more").alias("more"))
    # Rows of one id are one vector: their classes belong together.
    several = member.groupBy("vec_id").agg(F.min("first").alias("a"), F.max("first").alias("last")).where("a <> last").select("vec_id", "a")
    same = several.join(member, "vec_id").where("first <> a").select("a", F.col("first").alias("b"))
    label = components(found.where("other is not null").select(F.col("first").alias("a"), F.col("other").alias("b")).unionByName(same), "a", "b")
    known = written(more.join(label.select(F.col("node").alias("first"), "root"), "first", "full"), "known")
    out = member.join(known, "first", "left").select("vec_id", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).cast("long").alias("n_links"), F.coalesce("root", "first").alias("component_id"))
    out = out.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components among all embeddings of a label."""
    bounded_batches(spark)
    return near_duplicates(table(spark, sf_dir, "embeddings"))
