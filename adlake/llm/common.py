"""Helpers that the training-data operators share: table access, batch
bounds for Arrow workers, and connected components of an edge table."""

from __future__ import annotations

import functools
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import materialize, scratch_path

#: Rows of one Arrow batch.  Texts are read whole, so a batch is kept short:
#: 256 texts of 100 kB are 25 MB.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound what a Python worker holds at once; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def free_name(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Column names that ``df`` does not have yet, for helper columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return tuple(out)


@functools.cache
def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Rows of a file of narrow rows, about.
FILE_ROWS = 250_000


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write an intermediate table into the shared checkpoint folder and read
    it back: lineage ends here, and a lost executor costs a reread only.
    ``rows``: a bound of its narrow rows, for the number of files."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(1 + rows // FILE_ROWS)
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def consumed(df: DataFrame) -> None:
    """Delete a table that :func:`written` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@dataclass
class Tokens:
    """Tokens of many texts, in order: runs of bytes of a set."""

    data: np.ndarray  # the texts' bytes, joined by line ends
    first: np.ndarray  # of each token, its first byte in data
    last: np.ndarray  # and the byte after it
    bound: np.ndarray  # of each text, its first token; and the number of all
    inside: np.ndarray  # which bytes of data are in tokens

    def column(self, data: np.ndarray | None = None) -> pa.DictionaryArray:
        """The tokens (of ``data``, if given, with the same places) as an
        Arrow dictionary: distinct tokens, and for each token its number."""
        ends = np.concatenate([[0], np.cumsum(self.last - self.first)])
        held = (self.data if data is None else data)[self.inside]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.first), [None, pa.py_buffer(ends), pa.py_buffer(held)]).dictionary_encode()


def tokens(raw: list[bytes], members: np.ndarray) -> Tokens:
    """``members``: for each of the 256 bytes whether tokens hold it (not the
    line end)."""
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    inside = members[data]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    after = np.cumsum([len(r) + 1 for r in raw])
    return Tokens(data, first, last, np.concatenate([[0], np.searchsorted(first, after)]), inside)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of undirected ``edges``: one row (node, root) for
    each node that occurs in an edge; root is the smallest node reachable.

    Each round gives every node the smallest node next to it as parent,
    shortens parent chains until they are stars, and moves the edges onto the
    stars' roots; edges inside a star disappear.  Every root that still has
    an edge meets another, so the number of roots falls at least by half in
    each round.  Only minima and joins are used: a hub's neighbours are
    pre-aggregated before the shuffle and never gathered."""
    spark = edges.sparkSession
    left = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    kind = left.schema["u"].dataType
    label, n = None, left.count()
    while n:
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("root"))
        parent = _stars(written(parent, "parents", 2 * n), 2 * n)
        if label is None:
            label, nodes = parent, parent.count()
        else:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
            label = written(label.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "labels", nodes)
        pu = parent.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        pv = parent.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        moved = left.join(pu, "u").join(pv, "v").where("ru <> rv")
        left = written(moved.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(), "edges", n)
        n = left.count()
    if label is None:
        return spark.createDataFrame([], "node long, root long").select(F.col("node").cast(kind), F.col("root").cast(kind))
    return label


def _stars(parent: DataFrame, rows: int) -> DataFrame:
    """Pointer jumping: replace parents by grandparents until none changes."""
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = written(parent.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"), F.coalesce(F.col("up") != F.col("root"), F.lit(False)).alias("moved")), "parents", rows)
        parent = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return parent


__all__ = ["BATCH_ROWS", "Tokens", "bounded_batches", "components", "consumed", "free_name", "materialize", "table", "tokenizer_path", "tokens", "written"]
