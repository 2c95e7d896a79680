"""Token ids as compact files: frequency-ranked ids, byte-aligned coding.

1. Each whole text is encoded and closed with an end id.
2. Ids are counted over all texts; an id's rank by falling count (ties: the
   smaller id) is what gets written, so that common ids take one byte.
3. Texts are dealt by range of document id, sorted, and coded in blocks.  A
   value takes 1 to 4 data bytes (little endian); its byte count less one is
   a 2-bit field of a control byte, four values to a control byte, and
   control bytes and data bytes are kept apart.
4. The files are Parquet, so Spark's committer writes them to any store and a
   lost executor leaves no part of them behind; a row is a block: shard,
   block, ids before it in its shard, document ids, lengths, control, data.
   The rank table (one row per id, no larger than the vocabulary) lies beside.

Reading decodes with numpy: a 256-row table turns control bytes into lengths,
their running sum into positions, and positions gather the data bytes.

Defined results: null text counts as empty and holds the end id alone; rows
with the same document id stay separate, in order of their ids' bytes; a null
document id sorts first; an empty table gives empty files."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlake.llm.common import bounded_batches, table, tokenizer_path, written
from adlake.session import scratch_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Ids of a block; a longer text makes a longer block of its own.
BLOCK_IDS = 1 << 18
#: Bytes of the texts that are split together.
JOIN_BYTES = 1 << 20
#: Entries of a worker's word table before it starts over (memory, not results).
TABLE_ENTRIES = 250_000

# The endings that the vocabulary's own split cuts off a word.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Kinds of the characters up to U+00FF: white space, letters, numbers, others.
SPACE, LETTER, NUMBER, OTHER = range(4)
_KIND = np.array([LETTER if c.isalpha() else NUMBER if c.isnumeric() else SPACE if c in "\t\n\v\f\r \x85\xa0" else OTHER for c in map(chr, range(256))], np.uint8)


class WordTable:
    """Distinct word of the vocabulary's split -> its ids.  Words never share
    an id, so a text's ids are its words' ids in order.  A batch's texts are
    split together, a word is looked up once for the batch, and ids are
    joined back by position.  Texts with characters above U+00FF or with a
    special token's marks go to the library whole."""

    def __init__(self, path: str, entries: int = TABLE_ENTRIES):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.entries = entries
        self.kind = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.ids: dict[bytes, bytes] = {}
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.level = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(256)}

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def word(self, word: bytes) -> bytes:
        tokens = self.tok.model.tokenize(word.decode("latin-1").translate(self.level))
        return np.array([t.id for t in tokens], self.kind).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out, plain, at, size = [b""] * len(texts), [], [], 0

        def join() -> None:
            for i, ids in zip(at, self._join(plain), strict=True):
                out[i] = ids
            plain.clear()
            at.clear()

        for i, t in enumerate(texts):
            if not t:
                continue
            try:
                if "<|" in t:
                    raise ValueError
                plain.append(t.lower().encode("latin-1"))
                at.append(i)
                size += len(t)
            except ValueError:
                out[i] = self.whole(t)
            if size >= JOIN_BYTES:
                join()
                size = 0
        if plain:
            join()
        if len(self.ids) > self.entries:
            self.ids.clear()
        return out

    def _join(self, texts: list[bytes]) -> list[bytes]:
        raw = np.frombuffer(b" ".join(texts) + b"   ", np.uint8)
        kind = _KIND[raw]
        inside = kind != SPACE
        begin = inside.copy()
        begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        for end in ENDINGS:
            q = np.flatnonzero(begin & (raw == ord("'")))
            for k, c in enumerate(end.encode(), 1):
                q = q[raw[q + k] == c]
            begin[q + 1] = False
            begin[q + len(end) + 1] = inside[q + len(end) + 1]
        place = np.flatnonzero(inside)
        starts = np.flatnonzero(begin[place])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(place)).astype(np.int64)), pa.py_buffer(raw[place])]).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        ids = list(map(self.ids.get, distinct))
        for k, w in enumerate(distinct):
            if ids[k] is None:
                ids[k] = self.ids[w] = self.word(w)
        size = np.array([len(x) for x in ids], np.int64) // self.kind.itemsize
        flat = np.frombuffer(b"".join(ids), self.kind)
        index = words.indices.to_numpy().astype(np.int64)
        n = size[index]
        ends = np.cumsum(n)
        flat = flat[np.repeat((np.cumsum(size) - size)[index] - (ends - n), n) + np.arange(int(n.sum()))]
        # A text's words are those that begin before its end.
        upto = np.searchsorted(place[starts], np.cumsum([len(t) + 1 for t in texts]))
        bound = np.concatenate([[0], ends])[np.concatenate([[0], upto])]
        return [flat[a:b].tobytes() for a, b in zip(bound[:-1], bound[1:], strict=True)]


@functools.cache
def word_table(path: str) -> WordTable:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTable(path)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, width, ids): each whole text's ids and the end id, as bytes of
    little-endian numbers of ``width`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_table(vocabulary or tokenizer_path(VOCABULARY))
        end = np.array([end_id], words.kind).tobytes()
        for b in batches:
            ids = [x + end for x in words.encode(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([words.kind.itemsize] * len(ids), pa.int32()), pa.array(ids, pa.binary())], ["doc_id", "width", "ids"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, width int, ids binary")


def ranked(ids: DataFrame) -> DataFrame:
    """(id, n, rank) over all texts; each task counts what it reads first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            for width, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                n = np.bincount(np.frombuffer(raw, f"<u{width}"))
                if len(n) > len(total):
                    total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
                total[: len(n)] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    counts = ids.select("width", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # One task orders the ids: they are no more than the vocabulary has.
    return counts.withColumn("rank", F.row_number().over(W.orderBy(F.desc("n"), "id")) - 1)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    fields = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    fields[: len(values)] = size - 1
    fields = fields.reshape(-1, 4)
    control = fields[:, 0] | fields[:, 1] << 2 | fields[:, 2] << 4 | fields[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


@functools.cache
def sizes() -> np.ndarray:
    """Byte counts of the four values of each possible control byte."""
    return ((np.arange(256)[:, None] >> np.arange(0, 8, 2)) & 3).astype(np.int64) + 1


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = sizes()[np.frombuffer(control, np.uint8)].ravel()[:n]
    start = np.cumsum(size) - size
    raw = np.frombuffer(data, np.uint8)
    values = raw[start].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if not len(more):
            break
        values[more] |= raw[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def write(ids: DataFrame, path: str, block_ids: int = BLOCK_IDS) -> None:
    """Write ``ids`` (see :func:`encode`) below ``path`` in ascending document id."""
    spark = ids.sparkSession
    ranked(ids).write.parquet(f"{path}/ranks")
    table_rows = spark.read.parquet(f"{path}/ranks").select("id", "rank").toPandas()  # at most the vocabulary
    rank_of = np.zeros(int(table_rows["id"].max()) + 1 if len(table_rows) else 1, np.uint32)
    rank_of[table_rows["id"].to_numpy(np.int64)] = table_rows["rank"].to_numpy(np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        names, lengths, parts, n = [], [], [], 0

        def flush() -> pa.RecordBatch:
            control, data = pack(np.concatenate(parts))
            row = {"shard": [shard], "block": [block], "before": [before], "n": [n], "doc_ids": [names], "lengths": [lengths], "control": [control], "data": [data]}
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()), strict=True)], list(row))

        for b in batches:
            for doc, width, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                parts.append(shared.value[np.frombuffer(raw, f"<u{width}")])
                names.append(doc)
                lengths.append(len(parts[-1]))
                n += lengths[-1]
                if n >= block_ids:
                    yield flush()
                    block, before = block + 1, before + n
                    names, lengths, parts, n = [], [], [], 0
        if parts:
            yield flush()

    dealt = ids.select("doc_id", "width", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    schema = "shard int, block long, before long, n long, doc_ids array<long>, lengths array<long>, control binary, data binary"
    dealt.mapInArrow(code, schema).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files below ``path``: ids as
    bytes of little-endian unsigned 32-bit numbers, start the ids of all
    documents before."""
    blocks = spark.read.parquet(f"{path}/blocks")
    table_rows = spark.read.parquet(f"{path}/ranks").select("id", "rank").toPandas()  # at most the vocabulary
    id_of = np.zeros(max(1, len(table_rows)), "<u4")
    id_of[table_rows["rank"].to_numpy(np.int64)] = table_rows["id"].to_numpy(np.uint32)
    shared = spark.sparkContext.broadcast(id_of)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, before, n, names, lengths, control, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids = shared.value[unpack(control, data, n)]
                ends = np.cumsum(np.array(lengths, np.int64))
                starts = ends - np.array(lengths, np.int64)
                raw = [ids[i:j].tobytes() for i, j in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(names), pa.int32()), pa.array(names, pa.int64()), pa.array(before + starts), pa.array(lengths, pa.int64()), pa.array(raw, pa.binary())], ["shard", "doc_id", "within", "n_tokens", "ids"])

    # One row per shard, as many as the writer had tasks: small enough to order in one task and to broadcast.
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    shards = shards.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("earlier"))
    rows = blocks.select("shard", "before", "n", "doc_ids", "lengths", "control", "data").mapInArrow(decode, "shard int, doc_id long, within long, n_tokens long, ids binary")
    return rows.join(F.broadcast(shards), "shard").select("doc_id", (F.col("within") + F.col("earlier")).alias("start"), "n_tokens", "ids")


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts -> files -> per document what the files hold."""
    bounded_batches(spark)
    ids = written(encode(table(spark, sf_dir, "documents")), "ids")
    path = scratch_path(spark, f"llm/tokens-{uuid.uuid4().hex}")
    write(ids, path)
    bounded_batches(spark, 16)  # a row is a block now
    return read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


__all__ = ["encode", "op7_token_output", "pack", "ranked", "read", "unpack", "write"]
