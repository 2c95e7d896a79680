"""SentencePiece encoding and decoding through a table of distinct chunks.

The vocabulary's pieces never hold a white space marker after another
character, so no piece crosses from a word into the marker of the next one;
the same is read off the vocabulary for marks such as commas behind a letter.
A text is therefore cut before each run of markers and before such marks,
every distinct chunk is segmented once, and ids (and decoded text) are joined
back by position.  Spark deals out the texts; each worker keeps the table of the
chunks that it has met, bounded in entries, and starts it over when full.
No shuffle is needed and nothing is gathered.

Defined results: null text counts as empty; an empty text has no ids and
decodes to the empty text; repeated rows are each encoded; columns of the
input stay, but those named like an output are replaced."""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.llm.common import bounded_batches, table, tokenizer_path

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Entries of a worker's chunk table before it starts over (memory, not results).
TABLE_ENTRIES = 600_000


def break_marks(pieces: list[str]) -> str:
    """Characters before which a text may be cut wherever another character
    than these stands before them: marks (no letters, no decimal digits) such
    that in every piece only a marker or one of the set stands directly
    before one of them."""
    before: dict[str, set[str]] = {}
    for p in pieces:
        for x, c in zip(p, p[1:], strict=False):
            before.setdefault(c, set()).add(x)
    marks = {c for p in pieces for c in p if not (c.isalpha() or c.isdecimal() or c.isspace() or c == MARK)}
    while bad := {c for c in marks if not before.get(c, set()) <= marks | {MARK}}:
        marks -= bad
    # Those in common use, and what may stand before them.
    used = {c for c in marks if c.isascii()}
    while more := {x for c in used for x in before.get(c, set())} - used - {MARK}:
        used |= more
    return "".join(sorted(used))


class ChunkTable:
    """Distinct chunk -> ids as int32 bytes; and the decoded text of those
    chunks that do not decode to themselves.

    A chunk starts with a run of markers (written as spaces), or with a mark
    of :func:`break_marks` after another character, or at a line end if no
    piece holds one: no piece crosses into it."""

    def __init__(self, path: str, entries: int = TABLE_ENTRIES):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = entries
        self.ids: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.vocab_size()) if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i))]
        marks = re.escape(break_marks(pieces))
        # Nothing joins what follows the guard to it: a line end that no piece
        # holds, else a letter (chunks then start with a marker or a mark).
        self.guard = "a" if any("\n" in p for p in pieces) else "\n"
        self.guard_ids = self.sp.encode(self.guard)
        if self.guard == "a":
            self.split = re.compile(f" *[{marks}]*[^ {marks}]+| *[{marks}]+| +")
        else:
            self.split = re.compile(f" *[{marks}]*[^ {marks}\n]+| *[{marks}]+|\n| +")

    def add(self, new: list[str]) -> None:
        """Segment these distinct chunks, each once, and decode their ids."""
        # The encoder puts a marker first: it stands for the chunk's own, if there is one.
        marked = [c[1:] for c in new if c[0] == " " and c.strip(" ")]
        found = dict(zip(marked, self.sp.encode(marked, num_threads=1), strict=True)) if marked else {}
        ids = []
        for c in new:
            if c[0] == " " and c[1:] in found:
                ids.append(found[c[1:]])
            else:  # the guard takes the encoder's marker
                ids.append(self.sp.encode(self.guard + c)[len(self.guard_ids) :])
        # Decoding strips a text's first marker: the guard's.
        decoded = self.sp.decode([self.guard_ids + i for i in ids], num_threads=1)
        for c, i, d in zip(new, ids, decoded, strict=True):
            self.ids[c] = array("i", i).tobytes()
            if d[1:] != c:
                self.odd[c] = d[1:]

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids of the whole text, and what they decode to."""
        if not text:
            return b"", ""
        if MARK in text:
            text = text.replace(MARK, " ")
        chunks = self.split.findall(" " + text)
        ids = list(map(self.ids.get, chunks))
        if None in ids:
            lacking = [k for k, i in enumerate(ids) if i is None]
            self.add(list(dict.fromkeys(chunks[k] for k in lacking)))
            for k in lacking:
                ids[k] = self.ids[chunks[k]]
        if self.odd and not self.odd.keys().isdisjoint(chunks):
            text = "".join(self.odd.get(c, c) for c in chunks)[1:]
        joined = b"".join(ids)
        if len(self.ids) > self.entries:
            self.ids.clear()
            self.odd.clear()
        return joined, text


@functools.cache
def chunk_table(path: str) -> ChunkTable:
    return ChunkTable(path)


def encode_decode(docs: DataFrame, text_col: str = "text", model: str | None = None, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``docs`` with the piece ids of each whole text and the text that the
    ids decode to.  ``model``: path of the model file on the executors."""
    docs = docs.drop(ids_col, decoded_col)
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunk_table(model or tokenizer_path(MODEL))
        for batch in batches:
            pairs = [chunks.encode(t or "") for t in batch.column(at).to_pylist()]
            ends = [0]
            for b, _ in pairs:
                ends.append(ends[-1] + len(b) // 4)
            ids = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(b for b, _ in pairs))])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array([d for _, d in pairs], pa.string())], [*names, ids_col, decoded_col])

    schema = T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(decoded_col, T.StringType())])
    return docs.mapInArrow(run, schema)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded; digests of ids and text."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_decode(docs)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
