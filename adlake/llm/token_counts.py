"""Token counts of fields or sections by offset-mapped attribution.

A whole document is encoded once.  The vocabulary's pieces are byte strings
whose concatenation is the text, so running sums of their lengths are every
token's span; an interval join of sorted spans gives each token the sections
that it overlaps.

The rule for a token that crosses a boundary: it counts for the section that
holds most of its bytes, and of those that hold equally many for the first.
A token that overlaps no section counts as outside.

Sections are a column of (name, start, end) in characters, or by default the
text's lines, each with its line end.  Where given sections overlap, the
common part belongs to the one that starts first; parts beyond the text and
empty sections hold nothing.

Defined results: a null text counts as empty; an empty text has one empty
line; null sections are none; repeated rows are each counted; other columns
stay, those named like an output are replaced."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.llm.common import bounded_batches, table, tokenizer_path

VOCABULARY = "byte_bpe_50k.tiktoken"
SECTION = T.StructType([T.StructField("name", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("n_tokens", T.LongType())])
_SECTION = pa.struct([("name", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("n_tokens", pa.int64())])


@functools.cache
def encoding(path: str):
    """The encoder, and the byte length of each id's piece."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    length = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, i in ranks.items():
        length[i] = len(piece)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), length


def allocate(start: np.ndarray, end: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each token span the number of its section, or -1.  Sections are
    sorted and disjoint; tokens are sorted; none of either is empty."""
    lo = np.searchsorted(last, start, side="right")
    hi = np.searchsorted(first, end, side="left")
    out = np.where(hi > lo, lo, -1)
    many = np.flatnonzero(hi - lo > 1)
    if len(many):
        n = (hi - lo)[many]
        begin = np.cumsum(n) - n
        token = np.repeat(many, n)
        section = np.repeat(lo[many] - begin, n) + np.arange(int(n.sum()))
        overlap = np.minimum(end[token], last[section]) - np.maximum(start[token], first[section])
        best = overlap == np.repeat(np.maximum.reduceat(overlap, begin), n)
        which = np.flatnonzero(best)
        out[many] = section[which[np.searchsorted(which, begin)]]
    return out


def _lines(raw: bytes) -> tuple[list[str], np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    first = np.concatenate([[0], cut])
    return [str(k) for k in range(len(first))], first, np.concatenate([cut, [len(raw)]])


def _given(sections: list[dict] | None, at: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Bytes of given character spans; ``at`` has each character's first byte."""
    top = len(at) - 1
    spans = [(x["name"], *(min(max(x[k] or 0, 0), top) for k in ("start", "end"))) for x in sections or [] if x]
    return [s[0] for s in spans], at[np.array([s[1] for s in spans], np.int64)], at[np.array([s[2] for s in spans], np.int64)]


def count(text: str | None, sections: list[dict] | None, given: bool, path: str) -> tuple[list[dict], int, int]:
    """(sections with n_tokens, all tokens, tokens outside) of one text."""
    encoder, length = encoding(path)
    raw = (text or "").encode("utf-8", "surrogatepass")
    ids = np.asarray(encoder.encode_to_numpy(text), np.int64) if text else np.zeros(0, np.int64)
    end = np.cumsum(length[ids])
    start = end - length[ids]
    head = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    at = np.append(np.flatnonzero(head), len(raw))
    names, first, last = _given(sections, at) if given else _lines(raw)
    order = np.lexsort((np.arange(len(first)), first))
    # Disjoint: a section starts where all before it have ended.
    ended = np.maximum.accumulate(np.concatenate([[0], last[order]]))[:-1] if len(order) else first
    begin = np.maximum(first[order], ended)
    held = last[order] > begin
    which = allocate(start, end, begin[held], last[order][held])
    n = np.zeros(len(first), np.int64)
    n[order[held]] = np.bincount(which[which >= 0], minlength=int(held.sum()))
    chars = np.concatenate([[0], np.cumsum(head)])
    rows = [{"name": x, "start": int(a), "end": int(b), "n_tokens": int(k)} for x, a, b, k in zip(names, chars[first], chars[last], n, strict=True)]
    return rows, len(ids), int((which < 0).sum())


def attribute(docs: DataFrame, text_col: str = "text", sections_col: str | None = None, vocabulary: str | None = None, out_col: str = "section_tokens") -> DataFrame:
    """``docs`` with section_tokens (name, start, end, n_tokens), n_tokens and
    n_outside."""
    docs = docs.drop(out_col, "n_tokens", "n_outside")
    names = docs.columns
    at, spans = names.index(text_col), names.index(sections_col) if sections_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocabulary or tokenizer_path(VOCABULARY)
        for b in batches:
            texts = b.column(at).to_pylist()
            given = [None] * len(texts) if spans is None else b.column(spans).to_pylist()
            rows = [count(t, s, spans is not None, path) for t, s in zip(texts, given, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r[0] for r in rows], pa.list_(_SECTION)), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], [*names, out_col, "n_tokens", "n_outside"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out_col, T.ArrayType(SECTION)), T.StructField("n_tokens", T.LongType()), T.StructField("n_outside", T.LongType())]))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, and of the document."""
    bounded_batches(spark)
    counted = attribute(table(spark, sf_dir, "documents").select("doc_id", "text"))
    each = counted.select("doc_id", F.col("n_tokens").alias("doc_tokens"), F.posexplode("section_tokens").alias("line", "s"))
    return each.select("doc_id", "line", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.n_tokens").alias("n_tokens"), "doc_tokens")
