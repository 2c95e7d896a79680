"""Benchmark decontamination with an FM-index per shard of training text.

A shard is what one task holds at a time: whole texts up to a bound in bytes
or symbols.  Words that no benchmark item has cannot be part of a match, so a
shard's text is the stretches of benchmark words that are long enough to hold
the shortest window, each closed by a separator.  Over it the task builds a
suffix array, the Burrows-Wheeler transform, a wavelet matrix for ranks and
samples of suffix positions; every window of the benchmark is searched
backwards, its occurrences are located by walking to the next sample, and
the spans found are merged per text.

Separators sort by position, so two suffixes differ at a separator at the
latest, and a stretch's first position is always sampled, so no walk crosses
one.  Texts stay where Spark reads them: no shuffle.  The benchmark goes to
the tasks in blocks of bounded size (one pass over the texts per block, each
adding to the spans of the one before).

Defined results: null or empty texts have no words and no hits; items without
words have no windows; repeated items are each reported; repeated texts are
each searched; a null item id is not reported among the items, its windows
still hit; input columns named like an output are replaced."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.llm.common import bounded_batches, table, written

WINDOW = 10
#: Bounds of a shard, and of a block of benchmark text that is broadcast.
SHARD_SYMBOLS = 1 << 20
SHARD_BYTES = 64 << 20
BLOCK_BYTES = 8 << 20
#: Every such suffix position is kept for locating.
SAMPLE = 8

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Windows:
    """Distinct windows of benchmark items, as rows of word symbols from 1."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW):
        self.symbols: dict[bytes, int] = {}
        found: dict[tuple[int, ...], list[int]] = {}
        for item, text in items:
            words = [self.symbols.setdefault(w, len(self.symbols) + 1) for w in words_of(text or "")]
            for i in range(max(len(words) - window + 1, min(len(words), 1))):
                owners = found.setdefault(tuple(words[i : i + window]), [])
                if item is not None:
                    owners.append(item)
        self.length = np.array([len(w) for w in found], np.int64)
        self.rows = np.zeros((len(found), window), np.int64)
        for i, w in enumerate(found):
            self.rows[i, : len(w)] = w
        self.items = [sorted(set(x)) for x in found.values()]
        self.least = int(self.length.min()) if len(found) else 0


class WaveletMatrix:
    """Ranks of symbols in a sequence, a bit plane per level."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = range(max(1, int(largest).bit_length()) - 1, -1, -1)
        self.ones, self.zeros = {}, {}
        for level in self.levels:
            bits = (symbols >> level) & 1
            self.ones[level] = np.concatenate([[0], np.cumsum(bits)]).astype(np.int32)
            self.zeros[level] = len(symbols) - int(self.ones[level][-1])
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
        self.base = self._down(np.arange(largest + 1), np.zeros(largest + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in self.levels:
            ones = self.ones[level][at]
            at = np.where((symbol >> level) & 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``at``, elementwise."""
        return self._down(symbol, at) - self.base[symbol]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; ``text`` holds numbers from 0."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, k = len(text), 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: max(0, n - k)] = rank[k:] + 1
        key = rank * (n + 1) + nxt
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank[order] = new
        if new[-1] == n - 1:
            return order
        k *= 2


class FmIndex:
    """Index of stretches of symbols 1..largest."""

    def __init__(self, stretches: list[np.ndarray], largest: int, sample: int = SAMPLE):
        size = np.array([len(s) for s in stretches], np.int64)
        self.first = np.cumsum(size + 1) - size - 1  # of each stretch; a separator closes it
        text = np.concatenate([x for s in stretches for x in (s, [0])]).astype(np.int64)
        seps = np.flatnonzero(text == 0)
        unique = text + len(seps) - 1
        unique[seps] = np.arange(len(seps))
        sa = suffix_array(unique)
        self.bwt = np.where(sa > 0, text[sa - 1], 0)
        self.before = np.cumsum(np.bincount(text, minlength=largest + 1)) - np.bincount(text, minlength=largest + 1)
        self.tree = WaveletMatrix(self.bwt, largest)
        first = np.zeros(len(text), bool)
        first[self.first] = True
        self.kept = (sa % sample == 0) | first[sa] | (text[sa] == 0)
        self.kept_at = np.concatenate([[0], np.cumsum(self.kept)])
        self.kept_pos = sa[self.kept]
        self.n = len(text)

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.tree.rank(symbol, at)

    def search(self, rows: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, position) of every occurrence of every row."""
        which = np.arange(len(rows))
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), self.n, np.int64)
        for back in range(rows.shape[1]):
            at = length[which] - 1 - back
            done = at < 0
            symbol = rows[which, np.maximum(at, 0)]
            lo = np.where(done, lo, self.step(symbol, lo))
            hi = np.where(done, hi, self.step(symbol, hi))
            some = hi > lo
            which, lo, hi = which[some], lo[some], hi[some]
        count = hi - lo
        pattern = np.repeat(which, count)
        row = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return pattern, self.locate(row)

    def locate(self, row: np.ndarray) -> np.ndarray:
        pos, walked = np.zeros(len(row), np.int64), 0
        open_ = np.arange(len(row))
        while len(open_):
            kept = self.kept[row]
            pos[open_[kept]] = self.kept_pos[self.kept_at[row[kept]]] + walked
            open_, row = open_[~kept], row[~kept]
            row = self.step(self.bwt[row], row)
            walked += 1
        return pos


def _stretches(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the runs of nonzero symbols that have ``least`` or more."""
    edge = np.diff(np.concatenate([[0], (symbols > 0).astype(np.int8), [0]]))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = hi - lo >= least
    return lo[long], hi[long]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _search_shard(texts: list[str | None], windows: Windows) -> tuple[list[int], dict[int, tuple[list[tuple[int, int]], list[int]]]]:
    """Word counts, and by text with hits its word spans and items."""
    counts, found, stretches, where = [], {}, [], []
    for i, t in enumerate(texts):
        words = words_of(t) if t else []
        counts.append(len(words))
        if not windows.least or len(words) < windows.least:
            continue
        symbols = np.fromiter(map(windows.symbols.get, words, repeat(0)), np.int64, len(words))
        for lo, hi in zip(*_stretches(symbols, windows.least), strict=True):
            stretches.append(symbols[lo:hi])
            where.append((i, int(lo)))
    if stretches:
        index = FmIndex(stretches, len(windows.symbols))
        pattern, pos = index.search(windows.rows, windows.length)
        home = np.searchsorted(index.first, pos, side="right") - 1
        for p, h, off in zip(pattern.tolist(), home.tolist(), (pos - index.first[home]).tolist(), strict=True):
            i, lo = where[h]
            spans, items = found.setdefault(i, ([], set()))
            spans.append((lo + off, lo + off + int(windows.length[p])))
            items.update(windows.items[p])
    return counts, {i: (_merged(s), sorted(x)) for i, (s, x) in found.items()}


def _char_spans(text: str, spans: list[tuple[int, int]]) -> list[dict]:
    """Word spans with their places in characters."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(raw)]
    chars = np.cumsum(np.concatenate([[0], (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80]))  # before each byte
    return [{"first": a, "last": b, "start": int(chars[at[a][0]]), "end": int(chars[at[b - 1][1]])} for a, b in spans]


def find(docs: DataFrame, items: DataFrame, item_col: str = "item_id", item_text: str = "text", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, shard_symbols: int = SHARD_SYMBOLS) -> DataFrame:
    """``docs`` with n_words, hit_spans (merged; words first..last-1, characters
    start..end-1) and hit_items (sorted ids of items with occurring windows)."""
    spark = docs.sparkSession
    source = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    out = docs.drop("n_words", "hit_spans", "hit_items").withColumns({"n_words": F.lit(0).cast("long"), "hit_spans": F.array().cast(SPANS), "hit_items": F.array().cast("array<long>")})
    for k in range(blocks):
        part = source if blocks == 1 else source.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        # A block of benchmark items is about block_bytes at most.
        windows = spark.sparkContext.broadcast(Windows([(r.item, r.text) for r in part.collect()], window))
        out = _pass(out, windows, text_col, shard_bytes, shard_symbols)
        if blocks > 1:
            # One block at a time: its pass is written before the next is built.
            out = written(out, "decontaminate")
            windows.destroy()
    return out


def _pass(docs: DataFrame, windows, text_col: str, shard_bytes: int, shard_symbols: int) -> DataFrame:
    names = docs.columns
    at = names.index(text_col)

    def shard(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for b in held for t in b.column(at).to_pylist()]
        counts, found = _search_shard(texts, windows.value)
        base = 0
        for b in held:
            n = b.num_rows
            spans, items = b.column(names.index("hit_spans")).to_pylist(), b.column(names.index("hit_items")).to_pylist()
            for i in range(n):
                if base + i in found:
                    new, owners = found[base + i]
                    old = [(s["first"], s["last"]) for s in spans[i]]
                    spans[i] = _char_spans(texts[base + i], _merged(old + new))
                    items[i] = sorted({*items[i], *owners})
            columns = dict(zip(names, b.columns, strict=True))
            columns |= {"n_words": pa.array(counts[base : base + n], pa.int64()), "hit_spans": pa.array(spans, _SPANS), "hit_items": pa.array(items, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)
            base += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.column(at).nbytes
            if size >= min(shard_bytes, 16 * shard_symbols):
                yield from shard(held)
                held, size = [], 0
        if held:
            yield from shard(held)

    return docs.mapInArrow(run, docs.schema)


def remove(found: DataFrame, text_col: str = "text") -> DataFrame:
    """The result of :func:`find` with the spans cut out of the texts."""
    spans, text = F.col("hit_spans"), F.col(text_col)
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    kept = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda p: F.substring(text, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")))
    return found.withColumn(text_col, F.when(F.size(spans) == 0, text).otherwise(F.concat_ws("", kept)))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words inside a benchmark window, and the items."""
    bounded_batches(spark)
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(F.col("hit_items").cast("array<string>"))), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
