"""Language-model scores from an Elias-Fano trie of n-grams.

The model interpolates three orders.  p1 = (c + 0.1) / (N + 0.1 (V + 1)) is
the base; p2 = (c(vw) + MU p1) / (c(v) + MU); p3 = max(c(uvw) - D, 0) / c(uv)
+ D T(uv) / c(uv) * p2, with T(uv) the distinct words after uv, and p3 = p2
where uv is unknown.  Every trained n-gram takes part; nothing is pruned.

1. Texts are cut into blocks of at most BLOCK tokens (a longer text into
   pieces that carry two tokens of context).  A block sends its distinct words
   with their training counts to word shards, which answer ids and counts.
2. A block sends its distinct trigrams, with their training counts, to the
   shard of their first two words.  A shard builds a trie of what was trained:
   words u, under each the words v with quantised probability and back-off of
   (u, v), under each of these the words w with quantised probability.  A
   level is one monotone sequence, since each context's ids are counted on
   from the last value of the context before it; pointers into the next level
   are monotone too.  Both are Elias-Fano coded (packed low bits, unary high
   bits) in a memory-mapped file without a name, which goes with its task.
3. A query finds the pointers' range of its context and searches the
   successor of the id, counted on from that context's start.  The shard
   answers the trigrams of every block; blocks add up their documents.

All exchanges are of distinct words or trigrams of a block, so a frequent word
or pair costs one entry a block.  Probabilities are quantised to 1 / STEP of a
decade, half of which bounds the error of a token's log10 probability.

Defined results: a null text is empty (one end token); a row without an id is
held out; repeated rows are scored and learnt each; without training text p1
is 1.  Other columns are not read."""

from __future__ import annotations

import itertools
import mmap
import re
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import bounded_batches, table, written
from adlake.session import scratch_path

#: Tokens of a block; three local word numbers have to fit 63 bits.
BLOCK = 1 << 20
#: Shards for each task of the scan.
SHARDS = 4
#: Bytes of a text that are split at once.
PIECE = 4 << 20
#: Weight of the base in the second order, discount of the third.
MU, DISCOUNT = 2000.0, 0.75
#: Steps of a decade, in two bytes; 0 stands for no probability.
STEP = 4096
#: Additive smoothing of the base.
ADD = 0.1

#: Local word numbers of a text's start and of what follows its end.
START, AFTER, WORDS = 0, 1, 2
#: Global ids: 0 unknown, 1 start (as a context) or after the end (as a word).
UNKNOWN, EDGE, FIRST = 0, 1, 2
_BITS = 21
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def quantised(p: np.ndarray) -> np.ndarray:
    """Probabilities as steps of their log10, in two bytes."""
    with np.errstate(divide="ignore"):
        steps = np.rint(-STEP * np.log10(p))
    return np.where(p > 0, np.clip(steps, 0, 65534) + 1, 0).astype(np.uint16)


def restored(q: np.ndarray) -> np.ndarray:
    return np.where(q > 0, 10.0 ** ((1.0 - q) / STEP), 0.0)


def packed(values: np.ndarray) -> bytes:
    """Non-negative integers: byte planes, compressed."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view("<i8").ravel()


# ---- Elias-Fano sequences and the trie -------------------------------------

_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
#: Place of the k-th one of a byte.
_PLACE = np.argsort(1 - _ONES, axis=1, kind="stable").astype(np.uint8)
#: A one, and the highest bit, in each byte; masks of every other bit, pair and half byte.
_EACH, _HIGH, _BIT, _PAIR, _HALF = (np.uint64(0x0101010101010101 * b) for b in (1, 0x80, 0x55, 0x33, 0x0F))


def _select(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one (from 0) of each 64-bit word, which has it."""
    k = k.astype(np.uint64)
    ones = words - ((words >> 1) & _BIT)
    ones = (ones & _PAIR) + ((ones >> 2) & _PAIR)
    upto = ((ones + (ones >> 4)) & _HALF) * _EACH  # a byte: the ones up to its end
    at = (((((k * _EACH) | _HIGH) - upto) & _HIGH) >> 7) * _EACH >> 56 << 3  # after the bytes with k ones or fewer
    octet, before = (words >> at) & 255, ((upto << 8) >> at) & 255
    return at.astype(np.int64) + _PLACE[octet, k - before]


class Monotone:
    """A non-decreasing sequence in Elias-Fano form."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.bits, self.low, self.high, self.ones = n, bits, low, high, ones
        self.zeros = 64 * np.arange(len(ones)) - ones

    @staticmethod
    def arrays(values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = min(56, max(0, (top // max(n, 1)).bit_length() - 1))
        octets = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(n, 8)
        low = np.packbits(np.unpackbits(octets, axis=1, count=bits, bitorder="little"), bitorder="little")
        size = -(-(n + (top >> bits) + 2) // 64) * 64
        unary = np.zeros(size, np.uint8)
        unary[(values >> bits) + np.arange(n)] = 1
        high = np.packbits(unary, bitorder="little").view("<u8")
        ones = np.cumsum(unary.reshape(-1, 64).sum(axis=1, dtype=np.int64))
        return n, bits, np.concatenate([low, np.zeros(8, np.uint8)]), high, np.concatenate([[0], ones[:-1]])

    def lows(self, i: np.ndarray) -> np.ndarray:
        window = np.lib.stride_tricks.as_strided(self.low[:8].view("<u8"), (max(1, len(self.low) - 7),), (1,))
        at = i * self.bits
        return (window[at >> 3] >> (at & 7).astype(np.uint64)).astype(np.int64) & ((1 << self.bits) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i, "right") - 1
        place = 64 * word + _select(self.high[word], i - self.ones[word])
        return ((place - i) << self.bits) | self.lows(i)

    def _upto(self, h: np.ndarray) -> np.ndarray:
        """Elements whose high part is h or less: ones before the h-th zero."""
        word = np.searchsorted(self.zeros, h, "right") - 1
        return 64 * word + _select(~self.high[word], h - self.zeros[word]) - h

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first element that is x or more, and whether it is x."""
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        last = len(self.high) * 64 - self.n - 1
        h = x >> self.bits
        beyond = h > last
        h = np.minimum(h, last)
        # Rising queries share high parts, and one ends where the next begins.
        new = np.diff(h, prepend=-1) != 0
        own, run = h[new], np.cumsum(new) - 1
        upto = self._upto(own)
        below = np.concatenate([[0], upto])[: len(own)]
        apart = np.flatnonzero((own > 0) & (np.diff(own, prepend=-1) != 1))
        below[apart] = self._upto(own[apart] - 1)
        below[own == 0] = 0
        lo, hi = below[run], upto[run]
        end, want = hi.copy(), x & ((1 << self.bits) - 1)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.lows(mid) < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        lo[beyond] = self.n
        found = (lo < end) & ~beyond
        at = np.flatnonzero(found)
        found[at] = self.lows(lo[at]) == want[at]
        return lo, found


class Level:
    """Words under contexts: ids counted on from the end of the context
    before, pointers to each context's first word, and quantised values."""

    def __init__(self, ids: Monotone, starts: Monotone, values: list[np.ndarray]):
        self.ids, self.starts, self.values = ids, starts, values

    @staticmethod
    def sequences(context: np.ndarray, ids: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray]:
        """``ids`` rising within each rising ``context``."""
        starts = np.searchsorted(context, np.arange(contexts + 1))
        largest = np.zeros(contexts, np.int64)
        full = starts[1:] > starts[:-1]
        largest[full] = ids[starts[1:][full] - 1]
        return ids + (np.cumsum(largest) - largest)[context], starts

    def find(self, context: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``ids`` under ``context`` (rising, -1: none), and whether they are held."""
        found = context >= 0
        at = np.zeros(len(ids), np.int64)
        ask = np.flatnonzero(found)
        if not len(ask):
            return at, found
        new = np.diff(context[ask], prepend=-1) != 0
        own, run = context[ask][new], np.cumsum(new) - 1
        first, after = self.starts[own], self.starts[own + 1]
        base = np.where(first > 0, self.ids[np.maximum(first - 1, 0)], 0) if self.ids.n else first
        place, same = self.ids.successor(base[run] + ids[ask])
        at[ask] = place
        found[ask] = same & (place >= first[run]) & (place < after[run])
        return at, found


class Trie:
    """Levels in one memory-mapped file that has no name."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, int, list[np.ndarray]]]):
        heads, arrays = [], []
        for context, ids, contexts, values in levels:
            for s in Level.sequences(context, ids, contexts):
                n, bits, *parts = Monotone.arrays(s)
                heads.append((n, bits))
                arrays += parts
            arrays += values
        with tempfile.TemporaryFile() as f:
            places = []
            for a in arrays:
                f.write(bytes(-f.tell() % 8))
                places.append(f.tell())
                f.write(np.ascontiguousarray(a).tobytes())
            f.write(bytes(8))
            f.flush()
            self.file = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        mapped = iter([np.frombuffer(self.file, a.dtype, len(a), p) for a, p in zip(arrays, places, strict=True)])
        head = iter(heads)
        self.levels = []
        for *_, values in levels:
            sequences = [Monotone(*next(head), *itertools.islice(mapped, 3)) for _ in range(2)]
            self.levels.append(Level(*sequences, list(itertools.islice(mapped, len(values)))))

    def __len__(self) -> int:
        return len(self.file)


# ---- blocks ------------------------------------------------------------------


def tokens(raw: bytes) -> Iterator[list[bytes]]:
    """Lower-case words of a text, a piece at a time."""
    raw, at = raw.translate(_LOWER), 0
    while at < len(raw):
        gap = _SPACE.search(raw, min(len(raw), at + PIECE))
        end = gap.start() if gap else len(raw)
        yield raw[at:end].split()
        at = end + 1


class Block:
    """Tokens of texts (or of a piece of one) as local word numbers.  A
    segment is two numbers of context, its tokens, and AFTER."""

    def __init__(self):
        self.index: dict[bytes, int] = defaultdict(itertools.count(WORDS).__next__)
        self.codes: list[np.ndarray] = []
        self.size = 0
        self.segments: list[tuple[int, int | None, bool, int, bool]] = []

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def add(self, row: int, doc: int | None, train: bool, context: list[bytes | None], words: list[bytes], ends: bool) -> None:
        before = [START if w is None else self.index[w] for w in context]
        self.codes += [np.array(before, np.int64), self.numbers(words), np.array([AFTER], np.int64)]
        self.segments.append((row, doc, train, len(words), ends))
        self.size += len(words)

    def weights(self) -> np.ndarray:
        """Training count of each position."""
        return positions(np.array([s[3] for s in self.segments]), np.array([s[2] for s in self.segments]), np.array([s[4] for s in self.segments]))[1]

    def rows(self, shards: int) -> tuple[dict, list[dict]]:
        """What is kept of the block, and its words by shard.  Words are
        numbered anew, a shard's words in a row."""
        names = list(self.index)
        shard = np.array([crc32(w) % shards for w in names], np.int64)
        order = np.argsort(shard, kind="stable")
        renumbered = np.arange(WORDS + len(names))
        renumbered[WORDS + order] = WORDS + np.arange(len(names))
        codes = renumbered[np.concatenate(self.codes)]
        seen = np.bincount(codes, weights=self.weights(), minlength=WORDS + len(names)).astype(np.int64)[WORDS:]
        bound = np.flatnonzero(np.diff(shard[order], prepend=-1, append=shards))
        words = []
        for a, b in itertools.pairwise(bound.tolist()):
            text = zstandard.ZstdCompressor(level=1).compress(b"\n".join([names[i] for i in order[a:b].tolist()]))
            words.append({"shard": int(shard[order[a]]), "words": text, "seen": packed(seen[a:b])})
        row, doc, train, n, ends = (list(c) for c in zip(*self.segments, strict=True))
        return {"codes": packed(codes), "row": row, "doc": doc, "train": train, "n": n, "ends": ends}, words


def positions(n: np.ndarray, train: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each number of a block, its segment, and its count in training."""
    size = n + 3
    segment = np.repeat(np.arange(len(n)), size)
    within = np.arange(len(segment)) - np.repeat(np.cumsum(size) - size, size)
    last = within == np.repeat(size - 1, size)
    weight = np.repeat(train, size) & (within >= 2) & (~last | np.repeat(ends, size))
    return segment, weight.astype(np.int64)


_BLOCK = "block long, codes binary, row array<long>, doc array<long>, train array<boolean>, n array<int>, ends array<boolean>, words array<struct<shard:int,words:binary,seen:binary>>"
_STRUCT = pa.struct([("shard", pa.int32()), ("words", pa.binary()), ("seen", pa.binary())])


def blocks(docs: DataFrame, shards: int, size: int = BLOCK) -> DataFrame:
    """One row a block; ``docs`` has doc_id, train and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        made, rows, block = itertools.count(first), itertools.count(first), Block()

        def flush() -> pa.RecordBatch:
            kept, words = block.rows(shards)
            kinds = (pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.bool_()))
            cols = [pa.array([next(made)], pa.int64()), *(pa.array([v], k) for v, k in zip(kept.values(), kinds, strict=True)), pa.array([words], pa.list_(_STRUCT))]
            return pa.RecordBatch.from_arrays(cols, ["block", *kept, "words"])

        for b in batches:
            for doc, train, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.large_binary()), strict=True):
                row, context, left = next(rows), [None, None], []
                for piece in itertools.chain(tokens(raw.as_py() or b""), [[b""]]):  # the end is the empty word
                    left += piece
                    while block.size + len(left) > size:
                        room = size - block.size
                        if room > 0 and len(left) > size // 2:  # too long to go whole into the next block
                            block.add(row, doc, train, context, left[:room], False)
                            context, left = ([*context, *left[:room]])[-2:], left[room:]
                        if block.segments:
                            yield flush()
                        block = Block()
                block.add(row, doc, train, context, left, True)
        if block.segments:
            yield flush()

    return docs.select("doc_id", "train", "text").mapInArrow(run, _BLOCK)


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Write ``df`` in buckets of ``key`` into the shared folder: it is read
    twice, and never shuffled."""
    spark, name = df.sparkSession, f"lm_{uuid.uuid4().hex}"
    df.write.option("path", scratch_path(spark, f"llm/{name}")).option("compression", "zstd").bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def word_answers(blocks_: DataFrame, shards: int) -> DataFrame:
    """(block, shard, ids, counts) of a block's words; (tokens, words) trained
    are on one row of each shard."""

    def merge(group: pa.Table) -> pa.Table:
        held = [(b, zstandard.ZstdDecompressor().decompress(w).split(b"\n"), unpacked(s)) for b, w, s in zip(group["block"].to_pylist(), group["words"].to_pylist(), group["seen"].to_pylist(), strict=True)]
        total: dict[bytes, int] = defaultdict(int)
        for _, words, seen in held:
            for w, n in zip(words, seen.tolist(), strict=True):
                total[w] += n
        shard = group["shard"][0].as_py()
        trained = sorted(((-n, w) for w, n in total.items() if n))
        ids = {w: FIRST + k * shards + shard for k, (_, w) in enumerate(trained)}
        out = {
            "block": pa.array([b for b, *_ in held], pa.int64()),
            "shard": pa.array([shard] * len(held), pa.int32()),
            "ids": pa.array([packed(np.array([ids.get(w, UNKNOWN) for w in words], np.int64)) for _, words, _ in held], pa.binary()),
            "counts": pa.array([packed(np.array([total[w] for w in words], np.int64)) for _, words, _ in held], pa.binary()),
            "tokens": pa.array([-sum(n for n, _ in trained)] + [0] * (len(held) - 1), pa.int64()),
            "types": pa.array([len(trained)] + [0] * (len(held) - 1), pa.int64()),
        }
        return pa.table(out)

    each = blocks_.select("block", F.explode("words").alias("w")).select("block", "w.shard", "w.words", "w.seen")
    return each.groupBy("shard").applyInArrow(merge, "block long, shard int, ids binary, counts binary, tokens long, types long")


class Grams:
    """Distinct trigrams of a block, by shard of their first two words."""

    def __init__(self, head: dict, answers: list[dict], shards: int):
        codes = unpacked(head["codes"])
        self.n, self.train, self.ends = np.array(head["n"], np.int64), np.array(head["train"]), np.array(head["ends"])
        self.segment, weight = positions(self.n, self.train, self.ends)
        answers = sorted(answers, key=lambda a: a["shard"])
        self.ids = np.concatenate([[EDGE, EDGE], *(unpacked(a["ids"]) for a in answers)])
        self.counts = np.concatenate([[0, 0], *(unpacked(a["counts"]) for a in answers)])
        self.codes = codes
        within = np.arange(len(codes)) - np.repeat(np.cumsum(self.n + 3) - (self.n + 3), self.n + 3)
        self.at = np.flatnonzero(within >= 2)  # positions with two before them
        key = (codes[self.at - 2] << 2 * _BITS) | (codes[self.at - 1] << _BITS) | codes[self.at]
        self.key, self.weight = key, weight[self.at]

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys, rising, and their counts in training."""
        both = np.sort((self.key.astype(np.uint64) << np.uint64(1)) | self.weight.astype(np.uint64))
        key = (both >> np.uint64(1)).astype(np.int64)
        start = np.flatnonzero(np.diff(key, prepend=-1))
        return key[start], np.add.reduceat((both & np.uint64(1)).astype(np.int64), start) if len(start) else key

    def contexts(self, key: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of rising keys: where a context starts, its size, and its shard (-1:
        a word of it is unknown, so nobody has to be asked)."""
        pair = key >> _BITS
        start = np.flatnonzero(np.diff(pair, prepend=-1))
        size = np.diff(start, append=len(key))
        u, v = self.ids[pair[start] >> _BITS], self.ids[pair[start] & ((1 << _BITS) - 1)]
        mixed = (u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (v.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        shard = ((mixed >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
        return start, size, np.where((u > 0) & (v > 0), shard, -1)


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all runs, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _requests(grams: Grams, texts: int, block: int, shards: int) -> Iterator[dict]:
    key, weight = grams.distinct()
    start, size, shard = grams.contexts(key, shards)
    order = np.argsort(shard, kind="stable")
    order = order[np.searchsorted(shard[order], 0) :]
    bound = np.flatnonzero(np.diff(shard[order], prepend=-1, append=shards))
    mask = (1 << _BITS) - 1
    for a, b in itertools.pairwise(bound.tolist()):
        own = order[a:b]
        at = spans(start[own], size[own])
        first = key[start[own]] >> 2 * _BITS
        each = np.flatnonzero(np.diff(first, prepend=-1))  # a word u has its contexts in a row
        parts = {
            "u": grams.ids[first[each]],
            "u_count": np.where(first[each] == START, texts, grams.counts[first[each]]),
            "u_size": np.diff(each, append=len(first)),
            "v": grams.ids[(key[start[own]] >> _BITS) & mask],
            "size": size[own],
            "w": grams.ids[key[at] & mask],
            "seen": weight[at],
        }
        yield {"shard": int(shard[own[0]]), "block": block, **{k: packed(v) for k, v in parts.items()}}


_REQUEST = "shard int, block long, u binary, u_count binary, u_size binary, v binary, size binary, w binary, seen binary"
_MAPS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}


def _table(rows: list[dict], schema: str) -> pa.Table:
    names = [f.split() for f in schema.split(", ")]
    return pa.table({n: pa.array([r[n] for r in rows], _MAPS[k]) for n, k in names})


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, rising, and for each value its number among them."""
    order = np.argsort(values)
    ordered = values[order]
    new = np.diff(ordered, prepend=-1) != 0
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], number


def answered(group: pa.Table, mu: float = MU, discount: float = DISCOUNT) -> tuple[pa.Table, Trie]:
    """A shard: merges the blocks' counts, builds the trie of what was trained
    and looks up every block's trigrams in it."""
    cat = lambda k: np.concatenate([unpacked(x.as_py()) for x in group[k]])
    u, v, w, seen = (cat(k) for k in ("u", "v", "w", "seen"))
    word1, at = np.unique(u, return_index=True)
    total1 = cat("u_count")[at]
    u = np.repeat(u, cat("u_size"))
    wide = int(max(v.max(initial=0), w.max(initial=0))) + 1
    pair, of_pair = numbered(np.searchsorted(word1, u) * wide + v)
    triple, of_triple = numbered(np.repeat(of_pair, cat("size")) * wide + w)
    del u, v, w
    count3 = np.bincount(of_triple, weights=seen, minlength=len(triple)).astype(np.int64)
    pair3, word3 = triple // wide, triple % wide
    pair1, word2 = pair // wide, pair % wide
    count2 = np.bincount(pair3, weights=count3, minlength=len(pair)).astype(np.int64)
    types2 = np.bincount(pair3[(count3 > 0) & (word3 != EDGE)], minlength=len(pair))

    kept2, kept3 = np.flatnonzero(count2), np.flatnonzero(count3)
    kept1 = np.unique(pair1[kept2])
    n2 = count2[kept2].astype(float)
    trie = Trie(
        [
            (np.zeros(len(kept1), np.int64), word1[kept1], 1, []),
            (np.searchsorted(kept1, pair1[kept2]), word2[kept2], len(kept1), [quantised(n2 / (total1[pair1[kept2]] + mu)), quantised(discount * types2[kept2] / n2)]),
            (np.searchsorted(kept2, pair3[kept3]), word3[kept3], len(kept2), [quantised(np.maximum(count3[kept3] - discount, 0) / count2[pair3[kept3]])]),
        ]
    )
    one, two, three = trie.levels
    at1, has1 = one.find(np.zeros(len(word1), np.int64), word1)
    at1 = np.where(has1, at1, -1)
    at2, has2 = two.find(at1[pair1], word2)
    at2 = np.where(has2, at2, -1)
    at3, has3 = three.find(at2[pair3], word3)
    value2 = np.zeros((len(pair), 2), np.uint16)
    value2[:, 1] = 1  # nothing trained after it: the lower order alone
    value2[has2] = np.stack([x[at2[has2]] for x in two.values], axis=1)
    value3 = np.zeros(len(triple), np.uint16)
    value3[has3] = three.values[0][at3[has3]]
    answers2, answers3 = value2[of_pair], value3[of_triple]
    rows, a, b = [], 0, 0
    for block, shard, sizes in zip(group["block"].to_pylist(), group["shard"].to_pylist(), group["size"], strict=True):
        sizes = unpacked(sizes.as_py())
        n, m = len(sizes), int(sizes.sum())
        rows.append({"block": block, "shard": shard, "second": packed(answers2[a : a + n, 0]), "backoff": packed(answers2[a : a + n, 1]), "third": packed(answers3[b : b + m])})
        a, b = a + n, b + m
    return _table(rows, _ANSWER), trie


_ANSWER = "block long, shard int, second binary, backoff binary, third binary"
_SCORE = "row long, doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double"


def _scored(head: dict, words: list[dict], answers: list[dict], shards: int, n: int, v: int, texts: int, mu: float) -> list[dict]:
    grams = Grams(head, words, shards)
    key, inverse = numbered(grams.key)
    start, size, shard = grams.contexts(key, shards)
    by_shard = np.argsort(shard, kind="stable")
    by_shard = by_shard[np.searchsorted(shard[by_shard], 0) :]
    second, backoff, third = np.zeros(len(start)), np.ones(len(start)), np.zeros(len(key))
    answers = sorted(answers, key=lambda a: a["shard"])
    if answers:
        second[by_shard] = restored(np.concatenate([unpacked(a["second"]) for a in answers]))
        backoff[by_shard] = restored(np.concatenate([unpacked(a["backoff"]) for a in answers]))
        third[spans(start[by_shard], size[by_shard])] = restored(np.concatenate([unpacked(a["third"]) for a in answers]))
    context = np.repeat(np.arange(len(start)), size)[inverse]
    token = np.flatnonzero(grams.codes[grams.at] != AFTER)
    code, before = grams.codes[grams.at[token]], grams.codes[grams.at[token] - 1]
    count = grams.counts[code]
    p1 = (count + ADD) / (n + ADD * (v + 1))
    total = np.where(before == START, texts, grams.counts[before])
    # The pair of a token and the one before is the context of the next trigram.
    p2 = second[context[token + 1]] + mu / (total + mu) * p1
    p3 = third[inverse[token]] + backoff[context[token]] * p2
    segment = grams.segment[grams.at[token]]
    sums = lambda x: np.bincount(segment, weights=x, minlength=len(grams.n)).tolist()
    known, base, score = sums(count > 0), sums(np.log10(p1)), sums(np.log10(p3))
    return [dict(zip(("row", "doc_id", "train", "n_tokens", "n_known", "base_score", "score"), r, strict=True)) for r in zip(head["row"], head["doc"], head["train"], head["n"], map(int, known), base, score, strict=True)]


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, shards: int | None = None, mu: float = MU, discount: float = DISCOUNT) -> DataFrame:
    """A row per document; rows where ``held_out`` is not false are not learnt from."""
    if block + WORDS + 2 > 1 << _BITS:
        raise ValueError("a block's words need numbers below 2^21")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(~held_out, F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("text"))
    # The tasks of the scan grow with the input, and so do shards.
    shards = shards or SHARDS * max(2, source.rdd.getNumPartitions())
    made = bucketed(blocks(source, shards, block), "block", max(1, shards // SHARDS))
    words = written(word_answers(made, shards), "lm-words")
    n, v = words.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    texts = made.select(F.sum(F.size(F.filter(F.arrays_zip("train", "ends"), lambda x: x["train"] & x["ends"])))).first()[0] or 0
    own = made.drop("words").groupBy("block")
    known = words.select("block", "shard", "ids", "counts")

    def ask(head: pa.Table, known: pa.Table) -> pa.Table:
        head = head.to_pylist()[0]
        grams = Grams(head, known.to_pylist(), shards)
        return _table(list(_requests(grams, texts, head["block"], shards)), _REQUEST)

    requests = own.cogroup(known.groupBy("block")).applyInArrow(ask, _REQUEST)
    found = written(requests.groupBy("shard").applyInArrow(lambda g: answered(g, mu, discount)[0], _ANSWER), "lm-answers")

    def add_up(head: pa.Table, answers: pa.Table) -> pa.Table:
        rows = answers.to_pylist()
        about = [[r for r in rows if (r["ids"] is None) == asked] for asked in (False, True)]
        return _table(_scored(head.to_pylist()[0], *about, shards, n, v, texts, mu), _SCORE)

    back = known.unionByName(found, allowMissingColumns=True)
    pieces = own.cogroup(back.groupBy("block")).applyInArrow(add_up, _SCORE)
    out = pieces.groupBy("row").agg(F.first("doc_id").alias("doc_id"), (~F.first("train")).alias("held_out"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by what is learnt from nine tenths of them."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)
