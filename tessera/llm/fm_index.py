"""Benchmark decontamination with an FM-index per training shard.

A shard is a slice of the documents (some megabytes) inside one Spark task.
Its words become symbols: words that occur in no test phrase become a
separator, and stretches between separators that are shorter than the shortest
phrase are left out, since no phrase can occur in them; neither changes any
result.  Separators differ from one another, so suffix order ends at them.
The index holds the Burrows-Wheeler text of the rest as a wavelet matrix with
rank directories, and every ``SAMPLE``-th suffix position.

All phrases of one length are searched backward together, a word at a time;
occurrences are located by walking back to a sampled position; their spans are
merged into removal spans per document.

Test phrases are the windows of ``WINDOW`` consecutive words of each item (an
item of fewer words, but not none, is one window).  Repeated items are dropped,
then items are dealt to blocks of about ``BLOCK_BYTES`` of text, whose windows are
made by one task each and written as packed arrays.  One block at a time is
broadcast and one pass over the documents is made for it; between passes the
documents and what was found are written, and the block is given up.  So a larger
benchmark needs more passes, not more memory, and the driver holds one packed block.

Defined cases: null and empty texts have no words and are never hit; an item
without words has no window; items that share an id count as one; a null item
id reads as the text "null"; documents are independent rows, so repeated rows
get equal results; extra columns are ignored by ``contamination`` and kept by
``clean``; an empty benchmark hits nothing.
"""

from __future__ import annotations

import functools
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import plain_words, saved, slices, text_bytes

WINDOW, SAMPLE = 10, 16
#: Text of test items that one pass handles, and of documents that one index holds.
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 8 << 20


# ------------------------------------------------------------------ phrases
class Phrases:
    """Distinct windows of some items, by length, and the items of each window."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.symbols: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            words = [self.symbols.setdefault(w, len(self.symbols) + 1) for w in plain_words(text)]
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if words else 0):
                found.setdefault(tuple(words[i:i + size]), set()).add(name)
        windows = sorted(found, key=len)
        self.names = sorted({n for names in found.values() for n in names})
        number = {n: i for i, n in enumerate(self.names)}
        self.items = np.array([number[n] for w in windows for n in sorted(found[w])], np.int64)
        self.item_ends = np.cumsum([0] + [len(found[w]) for w in windows])
        sizes = np.array([len(w) for w in windows], np.int64)
        self.by_size = {int(n): (np.flatnonzero(sizes == n), np.array([w for w in windows if len(w) == n], np.int64))
                        for n in np.unique(sizes)}
        self.shortest = int(sizes.min()) if len(sizes) else 0

    def packed(self) -> bytes:
        """The same as compressed bytes, to be written and broadcast."""
        return zlib.compress(pickle.dumps((list(self.symbols), self.names, self.items, self.item_ends, self.by_size, self.shortest)), 1)

    @classmethod
    def unpacked(cls, data: bytes) -> Phrases:
        own = cls([], 1)
        symbols, own.names, own.items, own.item_ends, own.by_size, own.shortest = pickle.loads(zlib.decompress(data))
        own.symbols = {w: n for n, w in enumerate(symbols, 1)}
        return own


@functools.lru_cache(maxsize=1)
def _phrases(data: bytes) -> Phrases:
    """A worker keeps the block of the pass that it works on."""
    return Phrases.unpacked(data)


def packed_blocks(items: DataFrame, blocks: int, window: int) -> DataFrame:
    """(block, phrases): every block's windows, each made by one task from about ``BLOCK_BYTES`` of distinct items."""
    def build(table: pa.Table) -> pa.Table:
        pairs = list(zip(table["item"].to_pylist(), text_bytes(table["text"])))
        return pa.table({"block": table["block"][:1], "phrases": pa.array([Phrases(pairs, window).packed()], pa.binary())})

    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(build, "block int, phrases binary")


# ------------------------------------------------------------------ index
def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order; each 0 is a separator of its own, less than any word.

    Prefix doubling: only suffixes whose first ``h`` symbols others share are sorted again.
    """
    n = len(text)
    zeros = np.flatnonzero(text == 0)
    key = text + len(zeros)
    key[zeros] = np.arange(len(zeros))
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)

    def renumber(at: np.ndarray, keys: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Rank suffixes ``at``, sorted by ``keys``; ``first`` is the place of each in the whole order. Which are still tied."""
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        start = first[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        rank[at] = start
        return ~new | ~np.concatenate([new[1:], [True]])

    tied = renumber(order, key[order], np.arange(n)) if n else np.zeros(0, bool)
    place, h = np.flatnonzero(tied), 1
    while len(place):
        at = order[place]
        after = at + h
        keys = rank[at] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        sort = np.argsort(keys, kind="stable")
        order[place] = at[sort]
        place, h = place[renumber(at[sort], keys[sort], place)], 2 * h
    return order


class WaveletMatrix:
    """rank and access over small non-negative numbers, a bit level at a time."""

    def __init__(self, values: np.ndarray, bits: int):
        self.n, self.bits = len(values), bits
        self.words, self.before, self.zeros = [], [], []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level & 1).astype(bool)
            packed = np.packbits(np.concatenate([bit, np.zeros(-len(bit) % 64 + 64, bool)]), bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][at >> 6] + np.bitwise_count(self.words[level][at >> 6] & low)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` values equal ``symbol``."""
        start = np.zeros_like(at)
        for level in range(self.bits):
            one = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
            a, b = self._ones(level, start), self._ones(level, at)
            start = np.where(one, self.zeros[level] + a, start - a)
            at = np.where(one, self.zeros[level] + b, at - b)
        return at - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at ``at``, and how many equal ones come before each."""
        symbol, start, at = np.zeros_like(at), np.zeros_like(at), at.copy()
        for level in range(self.bits):
            one = (self.words[level][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            a, b = self._ones(level, start), self._ones(level, at)
            start = np.where(one, self.zeros[level] + a, start - a)
            at = np.where(one, self.zeros[level] + b, at - b)
            symbol = symbol << 1 | one
        return symbol, at - start


class FMIndex:
    """Search and locate phrases of symbols 1..n in a text whose 0s are separators."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        order = suffix_order(text)
        last = np.where(order > 0, text[order - 1], 0) if len(text) else text
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        self.last = WaveletMatrix(last, max(1, int(n_symbols).bit_length()))
        marked = (order % SAMPLE == 0) | (last == 0)  # stretches begin at a sample, so no walk crosses a separator
        self.marked = marked
        self.mark_rank = np.cumsum(marked) - 1
        self.samples = order[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase (rows of one length)."""
        low, high = self.first[phrases[:, -1]], self.first[phrases[:, -1] + 1]
        low, high = low.copy(), high.copy()
        for k in range(phrases.shape[1] - 2, -1, -1):
            live = np.flatnonzero(high > low)
            if not len(live):
                break
            symbol = phrases[live, k]
            low[live] = self.first[symbol] + self.last.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.last.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in rows ``row`` of the order."""
        out, steps, row, live = np.zeros_like(row), 0, row.copy(), np.arange(len(row))
        while len(live):
            done = self.marked[row[live]]
            out[live[done]] = self.samples[self.mark_rank[row[live[done]]]] + steps
            live, steps = live[~done], steps + 1
            symbol, before = self.last.access(row[live])
            row[live] = self.first[symbol] + before
        return out


# ------------------------------------------------------------------ shards
def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def search_shard(docs: list[np.ndarray], phrases: Phrases) -> tuple[np.ndarray, list[np.ndarray]]:
    """Hit flag of each word of the shard, and the item numbers found in each document."""
    sizes = np.array([len(d) for d in docs], np.int64)
    ends = np.cumsum(sizes)
    words = np.concatenate(docs) if docs else np.zeros(0, np.int64)
    hit = np.zeros(len(words), bool)
    items: list[np.ndarray] = [np.zeros(0, np.int64)] * len(docs)
    if not len(words) or not phrases.shortest:
        return hit, items
    # Stretches of phrase words inside one document, long enough for the shortest phrase.
    inside = words > 0
    owner = np.repeat(np.arange(len(docs)), sizes)
    edge = np.concatenate([[True], (inside[1:] != inside[:-1]) | (owner[1:] != owner[:-1])])
    begin = np.flatnonzero(edge)
    length = np.diff(np.append(begin, len(words)))
    kept = inside[begin] & (length >= phrases.shortest)
    begin, length = begin[kept], length[kept]
    if not len(begin):
        return hit, items
    text = np.zeros(int(length.sum()) + len(length), np.int64)
    starts = np.cumsum(length + 1) - length - 1  # each stretch is followed by its separator
    text[_ragged(starts, length)] = words[_ragged(begin, length)]
    index = FMIndex(text, len(phrases.symbols))
    delta = np.zeros(len(words) + 1, np.int32)
    pairs = []
    for size, (numbers, rows) in phrases.by_size.items():
        low, high = index.search(rows)
        found = np.flatnonzero(high > low)
        if not len(found):
            continue
        count = high[found] - low[found]
        at = index.locate(_ragged(low[found], count))
        stretch = np.searchsorted(starts, at, side="right") - 1
        word = begin[stretch] + at - starts[stretch]
        delta += np.bincount(word, minlength=len(delta)).astype(np.int32)
        delta -= np.bincount(word + size, minlength=len(delta)).astype(np.int32)
        pairs.append(np.unique(owner[word] * len(phrases.item_ends) + np.repeat(numbers[found], count)))
    hit = np.cumsum(delta[:-1]) > 0
    if pairs:
        doc, window = np.divmod(np.unique(np.concatenate(pairs)), len(phrases.item_ends))
        n = phrases.item_ends[window + 1] - phrases.item_ends[window]
        both = np.unique(np.repeat(doc, n) * len(phrases.names) + phrases.items[_ragged(phrases.item_ends[window], n)])
        doc, item = np.divmod(both, len(phrases.names))
        for d, part in zip(np.unique(doc), np.split(item, np.flatnonzero(np.diff(doc)) + 1)):
            items[d] = part
    return hit, items


def _runs(hit: np.ndarray) -> list[dict]:
    """Removal spans: maximal stretches of hit words, as word numbers, end exclusive."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _pass(phrases: Broadcast, text_col: str, spans_col: str, items_col: str, words_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _phrases(phrases.value)
        get = own.symbols.get
        for batch in slices(batches, text_col, SHARD_BYTES):
            docs = []
            for text in text_bytes(batch.column(text_col)):
                words = plain_words(text)
                docs.append(np.fromiter([get(w, 0) for w in words], np.int64, len(words)))
            hit, items = search_shard(docs, own)
            ends = np.cumsum([0] + [len(d) for d in docs])
            any_hit = np.add.reduceat(np.append(hit, False), ends[:-1]) if len(docs) else []
            spans, names = [], []
            for d, (old, known) in enumerate(zip(batch.column(spans_col).to_pylist(), batch.column(items_col).to_pylist())):
                found = hit[ends[d]:ends[d + 1]]
                if len(found) and any_hit[d]:
                    for s in old:
                        found[s["start"]:s["end"]] = True
                    old = _runs(found)
                spans.append(old)
                names.append(sorted({*known, *(own.names[i] for i in items[d])}) if len(items[d]) else known)
            made = {words_col: pa.array(np.diff(ends), pa.int64()), spans_col: pa.array(spans, _SPANS),
                    items_col: pa.array(names, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(
                [made.get(c, batch.column(i)) for i, c in enumerate(batch.schema.names)], batch.schema.names)
    return run


def search(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, window: int,
           prefix: str = "") -> DataFrame:
    """``docs`` with ``<prefix>n_words``, ``<prefix>spans`` and ``<prefix>items`` added."""
    names = [f"{prefix}{c}" for c in ("n_words", "spans", "items")]
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                             F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    items = saved(items.distinct(), "fm-items")  # copies of an item are one
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item")), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_BYTES) or 1
    packed = saved(packed_blocks(items, blocks, window), "fm-blocks")
    out = docs.withColumns({names[0]: F.lit(0).cast("long"),
                            names[1]: F.array().cast("array<struct<start:bigint,end:bigint>>"),
                            names[2]: F.array().cast("array<string>")})
    spark = docs.sparkSession
    for block in range(blocks):
        row = packed.where(F.col("block") == block).select("phrases").first()
        own = spark.sparkContext.broadcast(bytes(row["phrases"]) if row else Phrases([], window).packed())
        out = out.mapInArrow(_pass(own, text_col, names[1], names[2], names[0]), out.schema)
        if block < blocks - 1:
            out = saved(out, "fm-pass")
            own.destroy()
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, spans, items) for every document: removal spans in word numbers, items as sorted texts."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return (search(rows, benchmark, "text", item_col, item_text_col, window)
            .select(F.col("id").alias(id_col), "n_words", "spans", "items"))


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, with their own columns only, in which no test phrase occurs."""
    found = search(docs, benchmark, text_col, item_col, item_text_col, window, "__fm_")
    return found.where(F.size("__fm_spans") == 0).select(*docs.columns)
