r"""Token-ID files: patched frame-of-reference blocks in ascending document order.

A file is a run of segments; each is written and read whole (about
``SEGMENT_IDS`` ids, more only for a single longer document), so memory stays
bounded.  All numbers are little-endian.

    segment  "PFR1", u32 documents, u64 ids, u32 blocks, u32 ids a block, u64 body bytes,
             i64 id of each document, u8 whether it has one, u64 ids of each document,
             u64 start of each block in the body and the body's end, body, one byte 0x0A
    block    u32 minimum, u8 width, u8 zero, u16 exceptions,
             the low ``width`` bits of each id less the minimum (bit order: lowest first),
             u16 place of each exception, u32 its bits above ``width``

The width is the smallest that holds ``PERCENTILE`` of the block's offsets;
the others are patched from the exception list.  The block starts allow a
reader to decode any range of ids without the rest.

Spark writes the files (``FILE_SEGMENTS`` segments each, partition after
partition of the range-partitioned rows) with its own commit protocol, so a lost executor's part is written again, and reads
them with its binary source; no path is opened by Python.

Defined cases: null text is empty and still has its end id; rows that share an
id stay neighbours in an order fixed by their text; null ids come first and are
read back as null; an empty table gives no segment.  Columns other than id and
text are ignored.
"""

from __future__ import annotations

import array
import functools
import itertools
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import saved, slices, text_bytes
from tessera.llm.token_counts import _BLANK, _MARKS, byte_alphabet
from tessera.session import scratch_dir

MAGIC = b"PFR1"
BLOCK_IDS, SEGMENT_IDS, PERCENTILE = 512, 1 << 19, 0.9
#: Segments of one file (some 64 MB); a reader holds one file at a time.
FILE_SEGMENTS = 64
#: Chunks that a worker remembers (some 50 bytes each, end to end), and words of their own.
KEEP, KEEP_WORDS = 1_000_000, 100_000
_HEAD = struct.Struct("<4sIQIIQ")
_BLOCK = np.dtype([("low", "<u4"), ("width", "u1"), ("zero", "u1"), ("patched", "<u2")])


# ------------------------------------------------------------------ blocks
def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of each value."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Block starts (with the end) and body of uint32 ids; the last block is filled up with its last id."""
    n = len(ids)
    blocks = -(-n // BLOCK_IDS)
    if not n:
        return np.zeros(1, "<u8"), b""
    full = np.concatenate([ids, np.full(blocks * BLOCK_IDS - n, ids[-1], np.uint32)]).reshape(blocks, BLOCK_IDS)
    low = full.min(1)
    offset = full - low[:, None]
    bits = _bits(offset)
    k = int(np.ceil(PERCENTILE * BLOCK_IDS)) - 1
    width = np.partition(bits, k, axis=1)[:, k]
    over = bits > width[:, None]
    patched = over.sum(1)
    head = np.zeros(blocks, _BLOCK)
    head["low"], head["width"], head["patched"] = low, width, patched
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        if not w:
            continue
        rows = np.flatnonzero(width == w)
        raw = np.unpackbits(offset[rows].astype("<u4").view(np.uint8).reshape(len(rows), BLOCK_IDS, 4)[:, :, :-(-int(w) // 8)],
                            axis=2, bitorder="little")[:, :, :w]
        for row, out in zip(rows, np.packbits(raw.reshape(len(rows), -1), axis=1, bitorder="little")):
            packed[row] = out.tobytes()
    place = np.nonzero(over)[1].astype("<u2")
    high = (offset >> width[:, None].astype(np.uint32))[over].astype("<u4")
    ends = np.concatenate([[0], np.cumsum(patched)])
    sizes = 8 + BLOCK_IDS // 8 * width.astype(np.int64) + 6 * patched
    body = b"".join(itertools.chain.from_iterable(
        (head[b].tobytes(), packed[b], place[ends[b]:ends[b + 1]].tobytes(), high[ends[b]:ends[b + 1]].tobytes())
        for b in range(blocks)))
    return np.concatenate([[0], np.cumsum(sizes)]).astype("<u8"), body


def decode_blocks(starts: np.ndarray, body: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` in ``body`` (bytes), whole blocks."""
    starts = starts.astype(np.int64)
    head = np.ascontiguousarray(body[starts[:, None] + np.arange(8)]).view(_BLOCK)[:, 0]
    out = np.zeros((len(starts), BLOCK_IDS), np.uint32)
    width = head["width"].astype(np.int64)
    for w in np.unique(width):
        if not w:
            continue
        rows, n = np.flatnonzero(width == w), int(w) * BLOCK_IDS // 8
        bits = np.unpackbits(body[starts[rows][:, None] + 8 + np.arange(n)], axis=1, bitorder="little")
        wide = np.zeros((len(rows), BLOCK_IDS, 32), np.uint8)
        wide[:, :, :w] = bits.reshape(len(rows), BLOCK_IDS, w)
        out[rows] = np.packbits(wide, axis=2, bitorder="little").view("<u4")[:, :, 0]
    n = head["patched"].astype(np.int64)
    if n.any():
        row = np.repeat(np.arange(len(starts)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = (starts + 8 + width * BLOCK_IDS // 8)[row]
        place = np.ascontiguousarray(body[(at + 2 * k)[:, None] + np.arange(2)]).view("<u2")[:, 0]
        high = np.ascontiguousarray(body[(at + 2 * n[row] + 4 * k)[:, None] + np.arange(4)]).view("<u4")[:, 0]
        out[row, place] |= high << width[row].astype(np.uint32)
    return (out + head["low"][:, None]).reshape(-1)


def segment(doc_ids: list[int | None], texts: list[np.ndarray]) -> bytes:
    """One segment without its closing byte, from each document's ids."""
    ids = np.concatenate(texts).astype(np.uint32) if texts else np.zeros(0, np.uint32)
    starts, body = encode_blocks(ids)
    return b"".join([
        _HEAD.pack(MAGIC, len(texts), len(ids), len(starts) - 1, BLOCK_IDS, len(body)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is not None for d in doc_ids),
        np.array([len(t) for t in texts], "<u8").tobytes(), starts.tobytes(), body])


class Segment:
    """One segment inside ``data`` (bytes as an array) at ``at``; ``end`` is where the next begins."""

    def __init__(self, data: np.ndarray, at: int = 0):
        magic, n, self.n_ids, blocks, size, body = _HEAD.unpack(data[at:at + _HEAD.size].tobytes())
        if magic != MAGIC or size != BLOCK_IDS:
            raise ValueError("not a segment of token-ID blocks")
        at += _HEAD.size
        ids = data[at:at + 8 * n].tobytes()
        known = data[at + 8 * n:at + 9 * n]
        self.doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(ids, "<i8"), known)]
        at += 9 * n
        self.sizes = np.frombuffer(data[at:at + 8 * n].tobytes(), "<u8").astype(np.int64)
        at += 8 * n
        self.starts = np.frombuffer(data[at:at + 8 * (blocks + 1)].tobytes(), "<u8")
        at += 8 * (blocks + 1)
        self.body = data[at:at + body]
        self.end = at + body + 1

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the segment, decoding only their blocks."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK_IDS, -(-stop // BLOCK_IDS)
        got = decode_blocks(self.starts[first:last], self.body)
        return got[start - first * BLOCK_IDS:stop - first * BLOCK_IDS]


def segments(content: bytes) -> Iterator[Segment]:
    data = np.frombuffer(content, np.uint8)
    at = 0
    while at < len(data):
        yield (one := Segment(data, at))
        at = one.end


# ------------------------------------------------------------------ ids
class ChunkEncoder:
    """Token ids of texts by the tokenizers library, one white-space-separated chunk at a time.

    For a tokenizer whose words never hold white space, a text's ids are those
    of its chunks put end to end; chunks seen before are kept.  A word in
    letters below U+0180, alone or before ASCII marks, is given to the
    library's model directly, as normalisation and splitting leave it alone.
    Any other tokenizer encodes whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.by_chunk = (kinds == ["NFC", "Replace", "Lowercase"] and split.get("behavior") == "Removed"
                         and split.get("invert") is True and not spec.get("truncation") and not spec.get("padding"))
        self.alphabet = byte_alphabet()
        self.words: dict[str, bytes] = {}
        self.forget(0)

    def forget(self, kept: int) -> None:
        """Keep the ``kept`` chunks that came last: their bytes, the number of their ids, and the ids, end to end."""
        if kept:
            n = len(self.size) - kept
            self.flat = self.flat[self.size[:n].sum():].copy()
            self.chunks, self.size = pa.concat_arrays([self.chunks[n:]]), self.size[n:].copy()
        else:
            self.chunks, self.size, self.flat = pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _whole(self, text: str) -> bytes:
        return array.array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        known = self.words.get(word)
        if known is None:
            symbols = word if word.isascii() else "".join([self.alphabet[b] for b in word.encode("utf-8")])
            if len(self.words) > KEEP_WORDS:
                self.words = {}
            known = self.words[word] = array.array("I", [t.id for t in self.library.model.tokenize(symbols)]).tobytes()
        return known

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8")
        body = text.rstrip(_MARKS)
        if body.isalpha() and max(body) < "ƀ" and "İ" not in body:
            return self._word(body.lower()) + (self._word(text[len(body):]) if len(body) < len(text) else b"")
        return self._whole(text)

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        if not self.by_chunk:
            return [np.frombuffer(self._whole(t.decode("utf-8")), "<u4") for t in texts]
        whole = b" \n ".join([t.translate(_BLANK) for t in texts])  # no text holds a line feed any more
        tokens = pc.split_pattern(pa.array([whole], pa.large_binary()), b" ").values.dictionary_encode()
        at, chunks = tokens.indices.to_numpy(), tokens.dictionary
        if len(self.size) > KEEP:
            self.forget(KEEP // 2)
        place = self._remember(chunks)
        first = np.cumsum(self.size) - self.size
        n = self.size[place][at]
        ends = np.cumsum(n)
        out = self.flat[np.arange(ends[-1]) + np.repeat(first[place][at] - (ends - n), n)]
        border = pc.fill_null(pc.equal(chunks, b"\n"), False).to_numpy(zero_copy_only=False)[at]
        return np.split(out, ends[border])[:len(texts)]

    def _remember(self, chunks: pa.Array) -> np.ndarray:
        """Places of distinct chunks among those remembered; new ones are encoded."""
        place = pc.index_in(chunks, value_set=self.chunks)
        missing = place.is_null()
        new = chunks.filter(missing)
        place = pc.fill_null(place, 0).to_numpy().astype(np.int64)
        place[missing.to_numpy(zero_copy_only=False)] = len(self.size) + np.arange(len(new))
        values = [b"" if c in (b"", b"\n") else self._chunk(c) for c in new.to_pylist()]
        self.chunks = pa.concat_arrays([self.chunks, new])
        self.size = np.concatenate([self.size, np.fromiter([len(v) // 4 for v in values], np.int64, len(values))])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(values), "<u4")])
        return place


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


# ------------------------------------------------------------------ jobs
def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int | None = 1,
              id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write the files below ``path`` in ascending id order."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Text and row number part rows that share an id, so that no id fills a partition.
    order = [F.col("id"), F.xxhash64("text"), F.col("row")]
    ordered = (rows.withColumn("row", F.monotonically_increasing_id())
               .repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text"))
    tail = np.zeros(0, "<u4") if end_id is None else np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        names: list[int | None] = []
        texts: list[np.ndarray] = []
        held = 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([segment(names, texts)], pa.binary())], ["segment"])

        for batch in slices(batches, "text", 4 << 20):
            for name, ids in zip(batch.column("id").to_pylist(), own.ids(text_bytes(batch.column("text")))):
                names.append(name)
                texts.append(np.concatenate([ids, tail]))
                held += len(texts[-1])
                if held >= SEGMENT_IDS:
                    yield flush()
                    names, texts, held = [], [], 0
        if names:
            yield flush()

    # A row of the text writer is its bytes and 0x0A, which closes the segment.  The cast leaves
    # bytes as they are (Spark's strings are bytes; nothing checks that they are UTF-8).
    (ordered.mapInArrow(run, "segment binary").select(F.col("segment").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", FILE_SEGMENTS).text(path))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, content) of the files below ``path``; names sort as their ids do."""
    return spark.read.format("binaryFile").load(path).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids array<bigint>) of every document in the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                for one in segments(content):
                    ids, cuts = one.ids().astype(np.int64), np.concatenate([[0], np.cumsum(one.sizes)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one.doc_ids, pa.int64()), pa.ListArray.from_arrays(cuts, ids)], ["doc_id", "ids"])
    return read_files(spark, path).mapInArrow(run, "doc_id bigint, ids array<bigint>")


def digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist()):
                base = 0
                for one in segments(content):
                    ids = one.ids().astype("<u4").tobytes()
                    cuts = np.concatenate([[0], np.cumsum(one.sizes)])
                    sums = [zlib.crc32(ids[4 * a:4 * b]) for a, b in itertools.pairwise(cuts.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(sums), pa.string()), pa.array(one.doc_ids, pa.int64()),
                         pa.array(base + cuts[:-1], pa.int64()), pa.array(one.sizes, pa.int64()),
                         pa.array(sums, pa.int64())], ["file", "doc_id", "at", "n_tokens", "ids_crc32"])
                    base += one.n_ids

    docs = saved(read_files(spark, path).mapInArrow(
        run, "file string, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"), "ids-digest")
    # One row per file: the ids in the files before it.
    files = docs.groupBy("file").agg(F.sum("n_tokens").alias("ids")).select(
        F.col("file").alias("of"), (F.sum("ids").over(Window.orderBy("file")) - F.col("ids")).alias("base"))
    return docs.join(files, docs["file"] == files["of"]).select(
        "doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, vocabulary: str, **kwargs) -> DataFrame:
    """Write the files to a fresh scratch folder and return their digest."""
    path = scratch_dir(docs.sparkSession, "llm-token-ids")
    write_ids(docs, path, vocabulary, **kwargs)
    return digest(docs.sparkSession, path)
