r"""Phrase collocations by multikey three-way quicksort of suffix pointers.

A phrase is 1 to ``DEPTH`` words that stand consecutively in a piece of text.
Every position is a suffix of at most ``DEPTH`` words.  Suffixes are routed over the
cluster by their two leading words; the suffixes that meet in a bucket are sorted by
multikey three-way quicksort: pointers are split at a pivot word into smaller, equal
and greater, the equal part goes on with the next word, and its weight is the
number of occurrences of the words so far.  A part lighter than ``least`` is
abandoned, for no phrase in it is frequent.  All open parts of a bucket are
split together, one numpy pass a round.

What bounds the work: words are counted first, and a bit map of fixed size names
the words that may be frequent; any other ends a suffix.  Equal
suffixes of a chunk are one row with a weight before they are routed, and the suffixes of a
chunk and a bucket travel as one block.  A block names its words by their place in a table of the
``MOST_TOP`` most frequent words, which every task has, and the others by their codes.  A bucket over ``bucket_rows`` is dealt again
by more bits of the same hash, and one that is still too large (one pair of words) by
its suffixes' further words: then counts of two and three words are sums over its shares.

Words are known by 64 bits of a hash of language and word.  The hash of every word that
occurs is looked at before use, and another one is taken if two words share a value, so
counts are exact.

A phrase cut after its first k words scores floor(scale * a / (l + r)), a, l and r the
occurrences of the phrase and its two parts; the lowest cut counts.  Of ties in the
ranking the phrase of smaller bytes comes first.

Defined cases: null and empty texts have no words; a null language reads as ``und``;
rows are independent and repeated rows count again; an empty table gives no phrase;
columns other than text and language are ignored; a text longer than a chunk is
cut at the ends of pieces only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import saved, slices, text_bytes

DEPTH = 4
CHUNK_BYTES, BUCKET_ROWS, MOST_BUCKETS = 4 << 20, 700_000, 4096
#: The bit map of frequent words has at most so many bits (16 MB); it is sent to every task.
MOST_BITS = 1 << 27
#: The table of the most frequent words has at most so many codes (8 MB); it is sent to every task.
MOST_TOP = 1 << 20
_CODES = [f"w{k}" for k in range(1, DEPTH + 1)]
#: ``[.,;:!?\x0A-\x0D]`` end a piece, tabs part words.
_PIECES = bytes(0x0A if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 0x09 else b for b in range(256))


# ------------------------------------------------------------------ words of a chunk
def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[dict[str, list[bytes]]]:
    """Prepared texts by language, about ``chunk_bytes`` at a time."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in slices(batches, "text", chunk_bytes):
        for lang, text in zip(batch.column("lang").to_pylist(), text_bytes(batch.column("text"))):
            text = text.lower().translate(_PIECES)
            at = 0
            while at < len(text):
                end = at + chunk_bytes
                if end < len(text):
                    end = text.find(b"\n", end)
                    end = len(text) if end < 0 else end
                part = text[at:end]
                held.setdefault(lang, []).append(part)
                size, at = size + len(part), end
                if size >= chunk_bytes:
                    yield held
                    held, size = {}, 0
    if held:
        yield held


def _words(texts: dict[str, list[bytes]]) -> tuple[list[tuple[str, pa.Array]], np.ndarray]:
    """Distinct words by language, and the chunk as their numbers (languages one after another), -1 between pieces."""
    names, ids, base = [], [], 0
    for lang, parts in texts.items():
        whole = b"\n".join(parts).replace(b"\n", b" \n ")
        tokens = pc.split_pattern(pa.array([whole], pa.large_binary()), b" ").values.dictionary_encode()
        words, at = tokens.dictionary, tokens.indices.to_numpy()
        plain, breaks = (np.array(pc.fill_null(x, False)) for x in (
            pc.and_(pc.not_equal(words, b""), pc.not_equal(words, b"\n")), pc.equal(words, b"\n")))
        number = np.where(plain, np.cumsum(plain) - 1 + base, np.where(breaks, -1, -2)).astype(np.int32)[at]
        ids += [number[number > -2], np.array([-1], np.int32)]
        names.append((lang, words.filter(pa.array(plain))))
        base += int(plain.sum())
    return names, np.concatenate(ids) if ids else np.zeros(0, np.int32)


def _count(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in _chunks(batches, chunk_bytes):
            names, ids = _words(texts)
            n = np.bincount(ids[ids >= 0], minlength=sum(len(w) for _, w in names))
            at = 0
            for lang, words in names:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), words.cast(pa.large_string()).cast(pa.string()),
                     pa.array(n[at:at + len(words)])], ["lang", "word", "n"])
                at += len(words)
    return run


def _code(salt: str, lang: str, word: bytes) -> int:
    """Equal to Spark's xxhash64 of the same text."""
    return xxhash.xxh64_intdigest(f"{salt}{lang}\t".encode() + word, 42)


def code(salt: str) -> Column:
    return F.xxhash64(F.concat(F.lit(salt), F.col("lang"), F.lit("\t"), F.col("word")))


# ------------------------------------------------------------------ blocks of suffixes
def _mixed(*columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = (out ^ c) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def in_top(codes: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Place of each code in the sorted table ``top``, -1 for others."""
    at = np.minimum(np.searchsorted(top, codes), len(top) - 1)
    return np.where(top[at] == codes, at, -1) if len(top) else np.full(len(codes), -1)


def pack(rows: np.ndarray, weights: np.ndarray, codes: np.ndarray, places: np.ndarray) -> bytes:
    """Rows of ``DEPTH`` places in ``codes`` (in order, so that they compress) and weights; only codes in use are kept.

    ``places`` are the codes' places in the table of frequent words, ascending, then -1.
    """
    used = np.zeros(len(codes), bool)
    used[rows.reshape(-1)] = True
    number = (np.cumsum(used) - 1).astype("<i4")
    known, places = codes[used], places[used]
    n_top = int((places >= 0).sum())
    steps = np.diff(places[:n_top], prepend=0).astype("<i4")
    body = b"".join([np.array([n_top, len(known) - n_top, len(rows)], "<i8").tobytes(), steps.tobytes(), known[n_top:].astype("<u8").tobytes(),
                     np.ascontiguousarray(number[rows].T).tobytes(), weights.astype("<i8").tobytes()])
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unpack(block: bytes, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, weights, codes, places) as packed."""
    body = pa.decompress(block[8:], int.from_bytes(block[:8], "little"), codec="zstd", asbytes=True)
    n_top, n_rest, n = np.frombuffer(body, "<i8", 3).tolist()
    places = np.cumsum(np.frombuffer(body, "<i4", n_top, 24), dtype=np.int64)
    codes = np.concatenate([top[places], np.frombuffer(body, "<u8", n_rest, 24 + 4 * n_top)])
    at = 24 + 4 * n_top + 8 * n_rest
    rows = np.frombuffer(body, "<i4", DEPTH * n, at).reshape(DEPTH, n).T
    return rows, np.frombuffer(body, "<i8", n, at + 4 * DEPTH * n), codes, np.append(places, np.full(n_rest, -1))


_BLOCK = "bucket bigint, `share` bigint, n_rows bigint, block binary"


def _blocks(group: np.ndarray, names: np.ndarray, rows: np.ndarray, weights: np.ndarray, codes: np.ndarray,
            places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each group of suffixes; ``names`` are the (bucket, share) of the groups' numbers."""
    order = np.argsort(group.astype(np.int16 if len(names) < 1 << 15 else np.int64), kind="stable")
    ends = np.cumsum(np.bincount(group, minlength=len(names)))
    for (bucket, share), start, end in zip(names.tolist(), np.append(0, ends[:-1]).tolist(), ends.tolist()):
        if end > start:
            at = order[start:end]
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int64()), pa.array([share], pa.int64()), pa.array([end - start], pa.int64()),
                 pa.array([pack(rows[at], weights[at], codes, places)], pa.binary())], ["bucket", "share", "n_rows", "block"])


def suffixes(ids: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of two words at least, as rows of word numbers with -1 for none, and their counts."""
    columns = [ids]
    for k in range(1, DEPTH):
        later = np.full(len(ids), -1, np.int32)
        later[:-k or None] = ids[k:]
        columns.append(np.where(columns[-1] < 0, np.int32(-1), later))
    here = np.flatnonzero((columns[0] >= 0) & (columns[1] >= 0))
    wide = np.int64(n_words + 1)
    first, second = (columns[k][here].astype(np.int64) * wide + columns[k + 1][here] + 1 for k in (0, 2))
    heads, first = np.unique(first, return_inverse=True)
    tails, second = np.unique(second, return_inverse=True)
    both, n = np.unique(first.astype(np.int64) * len(tails) + second, return_counts=True)
    head, tail = heads[both // max(1, len(tails))], tails[both % max(1, len(tails))]
    rows = np.empty((len(n), DEPTH), np.int32)
    rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3] = head // wide, head % wide - 1, tail // wide, tail % wide - 1
    return rows, n


def _route(salt: str, bits: Broadcast, top: Broadcast, buckets: int, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, table = np.frombuffer(bits.value, np.uint8), np.frombuffer(top.value, np.uint64)
        every = np.stack([np.arange(buckets), np.zeros(buckets, np.int64)], 1)
        for texts in _chunks(batches, chunk_bytes):
            names, ids = _words(texts)
            codes = np.array([_code(salt, lang, w) for lang, words in names for w in words.to_pylist()], np.uint64)
            place = codes & np.uint64(len(frequent) * 8 - 1)
            kept = (frequent[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
            if not kept.any():
                continue
            at = in_top(codes, table)
            # Words of the table come first, in its order, then the others; the last is 0, for none.
            order = np.concatenate([np.flatnonzero(kept & (at >= 0))[np.argsort(at[kept & (at >= 0)])], np.flatnonzero(kept & (at < 0))])
            number = np.full(len(codes) + 1, -1, np.int32)
            number[order] = np.arange(len(order), dtype=np.int32)
            number, codes, places = number[ids], np.append(codes[order], np.uint64(0)), np.append(at[order], -1)
            rows, n = suffixes(number, len(codes))
            if len(rows):
                rows[rows < 0] = len(codes) - 1
                bucket = (_mixed(codes[rows[:, 0]], codes[rows[:, 1]]) % np.uint64(buckets)).astype(np.int64)
                yield from _blocks(bucket, every, rows, n, codes, places)
    return run


def _dealt_again(buckets: int, shares: dict[int, int], by_tail: bool, top: Broadcast):
    """Blocks of buckets that are too large, parted by more bits of the leading words or by the further words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(top.value, np.uint64)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                rows, weights, codes, places = unpack(row["block"], table)
                n = shares[row["bucket"] * MOST_BUCKETS + row["share"] if by_tail else row["bucket"]]
                if by_tail:
                    own = _mixed(codes[rows[:, 2]], codes[rows[:, 3]]) % np.uint64(n)
                    share = row["share"] + MOST_BUCKETS * (1 + np.arange(n))
                else:
                    own = _mixed(codes[rows[:, 0]], codes[rows[:, 1]]) // np.uint64(buckets) % np.uint64(n)
                    share = np.arange(n)
                names = np.stack([np.full(n, row["bucket"]), share], 1)
                yield from _blocks(own.astype(np.int64), names, rows, weights, codes, places)
    return run


# ------------------------------------------------------------------ quicksort
def three_way(rows: np.ndarray, weights: np.ndarray, least: np.ndarray, none: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, a pointer to a suffix of each part, its weight) of the parts of equal leading words.

    ``rows`` are suffixes of word numbers; parts of d + 1 words lighter than ``least[d]``
    are abandoned, and so are those whose last word is ``none``.
    """
    rng = np.random.default_rng(1)
    pointer = np.arange(len(rows))
    start = np.zeros(min(1, len(rows)), np.int64)
    size = np.full(len(start), len(rows), np.int64)
    depth = np.zeros(len(start), np.int64)
    while len(start):
        # Pointers of open parts only, one part after another.
        part = np.repeat(np.arange(len(start)), size)
        first = np.cumsum(size) - size
        pivot = rows[pointer[first + (rng.random(len(size)) * size).astype(np.int64)], depth]
        key = rows[pointer, depth[part]]
        side = (key > pivot[part]).astype(np.int8) - (key < pivot[part])
        places, sizes, sums = [], [], []
        for s in (-1, 0, 1):
            at = np.flatnonzero(side == s)
            places.append(at)
            sizes.append(np.bincount(part[at], minlength=len(size)))
            sums.append(np.bincount(part[at], weights[pointer[at]], len(size)).astype(np.int64))
        equal = (sums[1] >= least[depth]) & (pivot != none)
        heads = pointer[places[1]][np.cumsum(sizes[1]) - sizes[1]]
        for d in range(rows.shape[1]):
            told = equal & (depth == d)
            if told.any():
                yield d + 1, heads[told], sums[1][told]
        stay = [sums[0] >= least[depth], equal & (depth + 1 < rows.shape[1]), sums[2] >= least[depth]]
        pointer = np.concatenate([pointer[at[keep[part[at]]]] for at, keep in zip(places, stay)])
        start = np.concatenate([np.flatnonzero(keep & (n > 0)) for keep, n in zip(stay, sizes)])
        size = np.concatenate([n[keep & (n > 0)] for keep, n in zip(stay, sizes)])
        depth = np.concatenate([(depth + more)[keep & (n > 0)] for keep, n, more in zip(stay, sizes, (0, 1, 0))])


_FOUND = "size int, " + ", ".join(f"{c} bigint" for c in _CODES) + ", a bigint, whole boolean"


def _sorted(least: int, top: Broadcast):
    """Frequent phrases of one bucket and share; those that other shares also hold count in part (not ``whole``)."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        known = np.frombuffer(top.value, np.uint64)
        parts = [unpack(b, known)[:3] for b in table["block"].to_pylist()]
        words = np.unique(np.concatenate([c for _, _, c in parts]))
        rows = np.concatenate([np.searchsorted(words, c).astype(np.int32)[r] for r, _, c in parts])
        weights = np.concatenate([w for _, w, _ in parts])
        del parts
        none = 0 if len(words) and words[0] == 0 else -1
        shared = key[1].as_py() >= MOST_BUCKETS  # dealt by further words
        limits = np.array([least, 1, 1, least] if shared else [least] * DEPTH)
        if shared:
            limits[0] = 1
        out = []
        for n, heads, sums in three_way(rows, weights, limits, none):
            if n == 1:
                continue
            found = words[rows[heads]]
            found[:, n:] = 0
            out.append(pa.table({"size": pa.array([n] * len(sums), pa.int32()),
                                 **{c: found[:, k].view(np.int64) for k, c in enumerate(_CODES)},
                                 "a": sums, "whole": pa.array([n == DEPTH or not shared] * len(sums))}))
        schema = pa.schema([("size", pa.int32()), *[(c, pa.int64()) for c in _CODES], ("a", pa.int64()), ("whole", pa.bool_())])
        return pa.concat_tables(out).cast(schema) if out else schema.empty_table()
    return run


# ------------------------------------------------------------------ jobs
def count_words(docs: DataFrame, text_col: str, lang_col: str, chunk_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(lang, word, n) of every word, and the rows (text, lang) that were counted."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(_count(chunk_bytes), "lang string, word string, n bigint")
    return saved(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "collocation-words"), rows


def injective_salt(words: DataFrame, salt: str = "") -> str:
    """A salt with which no two words share a code and none has code 0."""
    while True:
        codes = words.groupBy(code(salt).alias("code")).agg(F.count("*").alias("n")).where("n > 1 or code = 0")
        if codes.isEmpty():
            return salt
        salt += "+"


def frequent_bits(frequent: DataFrame) -> bytes:
    """The bit map of the codes of frequent words, of a power of two bits up to ``MOST_BITS``."""
    n = 1 << 15
    while n < min(MOST_BITS, 16 * frequent.count()):
        n *= 2
    at = F.col("code").bitwiseAND(F.lit(n - 1)) + 1
    maps = frequent.groupBy(F.bitmap_bucket_number(at).alias("number")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()  # at most MOST_BITS / 8 bytes
    out = bytearray(n // 8)
    for r in maps:
        begin = (r["number"] - 1) * 4096
        out[begin:begin + 4096] = r["bits"]
    return bytes(out)


def frequent_table(frequent: DataFrame) -> np.ndarray:
    """Sorted codes of the ``MOST_TOP`` most frequent words."""
    top = frequent.orderBy(F.desc("n"), "code").limit(MOST_TOP).select("code").toArrow()["code"].to_numpy()
    return np.sort(top.view(np.uint64))


def frequent_phrases(rows: DataFrame, frequent: DataFrame, salt: str, least: int, chunk_bytes: int = CHUNK_BYTES,
                     bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(size, w1..w4, a): every phrase of 2 to ``DEPTH`` words that occurs ``least`` times or more; 0 is no word."""
    buckets = int(min(MOST_BUCKETS, max(1, (frequent.agg(F.sum("n")).first()[0] or 0) // bucket_rows)))
    spark = frequent.sparkSession.sparkContext
    bits, top = spark.broadcast(frequent_bits(frequent)), spark.broadcast(frequent_table(frequent).tobytes())
    blocks = saved(rows.mapInArrow(_route(salt, bits, top, buckets, chunk_bytes), _BLOCK), "collocation-blocks")
    # Buckets are few (MOST_BUCKETS) and so are those of their shares that are dealt again.
    held = {r["bucket"]: r["n"] for r in blocks.groupBy("bucket").agg(F.sum("n_rows").alias("n")).collect()}
    large = {b: min(MOST_BUCKETS - 1, -(-n // bucket_rows)) for b, n in held.items() if n > 2 * bucket_rows}
    if large:
        again = saved(blocks.where(F.col("bucket").isin(list(large))).mapInArrow(
            _dealt_again(buckets, large, False, top), _BLOCK), "collocation-blocks")
        group = again.groupBy("bucket", "share").agg(F.sum("n_rows").alias("n")).where(F.col("n") > 2 * bucket_rows).collect()
        hot = {r["bucket"] * MOST_BUCKETS + r["share"]: -(-r["n"] // bucket_rows) for r in group}
        blocks = blocks.where(~F.col("bucket").isin(list(large)))
        if hot:
            name = F.col("bucket") * MOST_BUCKETS + F.col("share")
            tails = saved(again.where(name.isin(list(hot))).mapInArrow(
                _dealt_again(buckets, hot, True, top), _BLOCK), "collocation-blocks")
            again = again.where(~name.isin(list(hot))).unionByName(tails)
        blocks = blocks.unionByName(again)
    found = saved(blocks.groupBy("bucket", "share").applyInArrow(_sorted(least, top), _FOUND), "collocation-found")
    parts = found.where("not whole").groupBy("size", *_CODES).agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return saved(found.where("whole").drop("whole").unionByName(parts), "collocation-phrases")


def _slot(columns: list[Column]) -> list[Column]:
    return [c if c is not None else F.lit(0).cast("bigint") for c in (*columns, *[None] * (DEPTH - len(columns)))]


def _sub(size: int, first: int, n: int) -> Column:
    """Words ``first`` to ``first + n`` of a phrase as a struct."""
    slots = _slot([F.col(_CODES[first + k]) for k in range(n)])
    return F.struct(*[c.alias(f"v{k + 1}") for k, c in enumerate(slots)])


def _by_size(make) -> Column:
    """An array that depends on the phrase's size."""
    return reduce(lambda rest, size: F.when(F.col("size") == size, make(size)).otherwise(rest), range(3, DEPTH + 1), make(2))


def _on(side: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{side}.v{k}") == F.col(f"{side}_{c}") for k, c in enumerate(_CODES, 1)])


def _counts(phrases: DataFrame, side: str) -> DataFrame:
    return phrases.select(*[F.col(c).alias(f"{side}_{c}") for c in _CODES], F.col("a").alias(side[0]))


def scored(candidates: DataFrame, counts: DataFrame, scale: int) -> DataFrame:
    """``candidates`` with l, r and score of their lowest cut."""
    cuts = _by_size(lambda size: F.array(*[
        F.struct(F.lit(k).alias("k"), _sub(size, 0, k).alias("left"), _sub(size, k, size - k).alias("right")) for k in range(1, size)]))
    each = candidates.withColumn("cut", F.explode(cuts)).select("*", "cut.k", "cut.left", "cut.right").drop("cut")
    both = (each.join(_counts(counts, "left"), _on("left")).join(_counts(counts, "right"), _on("right")))
    whole = (F.col("a").cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)"))
    score = F.floor(whole / (F.col("l") + F.col("r")).cast("decimal(20,0)")).cast("long")
    # Decimal division rounds at its last place; the remainder tells whether it went past a whole number.
    score = score - F.when(score.cast("decimal(20,0)") * (F.col("l") + F.col("r")).cast("decimal(18,0)") > whole, 1).otherwise(0)
    return (both.withColumn("s", score).groupBy("size", *_CODES, "a").agg(F.min(F.struct("s", "k", "l", "r")).alias("best"))
            .select("size", *_CODES, "a", "best.l", "best.r", F.col("best.s").alias("score")))


def inside_longer(phrases: DataFrame, percent: int) -> DataFrame:
    """(v1..v4) of the phrases that occur mostly inside a longer one; joined by value to the candidates' own count."""
    subs = _by_size(lambda size: F.array(*[_sub(size, first, n) for n in range(2, size) for first in range(size - n + 1)])
                    if size > 2 else F.array().cast("array<struct<" + ",".join(f"v{k + 1}:bigint" for k in range(DEPTH)) + ">>"))
    return (phrases.where("size > 2").select("a", F.explode(subs).alias("sub")).groupBy("sub")
            .agg((F.max("a").cast("decimal(20,0)") * 100).alias("hundred")).select("sub.*", "hundred"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, percent: int = 80,
                 keep: int | None = 2000, scale: int = 2_000_000, chunk_bytes: int = CHUNK_BYTES,
                 bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language; all of them if ``keep`` is None."""
    words, rows = count_words(docs, text_col, lang_col, chunk_bytes)
    salt = injective_salt(words)
    frequent = saved(words.where(F.col("n") >= least).select(code(salt).alias("code"), "lang", "word", "n"), "collocation-frequent")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    phrases = frequent_phrases(rows, frequent, salt, least, chunk_bytes, bucket_rows)
    nothing = [F.lit(0).cast("bigint").alias(c) for c in _CODES[1:]]
    counts = phrases.select(*_CODES, "a").unionByName(frequent.select(F.col("code").alias("w1"), *nothing, F.col("n").alias("a")))
    longer = inside_longer(phrases, percent)
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"v{k}") for k, c in enumerate(_CODES, 1)])
    candidates = phrases.join(longer, same & (F.col("hundred") >= F.col("a").cast("decimal(20,0)") * percent), "left_anti")
    ranked = scored(candidates, counts, scale).join(frequent.select(F.col("code").alias("w1"), "lang"), "w1")
    if keep is not None:
        # Ties at the border stay until their words are known.
        border = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
        ranked = ranked.withColumn("border", border).where(F.col("border") <= keep).drop("border")
    ranked = saved(ranked, "collocation-ranked")
    spelled = (ranked.select(*_CODES, F.posexplode(F.array(*_CODES)).alias("pos", "code")).where("code != 0")
               .join(frequent.select("code", "word"), "code").groupBy(*_CODES)
               .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda s: s["word"]), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    out = ranked.join(spelled, _CODES).withColumn("rank", F.row_number().over(order))
    if keep is not None:
        out = out.where(F.col("rank") <= keep)
    return out.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
