r"""Katz backoff language model over hashed words.

Tokens are ASCII-lower-cased words and one end per text; a word's identity is
``KEY_BITS`` bits of its hash, a word pair's the same of both (two of a billion
keys share one with a chance of about a thousandth of a percent each, and then
only their counts are summed).

1. Documents are packed into chunks of about ``CHUNK_TOKENS`` tokens: a chunk's
   distinct words in order of frequency, and its tokens as numbers of these.
2. Level by level, each chunk sends its sorted distinct n-grams with training counts to key
   ranges (uniform, as keys are hashes, so no word is hot; counts are summed in
   the chunk first).  A range adds them up.  It stores its part of the level's count table, a row
   for each range, and, beside it, the answers that scoring reads: for each chunk
   the totals in the order asked, and whether this chunk owns the key.  An n-gram is sent only if
   both n-grams of the level below inside it are held by other chunks too, which a bit map
   of fixed size tells: what one chunk holds alone is counted there, and its chunk is its table.
3. Counts of counts give the Good-Turing discounts of each level: with ``n_r`` keys seen
   ``r`` times, r* = (r + 1) n_{r+1} / n_r up to ``K``, corrected so that larger
   counts lose only the small ``beta`` each; every history thus keeps some mass.
4. Each chunk evaluates its tokens recursively: P(w | h) = c*(h, w) / c(h) if the n-gram was
   seen, else alpha(h) P(w | h without its first word), or the latter alone if h was not
   seen; P(w) = c*(w) / N, else the mass left over, which stands for one unseen word.
   A history's weight is exactly the mass its discounts leave over the lower level's mass
   of what did not follow it: alpha(h) = (sum of c - c*) / c(h) / (1 - sum of P(w | shorter h)
   over seen w).  What followed h was seen after the shorter history, too, so these are plain
   ratios of counts that the chunk has.  Owners of n-grams add both sums up by history;
   only texts with unseen n-grams wait for alpha.  Contexts end at a text's start: its first
   word has the start as its history, the second the start and the first.

Defined cases: null and empty texts are one end token; a null id counts as the
empty text for the fold; every row is scored, repeated rows alike; without
training texts the one unseen word has probability 1.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import blank_words, slices, text_bytes
from tessera.session import scratch_dir

KEY_BITS, K, ORDER = 56, 5, 3
CHUNK_TOKENS, CHUNK_DOCS = 1_000_000, 1 << 16
#: Bits of the map of shared keys (8 MB, sent to every task); groups in which own keys' tallies are added up.
MAP_BITS, OWN_GROUPS = 26, 64
#: Keys that one range adds up in memory, about.
RANGE_KEYS = 3_000_000
_PLANES = KEY_BITS // 8
_ODD = np.uint64(0x9E3779B97F4A7C15)
_DROP = np.uint64(64 - KEY_BITS)


# ------------------------------------------------------------------ packing
def pack(values: np.ndarray, planes: int) -> bytes:
    """Unsigned numbers below 256**planes as compressed byte planes, after their count."""
    raw = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes, planes: int) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(pa.decompress(data[8:], decompressed_size=n * planes, codec="zstd", asbytes=True), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :planes] = raw.reshape(planes, n).T
    return out.view("<u8")[:, 0]


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)), _PLANES)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, _PLANES), dtype=np.uint64)


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - KEY_BITS)


#: No word holds white space.
END, START = word_key(b"\n"), word_key(b"\n\n")


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = (left * _ODD) ^ (right + (left >> np.uint64(7)))
    x = (x ^ (x >> np.uint64(31))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))) >> _DROP


# ------------------------------------------------------------------ chunks
_CHUNK = ("chunk bigint, ids array<bigint>, train array<boolean>, sizes array<bigint>, words binary, tokens binary, "
          "n_tokens bigint")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, n = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 24, 0
    ids, train, texts, held = [], [], [], 0

    def flush() -> pa.RecordBatch:
        words, number, count = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.arange(len(order), dtype=np.uint64)
        return pa.RecordBatch.from_arrays(
            [pa.array([first + n]), pa.array([ids], pa.list_(pa.int64())), pa.array([train], pa.list_(pa.bool_())),
             pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([pack(words[order], _PLANES)], pa.binary()),
             pa.array([pack(rank[number], 4)], pa.binary()), pa.array([held])],
            ["chunk", "ids", "train", "sizes", "words", "tokens", "n_tokens"])

    for batch in slices(batches, "text"):
        for name, fold, text in zip(batch.column("id").to_pylist(), batch.column("train").to_pylist(), text_bytes(batch.column("text"))):
            words = blank_words(text)
            keys = np.full(len(words) + 1, END, np.uint64)
            keys[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> _DROP
            ids.append(name)
            train.append(fold)
            texts.append(keys)
            held += len(keys)
            if held >= CHUNK_TOKENS or len(ids) >= CHUNK_DOCS:
                yield flush()
                ids, train, texts, held, n = [], [], [], 0, n + 1
    if ids:
        yield flush()


class Chunk:
    """A chunk's tokens, its distinct n-grams of each level in key order, and which documents they come from.

    An n-gram of a token is the token after the (n-1)-gram of the token before; a text's first token comes after START.
    """

    def __init__(self, row: dict, order: int):
        self.words, self.tokens = unpack(row["words"], _PLANES), unpack(row["tokens"], 4).astype(np.int64)
        self.sizes, self.train = np.array(row["sizes"], np.int64), np.array(row["train"], bool)
        ends = np.cumsum(self.sizes)
        self.starts = ends - self.sizes
        self.trained = np.repeat(self.train, self.sizes)  # by token
        self.by_key = np.argsort(self.words)  # words in key order
        word = self.words[self.tokens]
        before = np.roll(word, 1)
        before[self.starts] = START
        #: By level from 2 on: sorted keys, a token of each, each token's place (-1 where the text is too short).
        self.keys: dict[int, np.ndarray] = {}
        self.first: dict[int, np.ndarray] = {}
        self.at: dict[int, np.ndarray] = {}
        known = np.ones(len(word), bool)
        for level in range(2, order + 1):
            if level > 2:
                known[np.minimum(self.starts + level - 3, ends - 1)] = False  # no token so far back
                before = np.roll(now, 1)
            now = pair_keys(before, word)
            tokens = np.flatnonzero(known)
            self.keys[level], first, place = np.unique(now[tokens], return_index=True, return_inverse=True)
            self.first[level] = tokens[first]
            self.at[level] = np.full(len(word), -1, np.int32)
            self.at[level][tokens] = place

    def counts(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of a level, how often training texts hold each, and how often others do."""
        keys, each = (self.words[self.by_key], self.tokens) if level == 1 else (self.keys[level], self.at[level])
        train, held = (np.bincount(each[side & (each >= 0)], minlength=len(keys)) for side in (self.trained, ~self.trained))
        return (keys, train[self.by_key], held[self.by_key]) if level == 1 else (keys, train, held)


    def asked(self, level: int, maps: dict[int, np.ndarray]) -> np.ndarray:
        """Which keys of a level other chunks may hold too: those whose two n-grams of the level below are shared.

        A bit of ``maps`` covers several keys, so some keys are asked for nothing; none is left out wrongly.
        """
        if level == 1:
            return np.ones(len(self.words), bool)
        below = self.asked(level - 1, maps)
        keys = self.words[self.by_key] if level == 2 else self.keys[level - 1]
        at = keys >> np.uint64(KEY_BITS - MAP_BITS)
        shared = below & ((maps[level - 1][(at >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 > 0)
        if level == 2:
            by_number = np.zeros(len(shared), bool)
            by_number[self.by_key] = shared
            token = by_number[self.tokens]
        else:
            place = self.at[level - 1]
            token = (place >= 0) & shared[place]
        before = np.roll(token, 1)
        before[self.starts] = True  # START is everywhere
        first = self.first[level]
        return token[first] & before[first]


def _range_ends(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of ``ranges`` equal parts of the key space begins in sorted keys, and the end."""
    bounds = (np.arange(ranges + 1, dtype=object) << KEY_BITS) // ranges
    return np.searchsorted(keys, bounds[:-1].astype(np.uint64)).tolist() + [len(keys)]


_ASKED = "part int, chunk bigint, keys binary, train binary, held binary, tally array<bigint>"
_COUNTED = "kind string, level int, part int, chunk bigint, keys binary, counts binary, flags binary, tally array<bigint>"


def _tally(counts: np.ndarray) -> list[int]:
    """Keys seen 1 to K + 1 times, all keys seen, all occurrences."""
    known = counts[counts > 0]
    return [*np.bincount(np.minimum(known, K + 2), minlength=K + 3)[1:K + 2].tolist(), len(known), int(known.sum())]


def _unpacked(maps: dict[int, Broadcast]) -> dict[int, np.ndarray]:
    return {level: np.frombuffer(m.value, np.uint8) for level, m in maps.items()}


def _ask(level: int, parts: int, maps: dict[int, Broadcast]):
    """Keys that other chunks may hold, by range; the others are this chunk's own, and only tallied."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _unpacked(maps)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk(row, level)
                keys, train, held = chunk.counts(level)
                asked = chunk.asked(level, known)
                out = [(-1 - row["chunk"] % OWN_GROUPS, row["chunk"], None, None, None, _tally(train[~asked]))]
                keys, train, held = keys[asked], train[asked], held[asked]
                ends = _range_ends(keys, parts)
                out += [(p, row["chunk"], pack_sorted(keys[a:b]), pack(train[a:b], 4), pack(held[a:b] > 0, 1), None)
                        for p, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
                types = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 ["part", "chunk", "keys", "train", "held", "tally"])
    return run


def _add_up(level: int, parts: int):
    """One range: its part of the count table, the answers to its chunks, counts of counts, and the map of shared keys."""
    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        if part < 0:  # keys that chunks keep to themselves
            tally = np.array(table["tally"].to_pylist(), np.int64).sum(0).tolist()
            rows = [("tally", level, part, None, None, None, None, tally)]
        else:
            table = table.sort_by("chunk")  # the first chunk that holds a key owns it
            keys = [unpack_sorted(x) for x in table["keys"].to_pylist()]
            sizes = [len(k) for k in keys]
            train = np.concatenate([unpack(x, 4) for x in table["train"].to_pylist()]).astype(np.int64)
            held = np.concatenate([unpack(x, 1) for x in table["held"].to_pylist()]).astype(np.int64)
            every, first, number, chunks = np.unique(np.concatenate(keys), return_index=True, return_inverse=True, return_counts=True)
            total = np.bincount(number, train, len(every)).astype(np.int64)
            outside = np.bincount(number, held, len(every)) > 0
            owned = np.zeros(len(train), bool)
            owned[first] = True
            flags = owned + 2 * outside[number]
            cuts = np.cumsum([0, *sizes]).tolist()
            rows = [("answer", level, part, c, None, pack(total[number[a:b]], 5), pack(flags[a:b], 1), None)
                    for c, a, b in zip(table["chunk"].to_pylist(), cuts, cuts[1:])]
            seen = total > 0
            rows.append(("table", level, part, None, pack_sorted(every[seen]), pack(total[seen], 5), None, None))
            rows.append(("tally", level, part, None, None, None, None, _tally(total)))
            first_bit, last_bit = _bits_of(part, parts)
            bits = np.zeros(last_bit - first_bit + 1, bool)
            bits[(every[chunks > 1] >> np.uint64(KEY_BITS - MAP_BITS)).astype(np.int64) - first_bit] = True
            rows.append(("map", level, part, None, pa.compress(np.packbits(bits).tobytes(), codec="zstd", asbytes=True), None, None, None))
        types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                        ["kind", "level", "part", "chunk", "keys", "counts", "flags", "tally"])
    return run


def _bits_of(part: int, parts: int) -> tuple[int, int]:
    """First and last bit of the map that a key range touches."""
    return ((part << KEY_BITS) // parts) >> (KEY_BITS - MAP_BITS), ((((part + 1) << KEY_BITS) // parts) - 1) >> (KEY_BITS - MAP_BITS)


def _map_of(counted: DataFrame, parts: int) -> bytes:
    """The whole map of a level, 2^MAP_BITS bits (8 MB), from its ranges' slices."""
    bits = np.zeros(1 << MAP_BITS, bool)
    for r in counted.where("kind = 'map'").select("part", "keys").toLocalIterator():
        first, last = _bits_of(r["part"], parts)
        n = last - first + 1
        raw = pa.decompress(bytes(r["keys"]), -(-n // 8), codec="zstd", asbytes=True)
        bits[first:last + 1] |= np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)
    return np.packbits(bits).tobytes()


# ------------------------------------------------------------------ discounts
class Discount:
    """Good-Turing: what a count of c keeps. ``tally``: keys seen 1..K+1 times, all keys, all occurrences."""

    def __init__(self, tally: list[int]):
        n = [0, *tally[:K + 1]]
        self.types, self.total = tally[K + 1], tally[K + 2]
        common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
        kept = [0.0]
        for r in range(1, K + 1):
            turing = (r + 1) * n[r + 1] / n[r] / r if n[r] else 0.0
            ratio = (turing - common) / (1 - common) if common < 1 else 0.0
            # Where too few keys make the estimate useless, half an occurrence is taken.
            kept.append(r * ratio if 0 < ratio < 1 else r - 0.5)
        self.kept = np.array(kept)
        self.beta = min(0.5, K - kept[K])
        seen = np.array(n[1:K + 1], float)
        self.left = float((seen * (np.arange(1, K + 1) - self.kept[1:])).sum() + self.beta * (self.types - seen.sum()))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts <= K, self.kept[np.minimum(counts, K)], counts - self.beta)


_SCORED = ("kind string, `row` bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
           "base_score double, score double, level int, history bigint, uses bigint, left double, mass double")
_SCHEMA = pa.schema([("kind", pa.string()), ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                     ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                     ("level", pa.int32()), ("history", pa.int64()), ("uses", pa.int64()), ("left", pa.float64()), ("mass", pa.float64())])


def _answered(chunk: Chunk, answers: pa.Table, order: int, maps: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(training count, flags) of every key of the chunk, by level; words in the order of their numbers."""
    got = {level: ([], []) for level in range(1, order + 1)}
    for a in answers.select(["level", "part", "counts", "flags"]).sort_by([("level", "ascending"), ("part", "ascending")]).to_pylist():
        got[a["level"]][0].append(unpack(a["counts"], 5))
        got[a["level"]][1].append(unpack(a["flags"], 1))
    out = {}
    for level, (counts, flags) in got.items():
        _, train, held = chunk.counts(level)
        own = train.astype(np.int64), 1 + 2 * (held > 0)
        asked = chunk.asked(level, maps)
        if counts:
            own[0][asked], own[1][asked] = (np.concatenate(x).astype(np.int64) for x in (counts, flags))
        out[level] = own
    out[1] = tuple(_by_number(chunk, x) for x in out[1])
    return out


def _by_number(chunk: Chunk, values: np.ndarray) -> np.ndarray:
    place = np.zeros(len(chunk.words), np.int64)
    place[chunk.by_key] = values
    return place


def _evaluate(discounts: dict[int, Discount], n_docs: int, maps: dict[int, Broadcast]):
    """Texts' sums, histories' sums over owned n-grams, and the histories that texts back off from."""
    order, one = max(discounts), discounts[1]
    words_total = max(one.total, 1)
    unseen = np.log10(one.left / words_total) if one.total else 0.0

    def run(key: tuple, states: pa.Table, answers: pa.Table) -> pa.Table:
        row = states.to_pylist()[0]
        chunk = Chunk(row, order)
        known = _answered(chunk, answers, order, _unpacked(maps))
        count, flag = known[1]
        before = np.roll(chunk.tokens, 1)
        before[chunk.starts] = len(chunk.words)  # START
        with np.errstate(divide="ignore"):
            single = np.where(count > 0, np.log10(one(count) / words_total), unseen)  # log10 P(w)
        base = np.log10((count + 1) / (one.total + one.types + 1))
        n = len(chunk.sizes)
        rows = np.int64(row["chunk"]) * CHUNK_DOCS * 2 + np.arange(n)
        text = np.repeat(np.arange(n), chunk.sizes)
        # Of the level below: log10 P of each token where nothing is pending, and the history of each token with its count.
        below = single[chunk.tokens]
        # Histories of level 2 are words; those of higher levels are the n-grams of the token before.
        names = np.append(chunk.words, np.uint64(START)).view(np.int64)
        history, size, wanted = before, np.append(count, n_docs), np.append(flag & 2 > 0, True)
        out, seen = [], {}
        score = below.copy()
        for level in range(2, order + 1):
            counts, flags = known[level]
            at = chunk.at[level]
            has = at >= 0  # the text reaches so far back
            c = np.where(has, counts[at] if len(counts) else 0, 0)
            seen[level] = c > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                kept = np.log10(discounts[level](c)) - np.log10(size[history])
            # Mass left by discounts, and the lower level's mass of what followed, over n-grams this chunk owns.
            first = chunk.first[level]
            token = first[(counts > 0) & (flags & 1 == 1)]
            token = token[wanted[history[token]]]  # histories of held-out texts; no other backs off
            own, place = np.unique(history[token], return_inverse=True)
            left = np.bincount(place, c[token] - discounts[level](c[token]), len(own))
            mass = np.bincount(place, 10.0 ** below[token], len(own))
            out.append(pa.table({"kind": pa.array(["history"] * len(own)), "level": pa.array([level] * len(own), pa.int32()),
                                 "history": names[own], "uses": size[own], "left": left.astype(float), "mass": mass.astype(float)}))
            # Tokens that back off from a known history: its weight is applied later.
            off = has & ~seen[level] & (size[history] > 0)
            for higher in range(level + 1, order + 1):  # unless a longer n-gram was seen
                later = chunk.at[higher]
                off &= ~((later >= 0) & (known[higher][0][later] > 0)) if len(known[higher][0]) else True
            off = np.flatnonzero(off)
            both, uses = np.unique(text[off].astype(np.int64) * len(names) + history[off], return_counts=True)
            out.append(pa.table({"kind": pa.array(["back"] * len(both)), "row": rows[both // len(names)],
                                 "level": pa.array([level] * len(both), pa.int32()), "history": names[both % len(names)], "uses": uses}))
            score = np.where(seen[level], kept, score)
            below = kept  # read only where the n-gram was seen, as it is inside every longer one that was
            if level < order:
                names, size, wanted = chunk.keys[level].view(np.int64), counts, flags & 2 > 0
                history = np.roll(at, 1)
        texts = pa.table({
            "kind": pa.array(["text"] * n), "row": rows, "doc_id": pa.array(row["ids"], pa.int64()), "held_out": ~chunk.train,
            "n_tokens": chunk.sizes, "n_known": np.add.reduceat((count > 0)[chunk.tokens].astype(np.int64), chunk.starts),
            "base_score": np.add.reduceat(base[chunk.tokens], chunk.starts), "score": np.add.reduceat(score, chunk.starts)})
        tables = [t.select([c for c in _SCHEMA.names if c in t.schema.names]) for t in (texts, *out)]
        return pa.concat_tables(tables, promote_options="default").select(_SCHEMA.names).cast(_SCHEMA)
    return run


def _stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write by kind (and level), so that a reader of one opens only its files."""
    path = scratch_dir(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def score(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Scores of every row of ``docs`` with n-grams of up to ``order`` words; the model learns from those where
    the column ``train`` is true."""
    if order < 2:
        raise ValueError("an order of 2 at least")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), train.alias("train"), F.col(text_col).alias("text"))
    path = scratch_dir(spark, "llm-katz-chunks")
    rows.mapInArrow(_chunks, _CHUNK).write.option("compression", "none").parquet(path)
    chunks = spark.read.schema(_CHUNK).parquet(path)
    tokens, n_docs = chunks.agg(
        F.coalesce(F.sum("n_tokens"), F.lit(0)),
        F.coalesce(F.sum(F.size(F.filter("train", lambda t: t))), F.lit(0))).first()
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = {1: max(1, wide // 8, -(-tokens // (4 * RANGE_KEYS)))}
    ranges |= {level: max(wide, -(-tokens // RANGE_KEYS)) for level in range(2, order + 1)}
    maps: dict[int, Broadcast] = {}
    answers, discounts = None, {}
    for level, parts in ranges.items():
        counted = _stored(chunks.mapInArrow(_ask(level, parts, maps), _ASKED).groupBy("part").applyInArrow(_add_up(level, parts), _COUNTED),
                          f"llm-katz-counts-{level}", "kind")
        tally = counted.where("kind = 'tally'").agg(F.array(*[F.sum(F.col("tally")[i]) for i in range(K + 3)])).first()[0]
        discounts[level] = Discount([x or 0 for x in tally])
        if level < order:
            maps[level] = spark.sparkContext.broadcast(_map_of(counted, parts))
        own = counted.where("kind = 'answer'").select("chunk", "level", "part", "counts", "flags")
        answers = own if answers is None else answers.unionByName(own)
    scored = _stored(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _evaluate(discounts, n_docs, maps), _SCORED), "llm-katz-scores", "kind")
    weight = F.log10(F.sum("left") / F.max("uses") / (1 - F.sum("mass")))
    alpha = scored.where("kind = 'history'").groupBy("level", "history").agg(weight.alias("alpha"))
    back = (scored.where("kind = 'back'").select("row", "level", "history", "uses").join(alpha, ["level", "history"])
            .groupBy(F.col("row").alias("b_row")).agg(F.sum(F.col("uses") * F.col("alpha")).alias("back")))
    return (scored.where("kind = 'text'").join(back, F.col("row") == F.col("b_row"), "left")
            .select(F.col("doc_id").alias(id_col), "held_out", "n_tokens", "n_known",
                    F.lit(discounts[1].total).cast("long").alias("train_tokens"), "base_score",
                    (F.col("score") + F.coalesce("back", F.lit(0.0))).alias("score")))
