r"""MinHash near-duplicates by an inverted join over signature coordinates.

A document's set is its distinct word shingles; its signature has ``COORDINATES``
minima.  Documents of equal sets form a class, and only classes are joined.
Each class is posted under its (coordinate, value) pairs.  Two sets as similar
as asked agree in at least ``threshold`` coordinates (but for a chance below
``MISS``), so, in any one order of all pairs, they meet under one of each class's
first ``COORDINATES - threshold + 1`` pairs: only this prefix is posted.  The order
puts pairs that are frequent in a sample of classes last and is the hash of the pair
otherwise; the sample bears on cost alone.  Only (pair, class) is shuffled; a
pair that one class posts is dropped, and the signatures are looked up for what is left.

In a list, collisions are counted by merging the members' signatures a run of
coordinates at a time; a pair of members that can no longer reach the threshold is
skipped.  A long list is cut into tiles by hash and pairs of tiles, each a
group of bounded members and shingles.  First each class keeps its best smaller
partner; these are confirmed on the full sets and joined to parts.  Then the members of a
list that agree enough with a member of another part are marked, a row for each
marked member, not for each pair; their texts are fetched, and inside the group
their full sets are held against each other by counting over shingles.  Members
whose parts are joined already are not compared, so a group sends fewer links than it has members.
A group of copies is never expanded into its pairs, and no two parts
that a link joins stay apart.

Defined cases: null, empty or white-space texts have an empty set, link with
nothing and are kept; texts of fewer words than a shingle have one shingle, the
whole sequence; ties go to the smallest id; rows without id link with nothing,
are kept, and have no component; rows that share an id but not the text each
follow their own text's set.  Extra columns are ignored by ``near_duplicates`` and
kept by ``deduplicate``, which keeps one row of every component (the smallest id,
then the smallest hash of the text) and rows without words or id as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import blank_words, saved, slices, text_bytes
from tessera.llm.components import components

COORDINATES, MISS = 48, 1e-6
#: Members and shingles of a tile, at about the most.
TILE, TILE_SHINGLES = 1024, 1 << 20
#: One class in so many is sampled for frequent pairs, of which at most so many are told to all tasks (8 bytes each).
SAMPLED, MOST_FREQUENT = 32, 200_000
#: Coordinates that are merged before a pair of members may be skipped.
MERGED = 16
#: Up to this many ids (8 bytes each) are broadcast to pick their texts; more are joined by shuffle.
BROADCAST_IDS = 1_000_000
_RNG = np.random.default_rng(5)
_FACTORS = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def match_threshold(coordinates: int, similarity: float, miss: float) -> int:
    """The most coordinates that two sets of this similarity share with probability 1 - ``miss`` at least."""
    below, t = 0.0, 0
    while below + (p := math.comb(coordinates, t) * similarity ** t * (1 - similarity) ** (coordinates - t)) <= miss:
        below, t = below + p, t + 1
    return t


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = blank_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(size, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        out = (out ^ h[j:len(out) + j]) * _STEP
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """Minimum of each coordinate's hash over a set that is not empty."""
    out = np.full(coordinates, 2**32 - 1, np.uint64)
    for at in range(0, len(hashes), 2048):
        part = (hashes[None, at:at + 2048] * _FACTORS[:coordinates, None] + _SHIFTS[:coordinates, None]) >> np.uint64(32)
        out = np.minimum(out, part.min(1))
    return out


_ROWS = "id bigint, text_hash bigint, n bigint, set_a bigint, set_b bigint, signature array<int>, marks binary"


def _signatures(size: int, coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n, digest, keys = [], [], []
            for text in text_bytes(batch.column("text")):
                hashes = shingle_hashes(text, size)
                n.append(len(hashes))
                digest.append(xxhash.xxh128_digest(hashes.tobytes()))
                keys.append(signature(hashes, coordinates).astype(np.uint32).view(np.int32) if len(hashes) else None)
            # A byte of each minimum: enough to count agreement (chance agreement only adds candidates).
            marks = [None if k is None else k.astype(np.uint8).tobytes() for k in keys]
            sides = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(sides[:, 0]), pa.array(sides[:, 1]),
                 pa.array(keys, pa.list_(pa.int32())), pa.array(marks, pa.binary())],
                ["id", "text_hash", "n", "set_a", "set_b", "signature", "marks"])
    return run


# ------------------------------------------------------------------ posting
def pair_keys(signatures: np.ndarray) -> np.ndarray:
    """(coordinate, value) of every minimum as one number."""
    at = np.arange(signatures.shape[1], dtype=np.uint64) << np.uint64(32)
    return at | signatures.astype(np.int32).view(np.uint32).astype(np.uint64)


def prefixes(keys: np.ndarray, frequent: np.ndarray, levels: np.ndarray, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``prefix`` keys of every row in the order of (frequency in the sample, hash), and whether each is frequent."""
    level = np.zeros(keys.shape, np.uint64)
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        level = np.where(frequent[place] == keys, levels[place], 0).astype(np.uint64)
    mixed = keys * _STEP
    mixed ^= mixed >> np.uint64(29)
    order = np.argsort((level << np.uint64(56)) | (mixed >> np.uint64(8)), axis=1, kind="stable")[:, :prefix]
    return np.take_along_axis(keys, order, 1), np.take_along_axis(level, order, 1) > 0


def _post(prefix: int, frequent: Broadcast):
    """(key, class, frequent) of every class's prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(frequent.value, np.uint64).reshape(2, -1)
        for batch in batches:
            if batch.num_rows:
                signatures = batch.column("signature").flatten().to_numpy().reshape(batch.num_rows, -1)
                keys, often = prefixes(pair_keys(signatures), table[0], table[1], prefix)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(batch.column("class").to_numpy(), keys.shape[1])),
                     pa.array(often.reshape(-1))], ["key", "class", "often"])
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those whose key stands more than once."""
    last: pa.RecordBatch | None = None  # the last row so far, and whether its key stood before it
    stood = False
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks().to_batches()[0]
        key = whole.column("key").to_numpy()
        same = key[1:] == key[:-1]
        before = np.concatenate([[stood if last is not None else False], same])
        keep = before | np.concatenate([same, [False]])
        yield whole.slice(0, whole.num_rows - 1).filter(pa.array(keep[:-1]))
        last, stood = whole.slice(whole.num_rows - 1), bool(before[-1])
    if last is not None and stood:
        yield last


def frequent_pairs(classes: DataFrame) -> np.ndarray:
    """Two rows: the pairs that several sampled classes have, sorted, and the bit length of their counts."""
    drawn = classes.where(F.pmod(F.xxhash64("set_a", "set_b"), F.lit(SAMPLED)) == 0)
    key = F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("col").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    counted = drawn.select(F.posexplode("signature")).groupBy(key.alias("key")).agg(F.count("*").alias("n")).where("n > 1")
    top = counted.orderBy(F.desc("n"), "key").limit(MOST_FREQUENT).toArrow()
    keys, n = top["key"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(keys)
    return np.stack([keys[order], np.frexp(n[order].astype(float))[1].astype(np.uint64)])


def _posted(classes: DataFrame, prefix: int) -> DataFrame:
    """(key, tiles, class, n, marks): a row for each list that a class shares with another."""
    frequent = classes.sparkSession.sparkContext.broadcast(frequent_pairs(classes).tobytes())
    rows = saved(classes.select("class", "signature").mapInArrow(_post(prefix, frequent), "key bigint, `class` bigint, often boolean"), "minhash-keys")
    seldom = rows.where("not often").select("key", "class").repartition("key").sortWithinPartitions("key").mapInArrow(
        _shared, "key bigint, `class` bigint")
    often = rows.where("often").select("key", "class")  # long lists: not brought together here
    found = saved(seldom.unionByName(often).join(classes.select("class", "n"), "class"), "minhash-shared")
    lists = found.groupBy("key").agg(F.count("*").alias("members"), F.sum("n").alias("shingles")).where("members > 1").select(
        F.col("key").alias("_key"), F.greatest(F.ceil(F.col("members") / TILE), F.ceil(F.col("shingles") / TILE_SHINGLES)).cast("int").alias("tiles"))
    return found.join(lists, F.col("key") == F.col("_key")).select("key", "tiles", "class").join(
        classes.select("class", "n", "marks"), "class")


_GROUP = ["key", "left", "right"]


def _lists(posted: DataFrame) -> DataFrame:
    """Members of each list or pair of its tiles, sorted so that a group is consecutive."""
    rows = (posted.withColumn("tile", F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))))
    return (rows.select("key", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"), "tile",
                        "class", "part", "n", "marks")
            .repartition(*_GROUP).sortWithinPartitions(*_GROUP, "class"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Consecutive rows as arrays, only whole groups, with each row's group number."""
    held: list[pa.RecordBatch] = []

    def arrays(table: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray]:
        cols = {c: table[c].to_numpy() for c in ("key", "left", "right", "tile", "class", "part", "n")}
        cols["marks"] = np.frombuffer(b"".join(table["marks"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
        new = np.concatenate([[True], (cols["key"][1:] != cols["key"][:-1]) | (cols["left"][1:] != cols["left"][:-1])
                              | (cols["right"][1:] != cols["right"][:-1])])
        return cols, np.cumsum(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        cols, number = arrays(table)
        cut = int(np.searchsorted(number, number[-1]))
        if cut:
            yield {c: v[:cut] for c, v in cols.items()}, number[:cut]
            held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield arrays(pa.Table.from_batches(held))


def collisions(marks: np.ndarray, low: np.ndarray, high: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(which pairs, their equal coordinates) of the row pairs that agree in ``threshold`` coordinates at least.

    Coordinates are merged ``MERGED`` at a time, and pairs that the rest cannot bring there are skipped.
    """
    at, same, width = np.arange(len(low)), np.zeros(len(low), np.int64), marks.shape[1]
    for first in range(0, width, MERGED):
        cols = slice(first, min(first + MERGED, width))
        same = same + (marks[low[at], cols] == marks[high[at], cols]).sum(1)
        alive = same + (width - cols.stop) >= threshold
        at, same = at[alive], same[alive]
    return at, same


def _agreements(cols: dict[str, np.ndarray], number: np.ndarray, threshold: int,
                percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of the smaller class, row of the greater, equal coordinates) of a group's members at or above the threshold.

    Only sets whose sizes allow the similarity, in different parts, and of two tiles unless the group is one tile.
    """
    for d in range(1, int(np.bincount(number).max(initial=0))):
        low = np.flatnonzero(number[d:] == number[:-d])
        high = low + d
        n_low, n_high = cols["n"][low], cols["n"][high]
        fits = (((cols["left"][low] == cols["right"][low]) | (cols["tile"][low] != cols["tile"][high]))
                & (100 * np.minimum(n_low, n_high) >= percent * np.maximum(n_low, n_high))
                & (cols["class"][low] != cols["class"][high]) & (cols["part"][low] != cols["part"][high]))
        low, high = low[fits], high[fits]
        at, same = collisions(cols["marks"], low, high, threshold)
        if len(at):
            yield low[at], high[at], same


def _best(threshold: int, percent: int):
    """Of each class in each stretch of groups, the smaller class that agrees most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, number in _groups(batches):
            most, partner = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
            for low, high, same in _agreements(cols, number, threshold, percent):
                better = same >= most[high]  # on a tie the one farther back, which is smaller
                most[high[better]], partner[high[better]] = same[better], cols["class"][low[better]]
            found = most > 0
            yield pa.RecordBatch.from_arrays([pa.array(x[found]) for x in (cols["class"], partner, most)], ["a", "b", "same"])
    return run


_MARKED = "key bigint, `left` int, `right` int, tile int, `class` bigint, part bigint"


def _marked(threshold: int, percent: int):
    """The members of each group that agree enough with a member of another part; a row for each, not for each pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, number in _groups(batches):
            told = np.zeros(len(number), bool)
            for low, high, _ in _agreements(cols, number, threshold, percent):
                told[low] = told[high] = True
            if told.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[c][told], t) for c, t in (("key", pa.int64()), ("left", pa.int32()), ("right", pa.int32()), ("tile", pa.int32()),
                                                             ("class", pa.int64()), ("part", pa.int64()))],
                    ["key", "left", "right", "tile", "class", "part"])
    return run


def links_between(members: list[tuple[int, int, int, np.ndarray]], one_tile: bool, percent: int) -> Iterator[tuple[int, int]]:
    """Links (class, class) that join the parts of some members (class, part, tile, set) as far as any link does.

    A member is held against all others at once by counting over shared shingles;
    parts that a link has joined are not compared again.
    """
    root: dict[int, int] = {}

    def top(p: int) -> int:
        while root.setdefault(p, p) != p:
            root[p] = p = root[root[p]]
        return p

    if len(members) < 2:
        return
    sizes = np.array([len(m[3]) for m in members])
    every, number = np.unique(np.concatenate([m[3] for m in members]), return_inverse=True)
    owner = np.repeat(np.arange(len(members)), sizes)[np.argsort(number, kind="stable")]
    ends = np.cumsum(np.bincount(number))
    starts = ends - np.bincount(number)
    first = np.cumsum(sizes) - sizes
    tiles = np.array([m[2] for m in members])
    for k, (name, part, tile, hashes) in enumerate(members):
        open_ = np.array([top(m[1]) for m in members]) != top(part)
        open_ &= (100 * np.minimum(sizes, len(hashes)) >= percent * np.maximum(sizes, len(hashes)))
        if not one_tile:
            open_ &= tiles != tile
        open_[:k + 1] = False
        if not open_.any():
            continue
        at = number[first[k]:first[k] + len(hashes)]
        n = ends[at] - starts[at]
        both = np.bincount(owner[np.arange(n.sum()) + np.repeat(starts[at] - (np.cumsum(n) - n), n)], minlength=len(members))
        for other in np.flatnonzero(open_ & (100 * both >= percent * (sizes + len(hashes) - both))).tolist():
            a, b = top(part), top(members[other][1])
            if a != b:
                root[max(a, b)] = min(a, b)
                yield name, members[other][0]


def _verified(shingle: int, percent: int):
    """Links between the marked members of each group, on their full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members = None, []

        def links() -> list[pa.RecordBatch]:
            found = list(links_between(members, group is None or group[1] == group[2], percent))
            return [pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])] if found else []

        for batch in slices(batches, "text", 2 << 20):
            rows = zip(*[batch.column(c).to_pylist() for c in ("key", "left", "right", "class", "part", "tile")], text_bytes(batch.column("text")))
            for *key, name, part, tile, text in rows:
                if key != group:
                    yield from links()
                    group, members = key, []
                members.append((name, part, tile, shingle_hashes(text, shingle)))
        yield from links()
    return run


def _texts(rows: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, text) of the classes named in ``wanted``, each once: a row of the class's smallest id and text hash."""
    named = saved(wanted.distinct().join(classes.select("class", "least_id", "least_text"), "class"), "minhash-ids")
    if named.count() <= BROADCAST_IDS:
        named = F.broadcast(named)
    same = (F.col("id") == F.col("least_id")) & (F.col("text_hash") == F.col("least_text"))
    return saved(rows.join(named, same).select("class", "text").dropDuplicates(["class"]), "minhash-texts")


def _similar(size: int, percent: int):
    """The pairs whose full shingle sets are as similar as asked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", 2 << 20):
            ok, last, left = [], None, None
            for a, b in zip(text_bytes(batch.column("text_a")), text_bytes(batch.column("text_b"))):
                if a != last:
                    last, left = a, shingle_hashes(a, size)
                right = shingle_hashes(b, size)
                both = len(np.intersect1d(left, right, assume_unique=True))
                ok.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])
    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    left = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(_similar(size, percent), "a bigint, b bigint"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, coordinates: int) -> DataFrame:
    """(id, text_hash, n, component, component_id) of every row; ``component`` is NULL without id or words."""
    threshold = match_threshold(coordinates, percent / 100, MISS)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    signed = saved(rows.mapInArrow(_signatures(shingle, coordinates), _ROWS), "minhash-signatures")
    # A class has a number of its own: rows that share an id may be of several classes.
    classes = saved(signed.where("n > 0 and id is not null").groupBy("n", "set_a", "set_b")
                    .agg(F.min(F.struct("id", "text_hash")).alias("least"), F.min("signature").alias("signature"), F.min("marks").alias("marks"))
                    .select("n", "set_a", "set_b", F.col("least.id").alias("least_id"), F.col("least.text_hash").alias("least_text"),
                            "signature", "marks", F.monotonically_increasing_id().alias("class")), "minhash-classes")
    posted = saved(_posted(classes, coordinates - threshold + 1), "minhash-posted")

    best = saved(_lists(posted.withColumn("part", F.col("class"))).mapInArrow(_best(threshold, percent), "a bigint, b bigint, same bigint")
                 .groupBy("a").agg(F.max(F.struct("same", (-F.col("b")).alias("b"))).alias("best"))
                 .select("a", (-F.col("best.b")).alias("b")), "minhash-best")
    texts = _texts(rows, classes, best.select(F.col("a").alias("class")).union(best.select("b")))
    linked = saved(_confirmed(best, texts, shingle, percent), "minhash-linked")
    part = saved(posted.select("class").distinct().join(components(linked), F.col("class") == F.col("node"), "left").select(
        "class", F.coalesce("component", "class").alias("part")), "minhash-parts")
    marked = saved(_lists(posted.join(part, "class")).mapInArrow(_marked(threshold, percent), _MARKED), "minhash-marked")
    texts = _texts(rows, classes, marked.select("class"))
    found = (marked.join(texts, "class").repartition(*_GROUP).sortWithinPartitions(*_GROUP)
             .mapInArrow(_verified(shingle, percent), "a bigint, b bigint"))
    # Only parts are joined now: a graph of the few parts between which a link was found.
    of_a, of_b = (part.select(F.col("class").alias(c), F.col("part").alias(f"part_{c}")) for c in "ab")
    joined = components(saved(found, "minhash-across").join(of_a, "a").join(of_b, "b")
                        .select(F.col("part_a").alias("a"), F.col("part_b").alias("b")))
    whole = part.join(joined, F.col("part") == F.col("node"), "left").select(
        F.col("class").alias("node"), F.coalesce("component", "part").alias("component"))
    of_class = saved(classes.select("n", "set_a", "set_b", "class", "least_id").join(whole, F.col("class") == F.col("node"), "left")
                     .select("n", "set_a", "set_b", "least_id", F.coalesce("component", "class").alias("component")), "minhash-components")
    names = of_class.groupBy(F.col("component").alias("_c")).agg(F.min("least_id").alias("component_id"))
    named = of_class.join(names, F.col("component") == F.col("_c")).select(
        F.col("n").alias("c_n"), F.col("set_a").alias("c_a"), F.col("set_b").alias("c_b"), "component", "component_id")
    same = (F.col("set_a") == F.col("c_a")) & (F.col("set_b") == F.col("c_b")) & (F.col("n") == F.col("c_n")) & F.col("id").isNotNull()
    return signed.select("id", "text_hash", "n", "set_a", "set_b").join(named, same, "left").select(
        "id", "text_hash", "n", "component", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, coordinates: int = COORDINATES) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row; sets are linked at ``percent`` % Jaccard similarity."""
    component = F.coalesce("component_id", "id")
    return _grouped(docs, id_col, text_col, shingle, percent, coordinates).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                percent: int = 80) -> DataFrame:
    """The rows of ``docs``, unchanged: one of every component, and those without words or id."""
    found = saved(_grouped(docs, id_col, text_col, shingle, percent, COORDINATES), "minhash-kept").where("component is not null")
    first = found.groupBy(F.col("component").alias("_c")).agg(F.min(F.struct("id", "text_hash")).alias("first"), F.count("*").alias("rows"))
    told = found.join(first, F.col("component") == F.col("_c"))
    stays = F.struct("id", "text_hash") == F.col("first")
    gone = told.where(~stays).select(F.col("id").alias("__id"), F.col("text_hash").alias("__text")).distinct()
    kept = docs.join(gone, (docs[id_col].cast("long") == F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__text")), "left_anti")
    repeated = saved(told.where(stays & (F.col("rows") > 1)).groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__text")).count()
                     .where("count > 1").select("__id", "__text"), "minhash-repeated")
    if repeated.isEmpty():
        return kept
    # Rows of one id and one text: any of them stays.
    same = (kept[id_col].cast("long") == F.col("__id")) & (F.xxhash64(kept[text_col]) == F.col("__text"))
    once = kept.join(repeated, same, "left_semi")
    return kept.join(repeated, same, "left_anti").unionByName(once.dropDuplicates([id_col, text_col]))
