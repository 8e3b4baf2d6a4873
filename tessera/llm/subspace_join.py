"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine at least ``c`` are at most ``2 - 2c`` apart (squared).
After one fixed rotation the dimensions are split into blocks of about
``BLOCK_DIMS``; of two such vectors at least one block is no farther apart than
the block's share of that distance.  So each block is range-joined under its
own budget, and the union of the candidates is verified by the cosine of the
input vectors in double precision.

The range join of a block parts space by a median tree (fitted on at most
``SAMPLE`` vectors; it affects the cost only).  A vector goes to its own leaf
and to every leaf within the radius; a pair is examined in the leaf of its
earlier member, and counted in the first block that admits it, hence once.
Leaves over ``TILE`` members are cut into tiles by hash and pairs of tiles, so
every group is bounded.  What is dealt to the leaves is the block's few coordinates
in single precision, whose rounding the filter allows for; a group marks the members that have a
candidate, a row for each, and only these get their vectors.
A group then returns link counts and a star per connected set, never its pairs.  Equal vectors of one label form a class first, so copies
are neither joined nor expanded.

Defined cases: vectors that are null, empty, zero, of null label, or that hold
null or non-finite components link with nothing and keep themselves; so do
those without id (null component).  Vectors of different lengths never link.
Every row counts, repeated ids too.  Extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import saved
from tessera.llm.components import components

BLOCK_DIMS, SAMPLE, LEAF, TILE, MOST_DEPTH = 8, 20_000, 2048, 8192, 14
#: Room for rounding in the candidate filter, and that of single precision; verification has none.
SLACK, SINGLE_SLACK = 1e-9, 1e-5


@functools.lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(64).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def blocks(dims: int) -> np.ndarray:
    """First dimension of each block."""
    n = max(1, round(dims / BLOCK_DIMS))
    return np.arange(n) * dims // n


def budgets(dims: int, cosine: float) -> np.ndarray:
    """Each block's share of the squared distance."""
    sizes = np.diff(np.append(blocks(dims), dims))
    return (2 - 2 * cosine) * sizes / dims + SLACK


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rotated unit vectors; term by term, so that a vector's result never depends on its batch."""
    unit = vectors / np.sqrt((vectors * vectors).sum(1))[:, None]
    out = np.zeros_like(unit)
    for k, row in enumerate(rotation(vectors.shape[1])):
        out += unit[:, k:k + 1] * row
    return out


# ------------------------------------------------------------------ median trees
def grow(points: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level, each node's dimension and threshold: the median of its widest dimension."""
    nodes, levels = [points], []
    for _ in range(depth):
        axis, cut, below = np.zeros(len(nodes), np.int64), np.zeros(len(nodes)), []
        for i, p in enumerate(nodes):
            if len(p):
                axis[i] = int(p.var(0).argmax())
                cut[i] = float(np.median(p[:, axis[i]]))
            right = p[:, axis[i]] > cut[i]
            below += [p[~right], p[right]]
        nodes = below
        levels.append((axis, cut))
    return levels


def leaves(tree: list[tuple[np.ndarray, np.ndarray]], points: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, whether it is the row's own leaf) for every leaf within ``radius`` of each point."""
    row, node, home = np.arange(len(points)), np.zeros(len(points), np.int64), np.ones(len(points), bool)
    for axis, cut in tree:
        off = points[row, axis[node]] - cut[node]
        near = np.flatnonzero(np.abs(off) <= radius)
        own = (off > 0).astype(np.int64)
        row, node, home = (np.concatenate([row, row[near]]), np.concatenate([2 * node + own, 2 * node[near] + 1 - own[near]]),
                           np.concatenate([home, np.zeros(len(near), bool)]))
    return row, node, home


# ------------------------------------------------------------------ tasks
def _vectors(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows; a digest of the components where the vector can link, else null."""
    for batch in batches:
        digest = []
        for name, vector, label in zip(batch.column("id"), batch.column("vector"), batch.column("label")):
            good = name.is_valid and label.is_valid and vector.is_valid and not vector.values.null_count
            x = vector.values.to_numpy(zero_copy_only=False) if good else None
            digest.append(xxhash.xxh128_digest(x.tobytes()) if good and x.any() and np.isfinite(x).all() else None)
        yield batch.append_column("digest", pa.array(digest, pa.binary()))


def _deal(trees: dict[int, list], cosine: float):
    """Each class once for every block and leaf that it may meet a partner in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = whole.column("dims").to_numpy()
            for dims in np.unique(sizes):
                batch = whole.filter(pa.array(sizes == dims))
                points, starts = rotated(_vectors(batch.column("vector"))), blocks(int(dims))
                for b, (start, budget) in enumerate(zip(starts, budgets(int(dims), cosine))):
                    end = starts[b + 1] if b + 1 < len(starts) else dims
                    tree = trees.get(int(dims), [[]] * len(starts))[b]
                    row, leaf, home = leaves(tree, points[:, start:end], float(np.sqrt(budget)) + SLACK)
                    coords = points[:, start:end].astype(np.float32)
                    for at in range(0, len(row), 1 << 16):
                        part = slice(at, at + (1 << 16))
                        rows = batch.select(["label", "num", "dims"]).take(pa.array(row[part]))
                        cuts = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * coords.shape[1])
                        yield pa.RecordBatch.from_arrays(
                            [*rows.columns, pa.ListArray.from_arrays(cuts, coords[row[part]].reshape(-1)), pa.array(np.full(len(rows), b, np.int32)),
                             pa.array(leaf[part].astype(np.int32)), pa.array(home[part])], [*rows.schema.names, "coords", "block", "leaf", "home"])
    return run


def _mark(cosine: float):
    """The members of one group that have a candidate in it: (tile, num, home)."""
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["num"].to_numpy(), kind="stable")
        home, tile = table["home"].to_numpy(zero_copy_only=False)[order], table["tile"].to_numpy()[order]
        same_tile = table["low_tile"][0].as_py() == table["high_tile"][0].as_py()
        own = _vectors(table["coords"].combine_chunks()).astype(np.float32)[order]
        allowed = budgets(table["dims"][0].as_py(), cosine)[table["block"][0].as_py()] + SINGLE_SLACK
        square = (own * own).sum(1)
        told = np.zeros(len(own), bool)
        for at in range(0, len(own), 256):
            rows = np.arange(at, min(at + 256, len(own)))
            near = square[rows, None] + square[None, :] - 2 * own[rows] @ own.T <= allowed
            near &= rows[:, None] < np.arange(len(own))[None, :]
            near &= home[rows, None]
            if not same_tile:
                near &= tile[rows, None] != tile[None, :]
            told[rows] |= near.any(1)
            told |= near.any(0)
        return table.take(pa.array(order[told])).drop_columns(["coords"])
    return run


def _link(cosine: float):
    """Links of one group: (class, links, root); ``root`` joins what the group connects."""
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["num"].to_numpy(), kind="stable")
        name, copies = table["class"].to_numpy()[order], table["copies"].to_numpy()[order]
        home = table["home"].to_numpy(zero_copy_only=False)[order]
        tile = table["tile"].to_numpy()[order]
        same_tile = table["low_tile"][0].as_py() == table["high_tile"][0].as_py()
        vectors = _vectors(table["vector"].combine_chunks())[order]
        block, dims = table["block"][0].as_py(), vectors.shape[1]
        points, starts, allowed = rotated(vectors), blocks(dims), budgets(dims, cosine)
        end = starts[block + 1] if block + 1 < len(starts) else dims
        own = points[:, starts[block]:end]
        square = (own * own).sum(1)
        norm = np.sqrt((vectors * vectors).sum(1))
        links, label = np.zeros(len(name), np.int64), np.arange(len(name))
        for at in range(0, len(name), 256):
            rows = np.arange(at, min(at + 256, len(name)))
            apart = square[rows, None] + square[None, :] - 2 * own[rows] @ own.T
            a, b = np.nonzero(apart <= allowed[block] + SLACK)
            a = rows[a]
            # In the leaf of the earlier member, and of two tiles unless the group is one tile.
            pick = (a < b) & home[a] & (same_tile | (tile[a] != tile[b]))
            a, b = a[pick], b[pick]
            cos = (vectors[a] * vectors[b]).sum(1) / (norm[a] * norm[b])
            a, b = a[cos >= cosine], b[cos >= cosine]
            gap = np.add.reduceat((points[a] - points[b]) ** 2, starts, axis=1)
            first = (gap <= allowed).argmax(1) == block
            a, b = a[first], b[first]
            if not len(a):
                continue
            links += np.bincount(a, copies[b], len(name)).astype(np.int64) + np.bincount(b, copies[a], len(name)).astype(np.int64)
            while True:  # the least member reachable, over the pairs so far
                least = np.minimum(label[a], label[b])
                moved = label.copy()
                np.minimum.at(moved, label[a], least)
                np.minimum.at(moved, label[b], least)
                moved = moved[moved]
                if (moved == label).all():
                    break
                label = moved
        while (label[label] != label).any():
            label = label[label]
        found = links > 0
        return pa.table([pa.array(name[found]), pa.array(links[found]), pa.array(name[label[found]])],
                        ["class", "links", "root"])
    return run


# ------------------------------------------------------------------ jobs
def _trees(classes: DataFrame, depth: int) -> dict[int, list]:
    """Median trees of each block, by vector length, from the ``SAMPLE`` classes of least hash."""
    rows = classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("vector").toArrow()["vector"].combine_chunks()
    sizes = np.diff(rows.offsets.to_numpy())
    out = {}
    for dims in np.unique(sizes):
        points, starts = rotated(_vectors(rows.filter(pa.array(sizes == dims)))), blocks(int(dims))
        out[int(dims)] = [grow(part, depth) for part in np.split(points, starts[1:], axis=1)]
    return out


def linked(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           cosine: float = 0.98) -> DataFrame:
    """(id, n_links, component_id, kept) for every row; only vectors of one label are compared."""
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    element = base.schema["vector"].dataType.elementType.simpleString()
    label = base.schema["label"].dataType.simpleString()
    members = saved(base.mapInArrow(
        _digests, f"id bigint, vector array<{element}>, label {label}, digest binary"), "subspace-vectors")
    classes = saved(members.where("digest is not null").groupBy("label", "digest").agg(
        F.min("id").alias("class"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumns({"dims": F.size("vector"), "num": F.monotonically_increasing_id()}), "subspace-classes")
    most = classes.groupBy("label", "dims").count().agg(F.max("count")).first()[0] or 0
    depth = min(MOST_DEPTH, max(0, int(np.ceil(np.log2(max(1, most) / LEAF)))))
    dealt = saved(classes.select("label", "num", "vector", "dims").mapInArrow(
        _deal(_trees(classes, depth), cosine),
        f"label {label}, num bigint, dims int, coords array<float>, block int, leaf int, home boolean"), "subspace-dealt")
    group = ["label", "dims", "block", "leaf"]
    sizes = dealt.groupBy(*group).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tiled = (dealt.join(sizes, group)
             .withColumn("tile", F.pmod(F.xxhash64("num"), F.col("tiles")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumns({"low_tile": F.least("tile", "other"), "high_tile": F.greatest("tile", "other")})
             .select(*group, "low_tile", "high_tile", "tile", "num", "home", "coords"))
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tiled.schema.fields if f.name != "coords")
    marked = saved(tiled.groupBy(*group, "low_tile", "high_tile").applyInArrow(_mark(cosine), names), "subspace-marked")
    found = saved(marked.join(classes.select("num", "class", "copies", "vector"), "num").groupBy(*group, "low_tile", "high_tile").applyInArrow(
        _link(cosine), "class bigint, links bigint, root bigint"), "subspace-links")
    links = found.groupBy(F.col("class").alias("l_class")).agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    per_class = (classes.select("label", "digest", "class", "copies")
                 .join(links, F.col("class") == F.col("l_class"), "left")
                 .join(parts, F.col("class") == F.col("node"), "left")
                 .select(F.col("label").alias("c_label"), F.col("digest").alias("c_digest"),
                         (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                         F.coalesce("component", "class").alias("component_id")))
    same = (F.col("label") == F.col("c_label")) & (F.col("digest") == F.col("c_digest"))
    component = F.coalesce("component_id", "id")
    return members.select("id", "label", "digest").join(per_class, same, "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
