r"""Merkle manifest of a dataset by time-forward processing.

A row is a leaf; the leaves of one group (language) ascend by id and every
``ARITY`` consecutive nodes become their parent until one node, the subroot,
remains.  The subroots in group order become the root in the same way.

The forward sweep visits nodes in the order of their labels, (last leaf below
the node, level), in which children come before parents.  A node sends its
digest to its parent's label through a priority queue; what is due at a label
comes out together.  The queue is external: its far part is Spark's shuffle of
messages sorted by label, its near part a heap that holds the few messages of
the open ancestors.  One pass takes ``SPAN`` = 8^4 consecutive nodes of a tree
to one, so 10 billion leaves take three passes.  A pass writes one row per
stretch with the digests met on the way.  The reversed sweep visits the same
labels backwards: a node hands every child the proof suffix, that is the
child's siblings before what the node itself was handed, stretch by stretch
from the root's to the leaves'.  Texts are hashed where they are read and never
shuffled.

Digests are lower-case hex SHA-256; a parent's input is its children's hex text
put end to end.  A field is ``-`` if null, else its UTF-8 byte count, ``:``
and its value.

Defined cases: null fields hash as ``-``; a null id comes first and is never
tampered with; a null group is a group of its own and comes first; rows that
share an id are ordered by their leaves, and equal leaves give equal
proofs only up to their place; a group of one row has its leaf as subroot; one group has its
subroot as root; an empty table has no root and no proofs.  Columns that are not
named are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import saved
from tessera.operators.ordinals import with_ordinal

ARITY, LEVELS = 8, 4
SPAN = ARITY ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest_of(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


# ------------------------------------------------------------------ leaves
def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


# ------------------------------------------------------------------ one stretch
def level_sizes(n: int, closed: bool) -> list[int]:
    """Nodes per level of a stretch of ``n``: exactly ``LEVELS`` up, or, for a whole tree (``closed``), until one is left."""
    sizes = [n]
    while (sizes[-1] > 1) if closed else (len(sizes) <= LEVELS):
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


def _label(level: int, index: int, n: int) -> tuple[int, int]:
    """(last leaf below the node, level)."""
    return min((index + 1) * ARITY ** level, n) - 1, level


def sweep_up(leaves: Sequence[str], closed: bool) -> list[list[str]]:
    """Digests by level, leaves first, in one pass over the labels."""
    n = len(leaves)
    sizes = level_sizes(n, closed)
    levels: list[list[str]] = [list(leaves)] + [[] for _ in sizes[1:]]
    queue: list[tuple[tuple[int, int], int, str]] = []  # (label of the parent, place among its children, digest)

    def send(level: int, index: int, digest: str) -> None:
        if level + 1 < len(sizes):
            heapq.heappush(queue, (_label(level + 1, index // ARITY, n), index % ARITY, digest))

    for at, digest in enumerate(leaves):
        send(0, at, digest)
        while queue and queue[0][0][0] <= at:
            label, children = queue[0][0], []
            while queue and queue[0][0] == label:
                children.append(heapq.heappop(queue)[2])
            level = label[1]
            levels[level].append(digest_of(children))
            send(level, len(levels[level]) - 1, levels[level][-1])
    return levels


def sweep_down(levels: Sequence[Sequence[str]], suffix: tuple) -> Iterator[tuple[int, tuple]]:
    """(leaf, its proof) from the last leaf to the first; a proof is nested pairs ((left, right), rest of the proof)."""
    n, top = len(levels[0]), len(levels) - 1
    queue: list[tuple[tuple[int, int], int, tuple]] = []

    def send(level: int, index: int, rest: tuple) -> None:
        last, height = _label(level, index, n)
        heapq.heappush(queue, ((-last, -height), index, rest))

    send(top, 0, suffix)
    while queue:
        (_, height), index, rest = heapq.heappop(queue)
        level = -height
        if level == 0:
            yield index, rest
            continue
        first = index * ARITY
        run = levels[level - 1][first:first + ARITY]
        for k in range(len(run)):
            send(level - 1, first + k, (("".join(run[:k]), "".join(run[k + 1:])), rest))


def nested(lefts: Sequence[str], rights: Sequence[str]) -> tuple:
    rest: tuple = ()
    for pair in zip(reversed(lefts), reversed(rights)):
        rest = (pair, rest)
    return rest


def flat(proof: tuple) -> list[tuple[str, str]]:
    """(left siblings, right siblings) from the leaf's run up to the root's."""
    out = []
    while proof:
        pair, proof = proof
        out.append(pair)
    return out


def fold(digest: str, pairs: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in pairs:
        digest = digest_of((left, digest, right))
    return digest


# ------------------------------------------------------------------ passes
_STRETCH = ("tree bigint, stretch bigint, total bigint, digest string, nodes binary, "
            "ids array<bigint>, changed array<string>")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], dict[str, list]]]:
    """Consecutive rows of one stretch (at most ``SPAN``), whole."""
    key, rows = None, {}
    for batch in batches:
        columns = batch.to_pydict()
        for at, now in enumerate(zip(columns["tree"], columns["stretch"])):
            if now != key:
                if key is not None:
                    yield key, rows
                key, rows = now, {c: [] for c in columns}
            for c, values in columns.items():
                rows[c].append(values[at])
    if key is not None:
        yield key, rows


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("tree", pa.int64()), ("stretch", pa.int64()), ("total", pa.int64()), ("digest", pa.string()),
                        ("nodes", pa.binary()), ("ids", pa.list_(pa.int64())), ("changed", pa.list_(pa.string()))])
    for (tree, stretch), rows in _runs(batches):
        total = rows["total"][0]
        levels = sweep_up(rows["digest"], total <= SPAN)
        nodes = bytes.fromhex("".join("".join(level) for level in levels))
        yield pa.RecordBatch.from_pylist([{
            "tree": tree, "stretch": stretch, "total": total, "digest": levels[-1][0], "nodes": nodes,
            "ids": rows["id"], "changed": rows["changed"]}], schema)


def _levels(row: dict) -> list[list[str]]:
    text, sizes, levels, at = row["nodes"].hex(), level_sizes(len(row["ids"]), row["total"] <= SPAN), [], 0
    for n in sizes:
        levels.append([text[64 * (at + k):64 * (at + k + 1)] for k in range(n)])
        at += n
    return levels


def _down(finish):
    """Every stretch's proof suffixes, handed to its nodes; ``finish`` makes a row of each node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                levels = _levels(row)
                out = [finish(row, at, levels[0][at], flat(proof))
                       for at, proof in sweep_down(levels, nested(row["lefts"], row["rights"]))]
                yield pa.RecordBatch.from_pylist(out)
    return run


_HANDED = "tree bigint, stretch bigint, lefts array<string>, rights array<string>, subroot string"


def _to_stretch(row: dict, at: int, digest: str, proof: list[tuple[str, str]]) -> dict:
    return {"tree": row["tree"], "stretch": row["stretch"] * SPAN + at, "lefts": [a for a, _ in proof],
            "rights": [b for _, b in proof], "subroot": row["subroot"]}


_PROOF = ("doc_id bigint, leaf string, lefts array<string>, rights array<string>, subroot string")


def _to_proof(row: dict, at: int, digest: str, proof: list[tuple[str, str]]) -> dict:
    return {"doc_id": row["ids"][at], "leaf": digest, "lefts": [a for a, _ in proof],
            "rights": [b for _, b in proof], "subroot": row["subroot"]}


_CHECKED = "doc_id bigint, leaf string, subroot string, proof_sha256 string, folded_root string"


def _to_check(row: dict, at: int, digest: str, proof: list[tuple[str, str]]) -> dict:
    return {"doc_id": row["ids"][at], "leaf": digest, "subroot": row["subroot"],
            "proof_sha256": digest_of([side for pair in proof for side in pair]),
            "folded_root": fold(row["changed"][at] or digest, proof)}


def _climb(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Passes over ``nodes`` (tree, pos, total, digest, id, changed) until every tree has one node: (passes, tops)."""
    passes: list[DataFrame] = []
    while True:
        key = ["tree", "stretch"]
        sent = (nodes.withColumn("stretch", F.floor(F.col("pos") / SPAN)).repartition(*key)
                .sortWithinPartitions(*key, "pos").select("tree", "stretch", "total", "digest", "id", "changed"))
        passes.append(saved(sent.mapInArrow(_up, _STRETCH), f"merkle-{name}-{len(passes)}"))
        nodes = passes[-1].where(F.col("total") > SPAN).select(
            "tree", F.col("stretch").alias("pos"), F.ceil(F.col("total") / SPAN).alias("total"), "digest",
            F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("changed"))
        if nodes.isEmpty():
            tops = [p.where(F.col("total") <= SPAN).select("tree", "digest") for p in passes]
            top = tops[0]
            for more in tops[1:]:
                top = top.unionByName(more)
            return passes, top


def _descend(passes: list[DataFrame], handed: DataFrame, finish, schema: str) -> DataFrame:
    """What ``finish`` makes of every leaf; ``handed`` (tree, lefts, rights, subroot) reaches the trees' last stretches."""
    below: DataFrame | None = None
    for k in reversed(range(len(passes))):
        whole = passes[k].where(F.col("total") <= SPAN).join(handed, "tree")
        rows = whole
        if below is not None:
            rows = whole.unionByName(passes[k].where(F.col("total") > SPAN).join(below, ["tree", "stretch"]))
        if k == 0:
            return rows.mapInArrow(_down(finish), schema)
        below = saved(rows.mapInArrow(_down(_to_stretch), _HANDED), "merkle-handed")
    raise ValueError("no pass")


class Manifest:
    """The written passes of a dataset's trees; ``root`` is None for an empty dataset."""

    def __init__(self, docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang",
                 changed: Column | None = None):
        """``changed``: per row the leaf of a changed version, or null; it is checked against the original's siblings."""
        rows = saved(docs.select(
            F.col(id_col).cast("long").alias("id"), F.col(group_col).cast("string").alias("group"),
            leaf([F.col(c) for c in fields]).alias("digest"),
            (F.lit(None).cast("string") if changed is None else changed).alias("changed")), "merkle-leaves")
        ordered = with_ordinal(rows, [F.col("group").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("digest")], "place")
        groups = saved(with_ordinal(
            ordered.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("total")),
            [F.col("group").asc_nulls_first()], "tree"), "merkle-groups").withColumnRenamed("group", "of")
        nodes = ordered.join(groups, ordered["group"].eqNullSafe(F.col("of"))).select(
            "tree", (F.col("place") - F.col("first")).alias("pos"), "total", "digest", "id", "changed")
        self.groups = groups
        self.passes, tops = _climb(nodes, "leaves")
        n_groups = groups.count()
        self.tops = saved(tops, "merkle-tops")
        self.upper, top = _climb(self.tops.select(
            F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.lit(n_groups).cast("bigint").alias("total"),
            "digest", F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("changed")), "groups")
        root = top.first()
        self.root: str | None = None if root is None else root["digest"]

    def _each(self, finish, schema: str) -> DataFrame:
        spark = self.tops.sparkSession
        none = spark.range(1).select(F.col("id").alias("tree"), *[F.array().cast("array<string>").alias(c) for c in ("lefts", "rights")],
                                     F.lit(None).cast("string").alias("subroot"))
        upper = _descend(self.upper, none, _to_stretch, _HANDED).select(F.col("stretch").alias("at"), "lefts", "rights")
        handed = saved(self.tops.join(upper, F.col("tree") == F.col("at")).select(
            "tree", "lefts", "rights", F.col("digest").alias("subroot")), "merkle-upper")
        return _descend(self.passes, handed, finish, schema).withColumn("root", F.lit(self.root).cast("string"))

    def proofs(self) -> DataFrame:
        """(doc_id, leaf, lefts, rights, subroot, root): each leaf's siblings, level by level up to the root."""
        return self._each(_to_proof, _PROOF)

    def checked(self) -> DataFrame:
        """(doc_id, leaf, subroot, proof_sha256, folded_root, root): the proof's digest, and the root that the
        changed leaf (else the leaf) and its siblings lead to."""
        return self._each(_to_check, _CHECKED)


def tampered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fields: Sequence[str] = FIELDS) -> Column:
    """Leaf of the row with A-Z of its text lower-cased where 3 divides the id's crc32, else null."""
    number = docs[id_col].cast("string").cast("binary")
    values = [F.translate(docs[c], _UPPER, _LOWER) if c == text_col else docs[c] for c in fields]
    return F.when(F.crc32(number) % 3 == 0, leaf(values))
