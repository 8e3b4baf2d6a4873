"""Merkle manifest against a plain level-by-level version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def sides(levels, at):
    for level in levels[:-1]:
        first = at // 8 * 8
        yield "".join(level[first:at]), "".join(level[at + 1:first + 8])
        at //= 8


def brute(rows):
    """{(doc_id, leaf, subroot, root, proof, folded, verified)} of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        original = h("".join(map(field, r)))
        changed = original
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            changed = h("".join(map(field, (*r[:4], lower(r[4])))))
        groups.setdefault(r[2], []).append((r[0], original, changed))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(levels_of([x[1] for x in groups[g]]))
    top = levels_of([t[-1][0] for t in trees]) if trees else []
    out = []
    for k, g in enumerate(names):
        for at, (name, original, changed) in enumerate(groups[g]):
            pairs = [*sides(trees[k], at), *sides(top, k)]
            d = changed
            for left, right in pairs:
                d = h(left + d + right)
            out.append((name, original, trees[k][-1][0], top[-1][0], h("".join(a + b for a, b in pairs)), d, d == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 513, 4096])
def test_sweeps(n):
    leaves = [h(str(i)) for i in range(n)]
    levels = merkle.sweep_up(leaves, True)
    assert levels == levels_of(leaves)
    got = {at: merkle.flat(proof) for at, proof in merkle.sweep_down(levels, ())}
    assert got == {at: list(sides(levels, at)) for at in range(n)}
    full = merkle.sweep_up(leaves, False)
    assert len(full) == merkle.LEVELS + 1 and len(full[-1]) == 1
    assert all(merkle.fold(leaves[at], merkle.flat(p)) == full[-1][0] for at, p in merkle.sweep_down(full, ()))


def test_op12(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*merkle.FIELDS).collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, SF).collect()), key=repr)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_trees_of_several_passes(spark):
    """More leaves than one pass takes to one, and many groups."""
    rows = [(i, "s", "hot" if i % 3 else f"l{i % 40:02d}", i, f"Text {i}") for i in range(7000)] + [(7001, "s", None, 1, "T")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    manifest = merkle.Manifest(df, changed=merkle.tampered(df))
    assert len(manifest.passes) == 2
    got = manifest.checked().select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                    (F.col("folded_root") == F.col("root")).alias("ok"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
    for r in manifest.proofs().where("doc_id % 500 = 1").collect():
        assert merkle.fold(r.leaf, list(zip(r.lefts, r.rights))) == manifest.root


def test_awkward_rows(spark, awkward, nothing):
    docs = awkward.withColumns({"lang": F.col("source"), "n_chars": F.length("text").cast("long")})
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    found = merkle.Manifest(docs, changed=merkle.tampered(docs)).checked()
    got = found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("ok"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
    empty = merkle.Manifest(docs.limit(0))
    assert empty.root is None and empty.checked().count() == 0 and empty.proofs().count() == 0


def test_rows_of_one_id_and_one_group(spark):
    rows = [(5, "s", "x", 1, "same")] * 20 + [(5, "s", "x", 1, f"other {i % 3}") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(4)
    found = merkle.Manifest(df, changed=merkle.tampered(df)).checked()
    got = found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("ok"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
    lone = spark.createDataFrame(rows[:1], df.schema)
    one = merkle.Manifest(lone).checked().collect()
    assert [(r.leaf, r.subroot, r.root, r.proof_sha256) for r in one] == [(one[0].leaf, one[0].leaf, one[0].leaf, h(""))]
