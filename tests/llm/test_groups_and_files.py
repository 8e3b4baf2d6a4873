"""Near-duplicates, mixing, token files, classifiers and the pipeline against brute force."""

import itertools
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import PROSE, rows
from tessera.llm import (
    components,
    line_crf,
    minhash_inverted,
    mixing,
    subspace_join,
    token_blocks,
    toxicity_fm,
)
from tessera.llm.queries import MIX_CTES, ORACLE, QUERIES, vocabulary

SF = "/root/testdata/sf0.001"


def least(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(2)
    two = spark.createDataFrame([(5, 1), (5, 2)], "a bigint, b bigint")  # no chain, but not a star either
    assert {tuple(r) for r in components.components(two).collect()} == {(1, 1), (2, 1), (5, 1)}
    for n in (0, 1, 40, 200):
        edges = [tuple(map(int, e)) for e in rng.integers(0, 150, (n, 2))] + [(1000 + i, 1001 + i) for i in range(30)] * (n > 1)
        got = components.components(spark.createDataFrame(edges, "a bigint, b bigint"))
        nodes = {x for a, b in edges if a != b for x in (a, b)}
        assert {r.node: r.component for r in got.collect()} == least(nodes, edges)
        assert got.count() == len(nodes)


# ------------------------------------------------------------------ 5
def shingles(text, size):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute_groups(docs, size, percent):
    sets = {d: shingles(t, size) for d, t in docs if d is not None}
    edges = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    part = least(sets, edges)
    return {(d, len(sets[d]), part[d], d == part[d]) for d in sets}


def test_threshold_misses_almost_nothing():
    t = minhash_inverted.match_threshold(48, 0.8, 1e-6)
    assert 20 <= t <= 28


def test_op5(spark, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_groups(docs, 2, 80)
    assert {tuple(r) for r in QUERIES["op5_minhash_inverted"](spark, SF).collect()} == want
    monkeypatch.setattr(minhash_inverted, "TILE", 2)
    monkeypatch.setattr(minhash_inverted, "BROADCAST_IDS", 0)
    assert {tuple(r) for r in QUERIES["op5_minhash_inverted"](spark, SF).collect()} == want


def test_near_copies_in_a_chain(spark):
    """Neighbours are alike, the ends are not: all are one group, found without all pairs."""
    words = [f"w{i}" for i in range(300)]
    docs = [(100 + k, " ".join(words[6 * k:6 * k + 120])) for k in range(30)] + [(7, "apart " * 30)]
    got = {tuple(r) for r in minhash_inverted.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), shingle=2).collect()}
    assert got == brute_groups(docs, 2, 80)
    assert len({r[2] for r in got}) == 2


def test_near_duplicates_of_awkward_rows(awkward, nothing):
    got = minhash_inverted.near_duplicates(awkward, shingle=2).collect()
    assert len(got) == len(rows())
    named = {tuple(r) for r in got if r.doc_id is not None}
    assert named == brute_groups([r[:2] for r in rows()], 2, 80)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert minhash_inverted.near_duplicates(nothing).count() == 0
    kept = minhash_inverted.deduplicate(awkward, shingle=2)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(r[0] for r in named if r[3]) and ids.count(None) == 2


def test_deduplicate_loses_no_text(spark):
    """Rows that share an id but not the text: each text that resembles nothing stays."""
    more = PROSE + " again"
    docs = [(1, PROSE), (2, more), (2, "a text of its own that is like nothing else here"), (3, "lone words of three"), (3, "lone words of three"),
            (3, "something else entirely under the same number")]
    kept = minhash_inverted.deduplicate(spark.createDataFrame(docs, "doc_id bigint, text string"), shingle=2)
    assert sorted(map(tuple, kept.collect())) == sorted({docs[0], docs[2], docs[3], docs[5]})


def test_links_between_equal_brute_force():
    rng = np.random.default_rng(6)
    for one_tile in (True, False):
        for _ in range(20):
            base = [rng.integers(0, 60, 40) for _ in range(3)]
            sets = [np.unique(np.concatenate([base[k % 3][:rng.integers(25, 40)], rng.integers(0, 300, rng.integers(0, 8))])).astype(np.uint64) for k in range(14)]
            members = [(100 + k, int(rng.integers(0, 8)), k % 2, s) for k, s in enumerate(sets)]
            edges = [(a[1], b[1]) for a, b in itertools.combinations(members, 2) if (one_tile or a[2] != b[2])
                     and 100 * len(np.intersect1d(a[3], b[3])) >= 60 * len(np.union1d(a[3], b[3]))]
            part = {m[0]: m[1] for m in members}
            got = [(part[a], part[b]) for a, b in minhash_inverted.links_between(members, one_tile, 60)]
            parts = set(part.values())
            assert least(parts, got) == least(parts, edges) and len(got) < len(parts)


def test_shared_keys_over_batches():
    keys = [1, 2, 2, 3, 4, 4, 4, 4, 5, 6, 6]
    for size in (1, 2, 3, 11):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[i:i + size]), pa.array(range(i, min(i + size, 11)))], ["key", "class"])
                   for i in range(0, 11, size)]
        got = [r["class"] for b in minhash_inverted._shared(iter(batches)) for r in b.to_pylist()]
        assert got == [1, 2, 4, 5, 6, 7, 9, 10]


def test_collisions_skip_nothing():
    rng = np.random.default_rng(8)
    marks = rng.integers(0, 2, (60, 48)).astype(np.uint8)
    low, high = np.array(list(itertools.combinations(range(60), 2))).T
    same = (marks[low] == marks[high]).sum(1)
    at, n = minhash_inverted.collisions(marks, low, high, 27)
    assert np.array_equal(at, np.flatnonzero(same >= 27)) and np.array_equal(n, same[same >= 27])


def test_link_recall(spark):
    """Exact links of all pairs of a thousand documents: every one is found."""
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in QUERIES["op5_minhash_inverted"](spark, sf).collect()} == brute_groups(docs, 2, 80)


# ------------------------------------------------------------------ 4
def brute_vectors(data):
    good = [i for i, (n, v, lab) in enumerate(data) if n is not None and lab is not None and v and None not in v
            and np.isfinite(v).all() and np.any(v)]
    links, edges = [0] * len(data), []
    for a, b in itertools.combinations(good, 2):
        x, y = np.array(data[a][1], np.float32).astype(float), np.array(data[b][1], np.float32).astype(float)
        if data[a][2] == data[b][2] and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
            links[a] += 1
            links[b] += 1
            edges.append((data[a][0], data[b][0]))
    part = least({d[0] for d in data if d[0] is not None}, edges)
    return sorted(((d[0], links[i], part.get(d[0]), d[0] is None or part[d[0]] == d[0]) for i, d in enumerate(data)), key=repr)


@pytest.mark.parametrize("leaf,tile", [(2048, 2048), (8, 2048), (8, 5)])
def test_vectors(spark, monkeypatch, leaf, tile):
    monkeypatch.setattr(subspace_join, "LEAF", leaf)
    monkeypatch.setattr(subspace_join, "TILE", tile)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24))
    data = [(i, (centres[i % 12] + rng.normal(size=24) * 0.13).astype(np.float32).tolist(), i % 3) for i in range(150)]
    data += [(200 + i, data[0][1], 0) for i in range(5)] + [(200, data[0][1], 0)]  # copies and a repeated row
    data += [(300, None, 0), (301, [], 0), (302, [0.0] * 24, 0), (303, [float("nan")] * 24, 0), (304, [None] + [1.0] * 23, 0),
             (305, data[0][1], None), (None, data[0][1], 0), (306, data[0][1][:5], 0), (307, [2 * x for x in data[0][1]], 0), (308, [3.0], 1)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 as id", "2 as block")
    got = sorted((tuple(r) for r in subspace_join.linked(df).collect()), key=repr)
    assert got == brute_vectors(data)
    assert sum(r[1] for r in got) > 100
    assert subspace_join.linked(df.limit(0)).count() == 0


def test_op4(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted((tuple(r) for r in QUERIES["op4_subspace_join"](spark, SF).collect()), key=repr) == brute_vectors(data)


# ------------------------------------------------------------------ 9
def test_mix_matches_sql(spark, awkward, nothing):
    con = duckdb.connect()
    docs = awkward.select("doc_id", "text", "source").toPandas()  # noqa: F841
    docs["doc_id"] = docs["doc_id"].astype("Int64")
    con.register("given", docs)
    want = con.execute(f"WITH docs AS (SELECT doc_id::BIGINT AS doc_id, text, source FROM given),{MIX_CTES} "
                       "SELECT doc_id, size, source_size, target, (n * size)::BIGINT FROM mixed").fetchall()
    got = mixing.mix(awkward).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert mixing.mix(nothing).count() == 0
    taken = mixing.take(awkward)
    assert taken.columns == awkward.columns
    assert taken.selectExpr("count(*)").first()[0] == sum(r["copies"] for r in mixing.mix(awkward).collect())
    assert mixing.take(nothing).count() == 0


def test_mix_comes_near_its_targets(spark):
    got = QUERIES["op9_mix_sources"](spark, "/root/testdata/sf0.01")
    for r in got.groupBy("source_size", "target").sum("taken").collect():
        assert abs(r["sum(taken)"] - r["target"]) <= 3000  # less than one long document
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(ORACLE["op9_mix_sources"]).fetchall())


# ------------------------------------------------------------------ 10
def test_blocks_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.integers(0, 49408, n).astype(np.uint32)
        ids[rng.random(n) < 0.8] %= 300
        ids[: n // 700] = 2**32 - 1
        one = token_blocks.Segment(np.frombuffer(token_blocks.segment([None, 5], [ids, ids[:0]]) + b"\n", np.uint8))
        assert one.doc_ids == [None, 5] and one.sizes.tolist() == [n, 0]
        assert np.array_equal(one.ids(), ids) and np.array_equal(one.ids(n // 3, n // 2), ids[n // 3:n // 2])


def digest_by_hand(docs):
    from tokenizers import Tokenizer
    library, start, out = Tokenizer.from_file(vocabulary()), 0, []
    for d, t in docs:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_op10(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    assert sorted(map(tuple, QUERIES["op10_token_blocks"](spark, SF).collect())) == digest_by_hand(docs)


def test_token_files_of_awkward_rows(spark, awkward, nothing, tmp_path, monkeypatch):
    monkeypatch.setattr(token_blocks, "SEGMENT_IDS", 1000)
    got = sorted((tuple(r) for r in token_blocks.write_and_read(awkward, vocabulary()).collect()), key=lambda r: r[1])
    hand = {(r[0], r[2], r[3]) for r in digest_by_hand([r[:2] for r in rows()])}
    assert {(r[0], r[2], r[3]) for r in got} == hand and len(got) == len(rows())
    assert [r[1] for r in got] == [0, *itertools.accumulate(r[2] for r in got)][:-1]
    names = [r[0] for r in got]
    assert names == sorted(names, key=lambda n: (n is not None, n or 0))
    assert token_blocks.write_and_read(nothing, vocabulary()).count() == 0
    token_blocks.write_ids(awkward, f"{tmp_path}/ids", vocabulary(), end_id=None)
    back = {(r.doc_id, len(r.ids)) for r in token_blocks.read_ids(spark, f"{tmp_path}/ids").collect()}
    assert back == {(d, n - 1) for d, n, _ in hand}


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    own = token_blocks.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [(r[1] or "")[:2000] for r in rows()]
    for t, ids in zip(texts, own.ids([t.encode() for t in texts])):
        assert ids.tolist() == own.library.encode(t, add_special_tokens=False).ids


# ------------------------------------------------------------------ 1 and 7
@pytest.mark.parametrize("name,label,least_right", [("op1_toxicity_fm", "toxic", 0.93), ("op7_quality_crf", "quality", 0.97)])
def test_held_out_accuracy(spark, name, label, least_right):
    sf = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, sf)
    assert got.count() == 1000 and got.where("score < 0 or score > 1 or score is null").count() == 0
    known = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    right = known.selectExpr(f"avg(cast(predicted = {label} as double))").first()[0]
    assert right >= least_right


def test_classifiers_of_awkward_rows(awkward, nothing, few_labels):
    for module, label in ((toxicity_fm, "toxic"), (line_crf, "quality")):
        for labels in (few_labels, few_labels.limit(0), few_labels.where(f"{label} = 1")):
            model = module.train(awkward, labels, label)
            scores = [r.score for r in module.score(awkward, model).collect()]
            assert len(scores) == len(rows()) and all(0 <= s <= 1 for s in scores)
        assert module.score(nothing, model).count() == 0
        assert module.train(nothing, few_labels, label) is not None
    kept = line_crf.keep(awkward, line_crf.train(awkward, few_labels.limit(0)))
    assert kept.columns == awkward.columns and kept.count() == len(rows())


def brute_chain(unary, pair):
    """Marginals of one chain by all its labellings."""
    n, total, on = len(unary), 0.0, np.zeros(len(unary))
    for states in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(unary[t][s] for t, s in enumerate(states)) + sum(pair[a][b] for a, b in itertools.pairwise(states)))
        total += w
        on += w * np.array(states)
    return on / total


def test_chain_marginals():
    rng = np.random.default_rng(6)
    sizes = np.array([3, 1, 7, 4])
    unary, pair = rng.normal(size=(15, 2)), rng.normal(size=(2, 2))
    got, pairs = line_crf.Chain(sizes).marginals(unary, pair)
    want = np.concatenate([brute_chain(u, pair) for u in np.split(unary, np.cumsum(sizes)[:-1])])
    assert np.allclose(got, want) and np.isclose(pairs.sum(), (sizes - 1).sum())


def test_pair_weights_of_the_machine():
    p = {"bias": np.array([0.3]), "w": np.array([0.1, -0.2, 0.5]), "v": np.random.default_rng(1).normal(size=(3, 4))}
    got, _ = toxicity_fm.logits(p, np.array([0, 2, 0, 1, 2]), np.array([0, 2, 2, 5]))
    pair = lambda *t: sum(p["v"][a] @ p["v"][b] for a, b in itertools.combinations(t, 2))
    assert np.allclose(got, [0.3 + 0.6 + pair(0, 2), 0.3, 0.3 + 0.4 + pair(0, 1, 2)])


def test_words_that_are_toxic_only_together():
    rng = np.random.default_rng(0)
    filler, texts, labels = [f"filler{i}" for i in range(300)], [], []
    for i in range(2400):
        mild, group = i & 1, i >> 1 & 1  # neither says anything alone
        texts.append(" ".join([*rng.choice(filler, 40), *["mildword"] * mild, *["groupname"] * group]))
        labels.append(int(mild == group))
    batch = pa.RecordBatch.from_arrays([pa.array(texts[:1800]), pa.array(labels[:1800], pa.int32()), pa.array([1.0] * 1800)],
                                       ["text", "label", "weight"])
    model = toxicity_fm.fit(pa.Table.from_batches(list(toxicity_fm._sample_terms(iter([batch])))))
    scores = toxicity_fm.Scorer(model).scores([t.encode() for t in texts[1800:]])
    assert ((scores >= 0.5) == np.array(labels[1800:])).mean() >= 0.95


def test_no_term_of_several_texts_is_left_out():
    texts = ["rare common"] * 3 + ["common"] * 197
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([1] * 100 + [0] * 100, pa.int32()), pa.array([1.0] * 200)],
                                       ["text", "label", "weight"])
    model = toxicity_fm.fit(pa.Table.from_batches(list(toxicity_fm._sample_terms(iter([batch])))))
    assert {t for w in (b"rare", b"common") for t in toxicity_fm.word_terms(w)} <= set(model["buckets"].tolist())


# ------------------------------------------------------------------ pipeline
def test_pipeline(spark):
    import corpus_pipeline
    from pyspark.sql import functions as F

    from tests.llm.test_text_operators import brute_windows
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, given = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        kept[name] = [tuple(r) for r in docs.collect()]
        if name != "token_ids":
            assert docs.columns == columns
            assert docs.exceptAll(before.select(columns)).count() == 0 or name == "mix"
    text = {r.doc_id: r.text for r in given.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r[0] for r in kept["quality"]]
    assert all(d in good for d, q in labels.items() if q == 1 and d in text)
    part = {d: c for d, _, c, _ in brute_groups([(d, text[d]) for d in good], 5, 80)}
    assert sorted(r[0] for r in kept["near_duplicates"]) == sorted(set(part.values()))
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {d: h for d, _, h, _ in brute_windows([(d, text[d]) for d in sorted(set(part.values()))], items)}
    assert sorted(r[0] for r in kept["decontamination"]) == sorted(d for d, h in hit.items() if not h)
    mixed = {r.doc_id: r.copies for r in mixing.mix(given.where(F.col("doc_id").isin([r[0] for r in kept["decontamination"]]))).collect()}
    assert sorted(r[0] for r in kept["mix"]) == sorted(d for d, n in mixed.items() for _ in range(n))
    assert sorted(kept["token_ids"], key=lambda r: r[1]) == digest_by_hand([(d, text[d]) for d in sorted(r[0] for r in kept["mix"])])
