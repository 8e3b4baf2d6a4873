"""Scores of the two classifiers' queries against sums over all pairs and all labellings."""

import io
import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import labelled, line_crf, toxicity_fm
from tessera.llm.common import plain_words
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_op1_sums_over_all_pairs(spark):
    docs, labels = tables(spark)
    model = np.load(io.BytesIO(toxicity_fm.pack_model(toxicity_fm.train(docs, labels))))
    number = {int(b): i for i, b in enumerate(model["buckets"])}
    got = {r.doc_id: r for r in QUERIES["op1_toxicity_fm"](spark, SF).collect()}
    assert len(got) == docs.count()
    for r in docs.orderBy(F.length("text")).limit(40).collect():
        terms = sorted({number[t] for w in set(plain_words((r.text or "").encode())) for t in toxicity_fm.word_terms(w) if t in number})
        logit = float(model["bias"][0]) + sum(float(model["w"][t]) for t in terms)
        v = model["v"].astype(float)
        logit += sum(float(v[a] @ v[b]) for a, b in itertools.combinations(terms, 2))
        score = 1 / (1 + math.exp(-logit))
        assert abs(got[r.doc_id].score - score) < 1e-4 and got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.5)


def test_op7_sums_over_all_labellings(spark):
    docs, labels = tables(spark)
    model = line_crf.train(docs, labels)
    got = {r.doc_id: r for r in QUERIES["op7_quality_crf"](spark, SF).collect()}
    assert len(got) == docs.count()
    few = [r for r in docs.collect() if 1 <= (r.text or "").count("\n") + 1 <= 9][:40]
    assert len(few) > 10
    for r in few:
        text = (r.text or "").encode()
        measures, length, per_text = line_crf.line_measures([text])
        features = line_crf.neighbours((measures - model["mean"]) / model["scale"], per_text)
        unary = (features @ model["w"].astype(np.float32)).astype(float)
        weight, bad = 0.0, np.zeros(len(unary))
        best = max(unary.sum(), 0)
        for states in itertools.product((0, 1), repeat=len(unary)):
            energy = sum(u for u, s in zip(unary, states) if s) + sum(model["pair"][a, b] for a, b in itertools.pairwise(states))
            e = math.exp(energy - best)
            weight += e
            bad += e * np.array(states)
        x = np.clip((bad / weight * length).sum() / length.sum(), 1e-4, 1 - 1e-4)
        score = 1 / (1 + math.exp(-(model["curve"][0] - model["curve"][1] * math.log(x / (1 - x)))))
        assert abs(got[r.doc_id].score - score) < 1e-6 and got[r.doc_id].predicted == int(got[r.doc_id].score >= line_crf.GOOD)


def test_sample_is_bounded_in_bytes(spark, monkeypatch):
    rows = [(i, "x" * (100 * (i % 5 + 1))) for i in range(200)] + [(500, "y" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, toxic int")
    everything = labelled.labelled_sample(docs, labels, "toxic", 1000, 5)[0].count()
    for most in (0, 2000, 10_000):
        monkeypatch.setattr(labelled, "MOST_BYTES", most)
        sample, _ = labelled.labelled_sample(docs, labels, "toxic", 1000, 5)
        for r in sample.groupBy("label").agg(F.sum(F.length("text")).alias("size"), F.count("*").alias("n")).collect():
            assert r["size"] <= most or r["n"] == 1
        assert 0 < sample.count() < everything
