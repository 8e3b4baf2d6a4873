"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import collocations as C


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, least, percent=80, keep=2000, scale=2_000_000):
    out = []
    for lang in {r[1] or "und" for r in rows}:
        f = Counter()
        for text, other in rows:
            if (other or "und") == lang:
                for ws in pieces(text):
                    for i in range(len(ws)):
                        for m in range(1, min(4, len(ws) - i) + 1):
                            f[tuple(ws[i:i + m])] += 1
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        gone = set()
        for p, c in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    if 100 * c >= percent * f[p[i:i + m]]:
                        gone.add(p[i:i + m])
        ranked = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((scale * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:keep], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "é", "漢字", "a.b", "x"] + [f"w{i}" for i in range(12)]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 12)):
            text += rng.choice(["new york city ", "of  the\t", "x x x x x ", rng.choice(words) + " "]) + rng.choice([""] * 5 + [". ", "\n", "\x0b", "; "])
        rows.append((text, ["en", "en", "de", None, "und"][i % 5]))
    return rows + [(None, "en"), ("", "de"), (" \t\n", None)]


def found(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").repartition(3)


@pytest.mark.parametrize("least", [2, 30])
def test_brute_force(spark, least):
    rows = corpus()
    got = C.collocations(frame(spark, rows), least=least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found(got) == brute(rows, least) and got.count() > 5


def test_buckets_dealt_again(spark):
    """Tiny chunks and buckets: leading pairs that are too large are parted by their further words."""
    rows = corpus()
    assert found(C.collocations(frame(spark, rows), least=5, chunk_bytes=500, bucket_rows=4)) == brute(rows, 5)


def test_top_and_ties(spark):
    rows = [(" ".join(f"{a} {b}." for a in "pqrs" for b in "tuvw"), "en")] * 30
    want = brute(rows, 30, keep=5)
    got = C.collocations(frame(spark, rows), keep=5)
    assert found(got) == want and [w[2] for w in want] == ["p t", "p u", "p v", "p w", "q t"]


def test_quicksort():
    rng = np.random.default_rng(4)
    for least in (1, 3):
        rows = rng.integers(0, 4, (500, 4)).astype(np.int32)
        for k in range(3):  # 0 is no word, and nothing follows it
            rows[rows[:, k] == 0, k + 1:] = 0
        weights = rng.integers(1, 4, 500)
        want = Counter()
        for row, w in zip(rows.tolist(), weights.tolist()):
            for n in range(1, 5):
                if row[n - 1]:
                    want[tuple(row[:n])] += w
        got = {tuple(rows[h, :n].tolist()): w for n, heads, sums in C.three_way(rows, weights, np.full(4, least), 0)
               for h, w in zip(heads, sums.tolist())}
        assert got == {p: w for p, w in want.items() if w >= least}
    assert list(C.three_way(rows[:0], weights[:0], np.full(4, 1), 0)) == []


@pytest.mark.parametrize("n_top", [0, 20, 40])
def test_blocks_round_trip(n_top):
    """Words of the table come first and travel as places, the others as codes."""
    rng = np.random.default_rng(2)
    top = np.sort(rng.integers(0, 2**63, 40).astype(np.uint64))
    codes = np.concatenate([top[:n_top], rng.integers(0, 2**63, 50 - n_top).astype(np.uint64), np.zeros(1, np.uint64)])
    rows, weights = rng.integers(0, 51, (30, 4)).astype(np.int32), rng.integers(1, 9, 30)
    places = C.in_top(codes, top)
    assert (places >= 0).sum() == n_top
    back, w, known, at = C.unpack(C.pack(rows, weights, codes, places), top)
    assert (known[back] == codes[rows]).all() and (w == weights).all() and (at == C.in_top(known, top)).all()


def test_codes_and_salt(spark, monkeypatch):
    words = spark.createDataFrame([("en", "é漢", 1), ("de", "x", 2)], "lang string, word string, n bigint")
    for r in words.withColumn("code", C.code("+")).collect():
        assert r.code % 2**64 == C._code("+", r.lang, r.word.encode())
    plain = C.code
    monkeypatch.setattr(C, "code", lambda salt: plain(salt) if salt else F.lit(7).cast("bigint"))
    assert C.injective_salt(words) == "+"


def test_awkward_rows(spark, awkward, nothing):
    docs = awkward.withColumn("lang", F.col("source"))
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert found(C.collocations(docs)) == brute(rows, 30)
    assert found(C.collocations(docs, least=1, keep=None, chunk_bytes=1000)) == brute(rows, 1, keep=None)
    assert C.collocations(docs.limit(0)).count() == 0


def test_very_long_text(spark):
    text = "one two three four five six seven. " * 20_000 + "no end " * 50_000
    got = C.collocations(spark.createDataFrame([(text, "en")], "text string, lang string"), chunk_bytes=100_000)
    assert found(got) == brute([(text, "en")], 30)
