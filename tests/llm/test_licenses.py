"""License scans against brute force over all template substrings."""

import random
import re
import time

from tessera.llm import licenses
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(ws, phrase):
    p = phrase.split()
    return [i for i in range(len(ws) - len(p) + 1) if ws[i:i + len(p)] == p]


def base_row(text):
    ws = words(text)
    found = [(i, label) for label, phrase in licenses.PHRASES for i in places(ws, phrase)]
    return (len(ws), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None),
            ",".join(sorted({label for _, label in found})))


def brute_chains(text, scanner):
    """Greatest covered share per label by dynamic programming over all maximal matches of all templates."""
    ws, best = words(text), {}
    for label, template in licenses.TEMPLATES:
        t = words(template)
        # longest common extension of every pair of places, as matches that nothing extends in the template set
        chains = []
        matches = set()
        for i in range(len(ws)):
            longest = max((n for _, other in [*licenses.PHRASES, *licenses.TEMPLATES] for n in [common_end(ws, i, words(other))]), default=0)
            if longest < licenses.LONG:
                continue
            after = max((common_end(ws, i + 1, words(o)) for _, o in [*licenses.PHRASES, *licenses.TEMPLATES]), default=0) if i + 1 < len(ws) else 0
            if after == longest + 1:
                continue
            run = ws[i - longest + 1:i + 1]
            matches |= {(i - longest + 1, k, longest) for k in range(len(t) - longest + 1) if t[k:k + longest] == run}
        for start, place, n in sorted(matches, key=lambda m: (m[0] + m[2], m[1])):
            covered = n
            for s, e, p, w in chains:
                new = n - max(0, e - start, p - place)
                if start - e <= licenses.GAP and new > 0:
                    covered = max(covered, w + new)
            chains.append((start, start + n, place + n, covered))
            best[label] = max(best.get(label, 0), covered / len(t))
    return best


def common_end(ws, i, t):
    """Length of the longest run of words that ends at ``i`` and stands in ``t``."""
    best = 0
    for k in range(len(t)):
        n = 0
        while n <= min(i, k) and ws[i - n] == t[k - n]:
            n += 1
        best = max(best, n)
    return best


def test_matching_statistics():
    rng = random.Random(3)
    for _ in range(60):
        texts = [[rng.randint(1, 3) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 4))]
        auto = licenses.Automaton(texts)
        stream = [rng.randint(1, 4) for _ in range(40)]
        state = length = 0
        for i, word in enumerate(stream):
            state, length = auto.step(state, length, word)
            want = max(common_end(stream, i, t) for t in texts)
            assert length == want
            if length:
                run = stream[i - length + 1:i + 1]
                assert sorted(auto.ends[state]) == sorted(
                    (k, e) for k, t in enumerate(texts) for e in range(len(t)) if e + 1 >= length and t[e - length + 1:e + 1] == run)


def test_op13_base(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op13_license_automaton"](spark, SF).collect()
    assert len(got) == len(docs) and any(r.n_base for r in got)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_row(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base)


def test_templates_against_brute_force():
    rng = random.Random(5)
    scanner = licenses.Scanner()
    pool = [w for _, t in licenses.TEMPLATES for w in words(t)] + ["zebra"] * 20
    for _ in range(12):
        label, template = rng.choice(licenses.TEMPLATES)
        t = words(template)
        for _ in range(rng.randint(0, 4)):  # edited, cut and padded copies
            k = rng.randrange(len(t))
            t[k:k + rng.randint(0, 2)] = rng.choices(pool, k=rng.randint(0, 3))
        text = " ".join(rng.choices(pool, k=10) + t + rng.choices(pool, k=10))
        _, spans, score = scanner.scan(text.encode())
        want = brute_chains(text, scanner)
        assert {s.label for s in spans if not s.base} == {k for k, v in want.items() if v >= licenses.COVERED}
        if not any(s.base for s in spans):
            assert abs(score - max(want.values(), default=0)) < 1e-12


def test_notices_and_clean_texts():
    scanner = licenses.Scanner()

    def labels(text):
        return {s.label for s in scanner.scan(text.encode())[1]}

    for label, template in licenses.TEMPLATES:
        assert label in labels("Some words. " + template + " More words.")
    mit = dict(licenses.TEMPLATES)["mit"]
    assert labels(mit.replace("Software", "Program", 2)) == {"mit"}
    assert labels("* " + mit.upper().replace("\n", "\n * ")) == {"mit"}
    assert labels("the software is provided to any person who asks for a copy of this software") == set()
    assert labels("Licensed under CC BY 4.0.") == {"cc-by"}
    spans = scanner.scan(("words " * 7 + mit + " gap " * 50 + mit).encode())[1]
    n = len(words(mit))
    assert [(s.label, s.start, s.end) for s in spans] == [("mit", 7, 7 + n), ("mit", 57 + n, 57 + 2 * n)]


def test_awkward_rows(spark, awkward, nothing):
    got = licenses.find_licenses(awkward)
    assert got.columns == ["doc_id", "n_words", "spans", "score"]
    want = sorted((-1 if r.doc_id is None else r.doc_id, len(words(r.text))) for r in awkward.collect())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words) for r in got.collect()) == want
    assert licenses.find_licenses(nothing).count() == 0


def test_very_long_texts():
    scanner = licenses.Scanner()
    mit = dict(licenses.TEMPLATES)["mit"]
    began = time.perf_counter()
    n, spans, score = scanner.scan(((mit + "\n") * 3000).encode())
    assert len(spans) == 3000 and score == 1.0
    assert scanner.scan(b"copies of the software " * 100_000)[2] < 0.5
    assert time.perf_counter() - began < 60
