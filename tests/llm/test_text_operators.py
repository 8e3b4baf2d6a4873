"""Token counts, secrets, decontamination and language model against brute force."""

import hashlib
import json
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import rows
from tessera.llm import fm_index, katz, secret_scan, token_counts
from tessera.llm.common import fold, plain_words
from tessera.llm.queries import KATZ_ORDER, QUERIES, vocabulary

SF = "/root/testdata/sf0.001"


def documents(spark, sf=SF):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary())


# ------------------------------------------------------------------ 6
def test_every_prefix_count_is_the_library_s(library):
    own = token_counts.PrefixCounter(vocabulary())
    texts = [r[1] for r in rows() if r[1] and len(r[1]) < 300] + ["don't stop", "it's 'tis 're", "a'll b've 12 3", "é́x", " wide space"]
    for text, prefix in zip(texts, own.tables([t.encode() for t in texts])):
        assert len(prefix) == len(text)
        for i in range(len(text) + 1):
            assert token_counts.tokens_at(prefix, i) == len(library.encode(text[:i], add_special_tokens=False).ids), text[:i]


def test_budget_questions(library):
    own = token_counts.PrefixCounter(vocabulary())
    text = rows()[0][1]
    prefix, = own.tables([text.encode()])
    counts = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
    for budget in range(-1, counts[-1] + 2):
        assert token_counts.longest_within(prefix, budget) == max([i for i, c in enumerate(counts) if c <= budget], default=0)


def test_token_counts_of_awkward_rows(awkward, nothing, library):
    got = token_counts.prefix_counts(awkward, vocabulary()).collect()
    want = Counter((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.prefix_counts(nothing, vocabulary()).count() == 0


def test_op6(spark, library):
    want = {(d, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 2048) for d, t in documents(spark)}
    assert {tuple(r) for r in QUERIES["op6_token_counts"](spark, SF).collect()} == want


# ------------------------------------------------------------------ 8
def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x82, n >> 8, n & 255])
    return bytes([tag]) + size + body


def test_structure_is_confirmed():
    import base64
    number = der(2, b"\x01" + bytes(range(40)))
    rsa = der(0x30, der(2, b"\0") + number * 8)
    wrapped = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x86\x48")) + der(4, bytes(40)))
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + bytes(40)
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).rstrip(b"=").decode()
    body = base64.urlsafe_b64encode(b'{"sub":"1"}').rstrip(b"=").decode()
    for data in (rsa, wrapped, ssh):
        plain = base64.b64encode(data).decode()
        assert [s["kind"] for s in secret_scan.spans(f"é {plain} z".encode())].count("key") == 1
        broken = base64.b64encode(data[:-30]).decode()
        assert "key" not in [s["kind"] for s in secret_scan.spans(f"é {broken} z".encode())] or data is ssh
    assert secret_scan.is_der_key(rsa) and not secret_scan.is_der_key(rsa + b"x") and not secret_scan.is_der_key(b"")
    assert "key" in [s["kind"] for s in secret_scan.spans(rsa.hex().encode())]
    armour = "-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(rsa).decode() + "-----END RSA PRIVATE KEY-----"
    assert [(s["kind"], s["start"], s["end"]) for s in secret_scan.spans(("ß" + armour).encode()) if s["kind"] == "key"] == [("key", 1, 1 + len(armour))]
    token = f"{head}.{body}.{'s' * 20}"
    assert [(s["kind"], s["start"], s["end"]) for s in secret_scan.spans(("ü " + token).encode())] == [("token", 2, 2 + len(token))]
    assert secret_scan.spans(f"{head[:-3]}.{body}.{'s' * 20}".encode()) == []


def test_keys_and_tokens_in_any_dress():
    import base64
    rng = np.random.default_rng(5)
    number = der(2, b"\x01" + rng.bytes(140))
    rsa = der(0x30, der(2, b"\0") + number * 8)
    wrapped = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x86\x48")) + der(4, rsa))
    part = lambda x: len(x).to_bytes(4, "big") + x
    ssh = b"openssh-key-v1\0" + part(b"none") + part(b"none") + part(b"") + (1).to_bytes(4, "big") + part(rng.bytes(51)) + part(rng.bytes(136))

    def found(text, kind="key"):
        return [text[s["start"]:s["end"]] for s in secret_scan.spans(text.encode()) if s["kind"] == kind]

    for data, label in ((rsa, "RSA PRIVATE KEY"), (wrapped, "PRIVATE KEY"), (ssh, "OPENSSH PRIVATE KEY")):
        flat = base64.b64encode(data).decode()
        lines = [flat[i:i + 64] for i in range(0, len(flat), 64)]
        for gap in ("\n", "\\n", "\\r\\n", "\\\\n", "\r\n    ", " ", '\\n" +\n    "', "\n> ", "%0A", "\n+", "\n// "):
            block = f"-----BEGIN {label}-----{gap}{gap.join(lines)}{gap}-----END {label}-----"
            assert found('é {"private_key": "' + block + '\\n"}') == [block], gap
            if gap != " ":  # blanks alone join nothing without armour
                joined = gap.join(lines)
                assert found(f"here:\n{joined}\nthe end") == [joined], gap
        slashes = flat.replace("/", "\\/").replace("+", "\\u002b")
        assert found(f'"-----BEGIN {label}-----\\n{slashes}\\n-----END {label}-----"')
        for before in ("path/", "my_", "x-", "n", "MIIM"):  # inside a run
            assert found(f"see {before}{flat} there") == [flat], before
        cut = "\n".join(lines[:-2])
        assert data is ssh or found(f"{cut}\nThe quick brown fox jumps over the lazy dog\n" * 9) == []  # not completed from what follows
    for text in (wrapped.hex(), wrapped.hex().upper(), wrapped.hex(":"), "\n".join(wrapped.hex()[i:i + 64] for i in range(0, 2 * len(wrapped), 64))):
        assert found(f"00ff{text} end") == [text]
    assert not found("MIIE" * 3000) and not found(wrapped[:-9].hex())

    code = lambda x: base64.urlsafe_b64encode(x).rstrip(b"=").decode()
    for head in (b'{"alg":"HS256"}', b'{\n "alg": "ES256"}'):
        token = f"{code(head)}.{code(b'{"sub":"1234567890"}')}.{'s' * 20}"
        for before in ("x-auth-token.", "some.dotted-name.second-name.", "id_", "key-"):
            assert found(before + token, "token") == [token], before
    assert not found(f"x-auth-token.{code(b'{"typ":"JWT"}')}.{code(b'{"sub":"1234567890"}')}.{'s' * 20}", "token")


def base_spans(text):
    import re
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_op8(spark):
    some = 0
    for sf in (SF, "/root/testdata/sf0.01"):
        want = {}
        for d, t in documents(spark, sf):
            found = base_spans(t or "")
            text = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in found)
            n = Counter(k for _, k, _ in found)
            want[d] = (n[0], n[1], n[2], hashlib.sha256(text.encode()).hexdigest())
        got = QUERIES["op8_secret_scan"](spark, sf).collect()
        assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got} == want
        some += sum(n[0] + n[1] + n[2] for n in want.values())
    assert some


def test_secrets_of_awkward_rows(awkward, nothing):
    got = secret_scan.find_secrets(awkward)
    assert got.count() == len(rows()) and got.columns == ["doc_id", "spans"]
    assert secret_scan.find_secrets(nothing).count() == 0


# ------------------------------------------------------------------ 3
def brute_windows(docs, items, size=10):
    windows = {}
    for name, text in items:
        w = plain_words((text or "").encode())
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("null" if name is None else str(name))
    out = []
    for d, text in docs:
        w = plain_words((text or "").encode())
        hit, found = np.zeros(len(w), bool), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                names = windows.get(tuple(w[i:i + n]))
                if names:
                    hit[i:i + n] = True
                    found |= names
        out.append((d, len(w), int(hit.sum()), sorted(found)))
    return out


def test_fm_index_finds_all(spark):
    rng = np.random.default_rng(1)
    for _ in range(60):
        n, s, size = int(rng.integers(1, 60)), int(rng.integers(1, 5)), int(rng.integers(1, 4))
        text = rng.integers(0, s + 1, n)
        text[-1] = 0
        index, phrases = fm_index.FMIndex(text, s), rng.integers(1, s + 1, (10, size))
        low, high = index.search(phrases)
        for k, p in enumerate(phrases):
            where = [i for i in range(n - size + 1) if (text[i:i + size] == p).all()]
            assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == where


def test_contamination_of_awkward_rows(spark, awkward, nothing, monkeypatch):
    text = rows()[0][1]
    items = [(1, text), (1, text), (2, "one"), (3, None), (4, ""), (None, "brown fox"), (5, "word5 tail5 word6 tail6 word7 tail7 word8 tail8 word9 tail9")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(brute_windows([r[:2] for r in rows()], items), key=repr)

    def got():
        found = fm_index.contamination(awkward, bench).select("doc_id", "n_words", fm_index.hit_words("spans").alias("n"), "items").collect()
        return sorted(((r.doc_id, r.n_words, r.n, list(r["items"])) for r in found), key=repr)

    assert got() == want
    monkeypatch.setattr(fm_index, "BLOCK_BYTES", 60)  # several passes over the items
    assert got() == want
    assert fm_index.contamination(nothing, bench).count() == 0
    assert fm_index.clean(awkward, bench.limit(0)).count() == len(rows())
    clean = fm_index.clean(awkward, bench)
    assert clean.columns == awkward.columns and clean.count() == sum(w[2] == 0 for w in want)


def test_op3(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = {(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in brute_windows(documents(spark), items)}
    assert {tuple(r) for r in QUERIES["op3_fm_decontamination"](spark, SF).collect()} == want


# ------------------------------------------------------------------ 2
def brute_katz(docs, order=katz.ORDER):
    """Scores by dictionaries and plain recursion, with the operator's discounts."""
    start = b""
    texts = [(d, (t or "").encode().lower().split() + [b"\n"], zlib.crc32(str("" if d is None else d).encode()) % 7 != 2) for d, t in docs]

    def grams(w, n):
        w = [start] + w if n > 1 else w
        return [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]

    counts = {n: Counter() for n in range(1, order + 1)}
    docs_seen = 0
    for _, w, train in texts:
        if train:
            docs_seen += 1
            for n in counts:
                counts[n].update(grams(w, n))
    tally = lambda c: [*(sum(v == r for v in c.values()) for r in range(1, katz.K + 2)), len(c), sum(c.values())]
    cut = {n: katz.Discount(tally(c)) for n, c in counts.items()}
    kept = {n: {g: float(cut[n](np.array([c]))[0]) for g, c in counts[n].items()} for n in counts}
    total = cut[1].total
    rest = cut[1].left / total if total else 1.0

    def size(h):
        return docs_seen if h == (start,) else counts[len(h)].get(h, 0)

    def p(w, h):
        if not h:
            return kept[1][(w,)] / total if (w,) in kept[1] else rest
        if (*h, w) in kept[len(h) + 1]:
            return kept[len(h) + 1][(*h, w)] / size(h)
        lower = p(w, h[1:])
        return alpha[h] * lower if size(h) else lower

    followed = {}
    for n in range(2, order + 1):
        for g in counts[n]:
            followed.setdefault(g[:-1], []).append(g[-1])
    alpha = {}
    for n in range(1, order):
        for h in [h for h in followed if len(h) == n]:
            left = sum(counts[n + 1][(*h, w)] - kept[n + 1][(*h, w)] for w in followed[h])
            alpha[h] = left / size(h) / (1 - sum(p(w, h[1:]) for w in followed[h]))
    if counts[1]:
        assert math.isclose(sum(k for k in kept[1].values()) / total + rest, 1)
        for h in random.Random(1).sample(sorted(followed), min(25, len(followed))):  # each history's probabilities sum to 1
            every = sum(p(w, h) for (w,) in counts[1]) + p(b"never seen", h)
            assert math.isclose(every, 1, rel_tol=1e-9), h
    out = []
    for d, w, train in texts:
        base = sum(math.log10((counts[1][(x,)] + 1) / (total + len(counts[1]) + 1)) for x in w)
        whole = [start, *w]
        score = sum(math.log10(p(whole[i], tuple(whole[max(0, i - order + 1):i]))) for i in range(1, len(whole)))
        out.append((d, not train, len(w), sum((x,) in counts[1] for x in w), total, base, score))
    return out


def same_scores(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 3))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_katz_orders(spark, order):
    rng = random.Random(order)
    docs = [(i, " ".join(rng.choice("a b c d e f g of the".split()) for _ in range(rng.randint(0, 9)))) for i in range(120)]
    got = katz.score(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), fold("doc_id", 7) != 2, order=order)
    same_scores([tuple(r) for r in got.collect()], brute_katz(docs, order))


@pytest.mark.parametrize("order", [KATZ_ORDER, 3])
def test_op2(spark, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op2_katz_backoff"](spark, SF) if order == KATZ_ORDER else katz.score(docs.repartition(5), fold("doc_id", 7) != 2, order=order)
    same_scores([tuple(r) for r in got.collect()], brute_katz(documents(spark), order))


def test_katz_of_awkward_rows(awkward, nothing):
    got = [tuple(r) for r in katz.score(awkward, fold("doc_id", 7) != 2).collect()]
    same_scores(got, brute_katz([r[:2] for r in rows()]))
    assert katz.score(nothing, fold("doc_id", 7) != 2).count() == 0
    from pyspark.sql import functions as F
    assert {r.score for r in katz.score(awkward.where("doc_id = 5"), F.lit(False)).collect()} == {0.0}  # nothing learned
