"""Very long and odd texts end in seconds, with the same results."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tessera.llm import token_counts
from tessera.llm.queries import vocabulary


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary())


# ------------------------------------------------------------------ 6
ODD = ["が", "パ", "é", "İ", "ﬁ", "Å", "가", "가", "≠", "≠", "ǰ", "̈́", "क़"]
PLAIN = ["、", "。", "漢", "字", "a", "B", "é", "1", "2", "½", "!", "?", "'", "'s", "'ll", "<|endoftext|>", "<|", "|>", "<", "　", " ", "​",
         "\x1c", "\x85", "Σ", "ß", "_", "-", "٣", "ำ", "😀", " "]


def test_odd_chunks_count_as_the_library_does(library):
    rng = random.Random(11)
    own = token_counts.PrefixCounter(vocabulary())
    for _ in range(400):
        text = "".join(rng.choice(rng.choice([ODD, PLAIN, PLAIN])) for _ in range(rng.randint(1, 14)))
        prefix, = own.tables([text.encode()])
        for i in range(len(text) + 1):
            assert token_counts.tokens_at(prefix, i) == len(library.encode(text[:i], add_special_tokens=False).ids), ascii(text[:i])


def test_long_odd_chunk_ends(library):
    rng = random.Random(3)
    kana = "かきくけこさしすせそ漢字仮名"
    text = "".join("".join(rng.choice(kana) + ("゙" if rng.random() < 0.2 else "") for _ in range(rng.randint(1, 18))) + rng.choice("、。！1") for _ in range(42_000))
    assert len(text) > 450_000 and not any(c.isspace() for c in text)
    own = token_counts.PrefixCounter(vocabulary())
    began = time.perf_counter()
    prefix, = own.tables([text.encode()])
    assert time.perf_counter() - began < 60
    assert token_counts.total(prefix) == len(library.encode(text, add_special_tokens=False).ids)


def test_stored_tables_answer_budgets(spark, library, tmp_path):
    texts = ["the quick brown fox, isn't it?", "", None, "が、漢字 don't", "x " * 3000]
    docs = spark.createDataFrame([(i, t, i * 3) for i, t in enumerate(texts)], "doc_id bigint, text string, budget int")
    tables = token_counts.stored(docs, vocabulary(), f"{tmp_path}/prefixes")
    for budget in (0, 1, 5, 100):
        got = {r.doc_id: r.n_chars for r in token_counts.within_budget(tables, F.lit(budget)).collect()}
        for i, t in enumerate(texts):
            t = t or ""
            step = range(len(t) + 1) if len(t) < 100 else range(0, 2 * budget + 4)
            assert got[i] == max(k for k in step if len(library.encode(t[:k], add_special_tokens=False).ids) <= budget)
    per_row = token_counts.within_budget(tables.join(docs.select("doc_id", "budget"), "doc_id"), F.col("budget"))
    assert {r.doc_id: r.n_chars for r in per_row.collect()}[0] == 0
    assert token_counts.within_budget(tables, F.lit(None)).where("n_chars is not null").count() == 0


# ------------------------------------------------------------------ 8
def test_hostile_long_texts_end():
    """Half a million characters of headers without keys: seconds, and what stands among them is found."""
    import base64

    from tessera.llm import secret_scan

    def der(tag, *parts):
        body = b"".join(parts)
        n = len(body)
        size = bytes([n]) if n < 128 else b"\x82" + n.to_bytes(2, "big")
        return bytes([tag]) + size + body

    key = base64.b64encode(der(0x30, der(2, b"\0"), *[der(2, bytes([k] * 64)) for k in range(1, 9)])).decode()
    token = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiJ4In0." + "s" * 20
    began = time.perf_counter()
    for unit in ("MIIEpAIBAAKCAQEA", "MIIEMIIE", "eyJhbGciOiJ", "b3BlbnNzaC1rZXktdjEAAAAABG5vbmU", "308204a40201000282", "6f70656e7373682d6b65792d763100"):
        text = unit * (500_000 // len(unit))
        assert [s["kind"] for s in secret_scan.spans(text.encode())] in ([], ["hex"])
        mixed = f"{text}\n\n {key} \n{token} {text}"
        assert {"key", "token"} <= {s["kind"] for s in secret_scan.spans(mixed.encode())}
    heads = ".".join(["eyJhbGciOiJ" * 50] * 900)
    secret_scan.spans(heads.encode())
    assert time.perf_counter() - began < 120
