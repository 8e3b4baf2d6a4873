r"""Exact token counts at every prefix, by dynamic programming.

For a word-end BPE vocabulary a prefix of a word is encoded as if the word
ended there.  Per word the programme keeps, for every prefix, the last token
of the prefix's own encoding: a sequence of tokens is the BPE encoding of its
text exactly if each neighbouring pair is, so the last token of a longer
prefix is the only token ending there that may follow the last token of the
prefix before it.  The count of a prefix is one more than the count before its
last token; for a cut, the last token is a word-end token instead.

Words never share tokens, so the counts of a text are those of its
white-space-separated chunks put end to end.  A chunk is worked out once per
Python worker and kept (``KEEP`` chunks and those of the generation before;
this bounds the memory and changes the speed only).

What is stored per text, ``prefix``, has one byte for each code point: the
change of the count at that point, plus 128.  Running sums give the count of
every prefix, hence the longest prefix within a budget, without encoding.

A chunk that holds special-token strings, characters that normalisation changes
or lower-casing that changes lengths is cut where one unit surely ends and the next
begins, far from such characters; only the stretches that hold one are
counted prefix by prefix with the library itself.  ``stored`` writes the tables, and
``within_budget`` answers truncation questions from them as a column.  Null counts as empty; empty texts have 0 tokens and an empty
prefix table.  Rows are independent: repeated rows give repeated results.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, text_bytes

KEEP = 300_000
_BIAS = 128
_BLANK = bytes(0x20 if b in b"\t\n\x0b\x0c\r" else b for b in range(256))
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_MARKS = '.,;:!?|*#%&$()"-'
_UNITS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary (the public GPT-2 rule)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + rest.index(b)) for b in range(256)]


@functools.lru_cache(maxsize=1 << 16)
def kind_of(c: str) -> str:
    """L, N, S (white space) or O for a character that stays one character whatever stands beside it, else nothing."""
    if c in "'<|>" or len(low := c.lower()) != 1 or not unicodedata.is_normalized("NFC", c + low) or unicodedata.normalize("NFC", c) != c:
        return ""
    group = unicodedata.category(c)
    if group[0] in "MC" or "\u1100" <= c <= "\u11ff" or "\ua960" <= c <= "\ua97f" or "\ud7b0" <= c <= "\ud7ff":
        return ""  # marks and parts of syllables may join what stands before; what control characters are is not sure
    return {"L": "L", "N": "N", "Z": "S"}.get(group[0], "O")


class PrefixCounter:
    """Counts for one vocabulary file (BPE, word ends, lower case, byte level)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, self.specials)))
        vocab = model["vocab"]
        # Every ending of a token's text (in symbols): the token inside a word and at a word's end with just that text, or -1.
        self.ending: dict[str, tuple[int, int]] = {}
        for token, i in vocab.items():
            at_end = token.endswith(self.end) and token != self.end
            body = token[:-len(self.end)] if at_end else token
            inner, final = self.ending.get(body, (-1, -1))
            self.ending[body] = (inner, i) if at_end else (i, final)
            for k in range(1, len(body)):
                self.ending.setdefault(body[k:], (-1, -1))
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # By token: the order in which its merge is applied, and its two parts; characters are never split.
        self.rank = {vocab[a + b]: n for n, (a, b) in reversed(list(enumerate(merges)))}
        self.parts = {vocab[a + b]: (vocab[a], vocab[b]) for a, b in reversed(merges)}
        self.joined = {(vocab[a], vocab[b]): n for n, (a, b) in reversed(list(enumerate(merges)))}
        self.allowed: dict[int, bool] = {}
        self.alphabet = byte_alphabet()
        self.words: dict[str, bytes | list[int]] = {}
        self.odd: dict[str, list[int]] = {}
        self.chunks: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}

    def follows(self, left: int, right: int) -> bool:
        """Whether BPE leaves ``left`` and ``right`` side by side.

        It does if no merge across the border would have been applied before
        the merges that made both sides; the tokens at the border are undone
        latest merge first.
        """
        a, b, before, ok = left, right, len(self.joined) + 1, True
        while True:
            across = self.joined.get((a, b))
            # On a tie of order the leftmost pair is merged first: the left token's own merge wins, the right one's loses.
            if across is not None and across < before:
                ok = False
                break
            ra, rb = self.rank.get(a, -1), self.rank.get(b, -1)
            if ra < 0 and rb < 0:
                break
            if ra > rb:
                before, a = ra, self.parts[a][1]
            else:
                before, b = rb + 1, self.parts[b][0]
        self.allowed[left << 20 | right] = ok
        return ok

    def learn(self, words: set[str]) -> None:
        """Work out unknown words; in sorted order a word starts from the states of the prefix it shares with the last one."""
        ending, allowed, follows = self.ending, self.allowed, self.follows
        coded = []
        for word in words:
            if word.isascii() and word.isprintable():
                coded.append((word, word))
            else:
                coded.append(("".join([self.alphabet[b] for b in word.encode("utf-8")]), word))
        coded.sort()
        last, count, cut = [-1], [0], [0]  # by prefix length: last token, count, count if the word ended there
        before = ""
        for symbols, word in coded:
            shared = len(os.path.commonprefix((before, symbols)))
            del last[shared + 1:], count[shared + 1:], cut[shared + 1:]
            before = symbols
            for i in range(shared + 1, len(symbols) + 1):
                inner, final = [], []
                j = i - 1
                while j >= 0 and (found := ending.get(symbols[j:i])) is not None:
                    if found[0] >= 0:
                        inner.append((j, found[0]))
                    if found[1] >= 0:
                        final.append((j, found[1]))
                    j -= 1
                for ends, into in ((inner, count), (final, cut)):
                    for j, token in reversed(ends):
                        if j:
                            ok = allowed.get(last[j] << 20 | token)
                            if not (follows(last[j], token) if ok is None else ok):
                                continue
                        into.append(count[j] + 1)
                        if into is count:
                            last.append(token)
                        break
            if len(word) == len(symbols):
                own = cut[1:]
            else:
                own = [cut[e] for e in itertools.accumulate(len(c.encode("utf-8")) for c in word)]
            self.words[word] = bytes(own) if len(own) < 256 else own

    def word(self, word: str) -> bytes | list[int]:
        """Token count of each code point's prefix of one word (a unit without contractions or white space)."""
        if word not in self.words:
            self.learn({word})
        return self.words[word]

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def units(self, chunk: str) -> list[tuple[int, str]] | None:
        """(start, unit) of a chunk's lower-cased words, marks and digits; None if it needs the library."""
        low = chunk.lower()
        if low.isascii() or max(chunk) < "\u0180":
            simple = len(low) == len(chunk)
        else:
            low = "".join([c.lower() for c in chunk])
            simple = (len(low) == len(chunk) and unicodedata.is_normalized("NFC", chunk)
                      and unicodedata.is_normalized("NFC", low))
        if not simple or "<|" in chunk and self.special.search(chunk):
            return None
        body = low.rstrip(_MARKS)
        if body.isalpha():  # the usual case: a word and the marks that follow it
            return [(0, body), (len(body), low[len(body):])] if len(body) < len(low) else [(0, body)]
        return [(m.start(), m[0]) for m in _UNITS.finditer(low)]

    def stretches(self, chunk: str) -> list[str]:
        """A chunk cut between plain characters of different kinds (letters, numbers, others) and between numbers.

        Nothing that normalisation, contractions or special strings do reaches over such a cut.
        """
        bare = [kind_of(c) for c in chunk]
        held = set()
        for m in self.special.finditer(chunk):
            held.update(range(m.start() + 1, m.end()))
        cuts = [i for i in range(1, len(chunk)) if bare[i - 1] and bare[i] and (bare[i - 1] != bare[i] or bare[i] == "N") and i not in held]
        return [chunk[a:b] for a, b in itertools.pairwise([0, *cuts, len(chunk)])]

    def odd_counts(self, chunk: str) -> list[int]:
        """Counts of a chunk that ``units`` cannot part: stretch by stretch, those with an odd character by the library."""
        out: list[int] = []
        for stretch in self.stretches(chunk):
            base = out[-1] if out else 0
            own = self.odd.get(stretch)
            if own is None:
                units = self.units(stretch)
                own = self.counts(len(stretch), units) if units is not None else [
                    len(self.library.encode(stretch[:i], add_special_tokens=False).ids) for i in range(1, len(stretch) + 1)]
                if len(self.odd) > KEEP:
                    self.odd.clear()
                self.odd[stretch] = own
            out += [base + c for c in own]
        return out

    def counts(self, size: int, units: list[tuple[int, str]]) -> list[int]:
        """Token count of every code point's prefix of a chunk without ASCII white space."""
        out: list[int] = []
        base = 0
        for start, unit in units:
            out += [base] * (start - len(out))  # white space beyond ASCII
            if unit in _CONTRACTIONS:
                own = [*self.word("'"), *[1 + c for c in self.word(unit[1:])]]  # cut inside: a mark, then letters
                own[-1] = self.word(unit)[-1]
            else:
                own = self.word(unit)
            out += [base + c for c in own]
            base = out[-1]
        return out + [base] * (size - len(out))

    def add(self, chunks: set[bytes]) -> None:
        """Work out unknown chunks together."""
        split = {c: self.units(text) for c in chunks if (text := c.decode("utf-8"))}
        if len(self.words) > KEEP:
            self.words.clear()
        self.learn({u for units in split.values() for _, u in units or ()}.difference(self.words))
        for chunk, units in split.items():
            text = chunk.decode("utf-8")
            counts = self.counts(len(text), units) if units is not None else self.odd_counts(text)
            self.chunks[chunk] = bytes([b - a + _BIAS for a, b in zip([0, *counts], counts)])

    def tables(self, texts: list[bytes]) -> list[bytes]:
        """The prefix table of each text; white space changes nothing."""
        split = [t.translate(_BLANK).split(b" ") for t in texts]
        if len(self.chunks) > KEEP:
            self.old, self.chunks = self.chunks, {b"": b""}
        new = set().union(*split).difference(self.chunks)
        again = {c: self.old[c] for c in new if c in self.old}
        self.chunks |= again
        self.add(new.difference(again))
        get = self.chunks.__getitem__
        return [bytes([_BIAS]).join(map(get, chunks)) for chunks in split]


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def total(prefix: bytes) -> int:
    return int(np.frombuffer(prefix, np.uint8).sum(dtype=np.int64)) - _BIAS * len(prefix)


def tokens_at(prefix: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` code points."""
    return total(prefix[:max(0, n_chars)])


def longest_within(prefix: bytes, budget: int) -> int:
    """The most code points whose prefix has at most ``budget`` tokens (counts may fall again as a word grows)."""
    counts = np.cumsum(np.frombuffer(prefix, np.uint8).astype(np.int64) - _BIAS)
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, prefix) for every row; ``vocabulary`` is a path present on every executor."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        for batch in slices(batches, "text"):
            texts = text_bytes(batch.column("text"))
            tables = own.tables(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(map(len, texts), pa.int64()), pa.array(map(total, tables), pa.int64()),
                 pa.array(tables, pa.binary())], ["id", "n_bytes", "n_tokens", "prefix"])

    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, prefix binary")
            .withColumnRenamed("id", id_col))


def stored(docs: DataFrame, vocabulary: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the prefix tables below ``path`` and read them back; later questions need neither texts nor vocabulary."""
    prefix_counts(docs, vocabulary, id_col, text_col).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def within_budget(tables: DataFrame, budget: Column) -> DataFrame:
    """``tables`` plus ``n_chars``: the most code points of the text whose prefix has at most ``budget`` tokens.

    NULL for a NULL budget.  ``substring(text, 1, n_chars)`` is the text cut to the budget.
    """
    asked = tables.withColumn("n_chars", budget.cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "prefix"):
            got = [None if b is None else longest_within(p, b)
                   for p, b in zip(batch.column("prefix").to_pylist(), batch.column("n_chars").to_pylist())]
            yield batch.set_column(batch.schema.get_field_index("n_chars"), "n_chars", pa.array(got, pa.int64()))

    return asked.mapInArrow(run, asked.schema)
