"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its distinct plain words and their five-byte pieces, each
hashed to ``2**HASH_BITS`` buckets.  Every bucket of at least ``LEAST`` sampled
texts is in the model, whatever it says by itself, so that pairs of terms which
are neutral alone can be learned, too.  The machine's logit is bias + sum w_i + sum over pairs <v_i, v_j>; the pair part is computed
as half of (sum v)^2 - sum v^2 per factor, and learns what terms mean together
(an insult beside a group's name) beyond their single weights.

The model is fitted in one task on at most ``PER_CLASS`` labelled documents of
each class, weighted back to the class shares, in small batches.  A weight
stands at its start plus a step by the sum of its slopes over their root of
squares, less a share for chance: what one term explains moves no other, and
the many terms that say nothing stay where they are.  Scoring covers every row.

Defined cases: null and empty texts have no terms and score as the bias; a
repeated word counts once; without labels, or with one class only, every score
is that class's share (0.5 if there is none).  Labels, language, source and id
are never inputs; extra columns are ignored.
"""

from __future__ import annotations

import functools
import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import plain_words, slices, text_bytes
from tessera.llm.labelled import fitted, labelled_sample, sigmoid

HASH_BITS, PIECE, LEAST, FACTORS = 31, 5, 3, 8
PER_CLASS, STEPS, KEEP = 4000, 200, 100_000
#: Bytes of a model that is sent to the executors, at most.
MOST_MODEL = 256 << 20
#: A batch of the fit: texts and terms at most; passes over the sample at least.
BATCH, BATCH_TERMS, PASSES = 128, 1 << 20, 8
#: Steps by array; a weight moves as far as its summed slopes exceed ``DOUBT`` times their spread, in each pass anew; start
#: weights are log odds less ``SURE`` standard errors.
RATES, DOUBT, SURE = {"bias": 0.1, "w": 0.3, "v": 0.1}, 1.0, 3.0


def word_terms(word: bytes) -> list[int]:
    """Buckets of a word and of its pieces."""
    mask = (1 << HASH_BITS) - 1
    grams = [b"g" + word[i:i + PIECE] for i in range(len(word) - PIECE + 1)] if len(word) > PIECE else []
    return [zlib.crc32(t) & mask for t in (b"w" + word, *grams)]


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        terms = [sorted({t for w in set(plain_words(x)) for t in word_terms(w)}) for x in text_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.list_(pa.int32())), batch.column("label"),
                                          batch.column("weight")], ["terms", "label", "weight"])


def _segment_sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` between consecutive ``cuts`` (0 for empty stretches)."""
    out = np.zeros((len(cuts) - 1, *values.shape[1:]))
    full = np.flatnonzero(cuts[1:] > cuts[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, cuts[full], axis=0)
    return out


def logits(p: dict[str, np.ndarray], term: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logit of each text, whose terms stand between its cuts, and the sum of their factors."""
    alone = p["w"] - 0.5 * (p["v"] * p["v"]).sum(1)
    total = _segment_sums(p["v"][term], cuts)
    return p["bias"] + _segment_sums(alone[term], cuts) + 0.5 * (total * total).sum(1), total


def _batches(sizes: np.ndarray, order: np.ndarray) -> Iterator[np.ndarray]:
    """Texts in the given order, at most ``BATCH`` texts and, but for a single one, ``BATCH_TERMS`` terms at a time."""
    start = held = 0
    for i, n in enumerate(sizes[order].tolist()):
        if i > start and (i - start == BATCH or held + n > BATCH_TERMS):
            yield order[start:i]
            start, held = i, 0
        held += n
    if len(order) > start:
        yield order[start:]


def fit(sample: pa.Table) -> dict[str, np.ndarray]:
    """Fit the machine to all buckets that are not too rare, on the weighted log loss."""
    if not sample.num_rows:
        return {"bias": np.zeros(1), "w": np.zeros(1), "v": np.zeros((1, FACTORS)), "buckets": np.zeros(0, np.int64)}
    label, weight = sample["label"].to_numpy().astype(float), sample["weight"].to_numpy()
    terms = sample["terms"].combine_chunks()
    sizes = np.diff(terms.offsets.to_numpy()).astype(np.int64)
    found = terms.flatten().to_numpy()
    cuts = np.cumsum([0, *sizes])
    digest = [zlib.crc32(found[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
    order = np.lexsort((digest, label))  # the sum's order, and so its rounding, does not depend on partitioning
    buckets, term, seen = np.unique(found, return_inverse=True, return_counts=True)
    hits = np.bincount(term, np.repeat(label, sizes))
    kept = np.flatnonzero(seen >= LEAST)
    number = np.full(len(buckets), -1, np.int32)
    number[kept] = np.arange(len(kept), dtype=np.int32)
    term = number[term]
    sizes = _segment_sums((term >= 0).astype(float), cuts).astype(np.int64)
    term = term[term >= 0]
    cuts = np.cumsum([0, *sizes])
    positives, n = label.sum(), max(1, len(kept))
    share = np.clip((weight * label).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    # Weights start at the terms' log odds as far as they are certain, so that a term of one class counts by itself, too.
    toxic, other = hits[kept] + 0.5, seen[kept] - hits[kept] + 0.5
    odds = np.log(toxic / (positives + 1)) - np.log(other / (len(label) - positives + 1))
    odds = np.sign(odds) * np.maximum(np.abs(odds) - SURE * np.sqrt(1 / toxic + 1 / other), 0)
    rng = np.random.default_rng(7)
    p = {"bias": np.array([np.log(share / (1 - share))]), "w": np.resize(odds, n),
         "v": rng.normal(0, 0.01, (n, FACTORS))}
    balance = weight / weight.mean()
    start = {k: x.copy() for k, x in p.items()}
    slopes, squares = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.full_like(x, 1e-8) for k, x in p.items()}
    steps, passes = 0, 0
    while 0 < positives < len(label) and (steps < STEPS or passes < PASSES):
        for batch in _batches(sizes, rng.permutation(order)):
            own = np.concatenate([term[cuts[i]:cuts[i + 1]] for i in batch])
            ends = np.cumsum([0, *sizes[batch]])
            here, own = np.unique(own, return_inverse=True)  # the batch's terms; no other weight moves
            w, v = p["w"][here], p["v"][here]
            logit, total = logits({"bias": p["bias"], "w": w, "v": v}, own, ends)
            g = balance[batch] * (sigmoid(logit) - label[batch])
            # A term's factor moves by the sum of the other terms' factors in its texts.
            by_term = np.argsort(own, kind="stable")
            texts = np.repeat(np.arange(len(batch)), sizes[batch])[by_term]
            slope = _segment_sums(np.hstack([g[:, None], g[:, None] * total])[texts], np.searchsorted(own[by_term], np.arange(len(here) + 1)))
            for name, at, x in (("bias", slice(None), g.sum(keepdims=True)), ("w", here, slope[:, 0]),
                                ("v", here, slope[:, 1:] - slope[:, :1] * v)):
                slopes[name][at] += x
                squares[name][at] += x * x
                z = slopes[name][at] / np.sqrt(squares[name][at])
                doubt = 0 if name == "bias" else DOUBT * np.sqrt(passes + 1)
                p[name][at] = start[name][at] - RATES[name] * np.sign(z) * np.maximum(np.abs(z) - doubt, 0)
            steps += 1
        passes += 1
    return p | {"buckets": buckets[kept].astype(np.int64)}


class Scorer:
    """Scores texts with a fitted model; the places of a word's known terms are kept per worker, as bytes."""

    def __init__(self, model: dict[str, np.ndarray]):
        self.model = model
        self.buckets = model["buckets"].astype(np.int64)
        self.words: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        found = [word_terms(w) for w in words]
        flat = np.array([t for f in found for t in f], np.int64)
        at = np.minimum(np.searchsorted(self.buckets, flat), max(0, len(self.buckets) - 1))
        hit = self.buckets[at] == flat if len(self.buckets) else np.zeros(len(flat), bool)
        at, ends = at.astype(np.int32), np.cumsum([0, *map(len, found)])
        upto = np.concatenate([[0], np.cumsum(hit)])[ends]
        kept = at[hit].tobytes()
        for w, a, b in zip(words, upto[:-1].tolist(), upto[1:].tolist()):
            self.words[w] = kept[4 * a:4 * b]

    def terms(self, text: bytes) -> np.ndarray:
        """Sorted places of the text's terms in the model."""
        words = set(plain_words(text))
        if len(self.words) > KEEP:
            self.words.clear()
        new = words.difference(self.words)
        if new:
            self.learn(new)
        return np.unique(np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int32))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        found = [self.terms(t) for t in texts]
        cuts = np.cumsum([0] + [len(f) for f in found])
        return sigmoid(logits(self.model, np.concatenate(found) if found else np.zeros(0, np.int32), cuts)[0])


def pack_model(model: dict[str, np.ndarray]) -> bytes:
    """The model in single precision, as bytes."""
    out = io.BytesIO()
    np.savez(out, **{k: x.astype(np.int32 if k == "buckets" else np.float32) for k, x in model.items()})
    if out.tell() > MOST_MODEL:
        raise ValueError(f"a model of {out.tell()} bytes; {MOST_MODEL} may be sent")
    return out.getvalue()


@functools.lru_cache(maxsize=1)
def _scorer(packed: bytes) -> Scorer:
    """A worker keeps the scorer, and the words that it knows."""
    with np.load(io.BytesIO(packed)) as arrays:
        return Scorer(dict(arrays))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out_of: int = 5) -> dict[str, np.ndarray]:
    rows, _ = labelled_sample(docs, labels, label, PER_CLASS, held_out_of)
    return fitted(rows.mapInArrow(_sample_terms, "terms array<int>, label int, weight double"), fit)


def score(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    # Bounded by the sample's terms; a broadcast is sent to each executor once, not with every task.
    packed = docs.sparkSession.sparkContext.broadcast(pack_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _scorer(packed.value)
        for batch in slices(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(own.scores(text_bytes(batch.column("text"))))], ["id", "score"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
