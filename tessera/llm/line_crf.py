"""Document quality from a linear-chain conditional random field over lines.

Each line has measures of its bytes and words (shares of capitals, digits,
symbols and marks, repeated neighbouring words, words that end in symbols, line
length and so on) and those of the lines before and after it.  The chain has
two states, good and bad; forward and backward sums give each line's exact
marginal.  A document's badness is the mean marginal weighted by line length;
a logistic curve turns it into the score.

Only documents are labelled.  A line model is fitted first on lines that carry
their document's label; then lines of bad documents keep the label bad where
that model agrees (at least the worst line does), and the chain is fitted on
these by its exact gradient.  All is fitted in one task on at most
``PER_CLASS`` documents of each class; scoring covers every line of every row.

Defined cases: null and empty texts are one empty line; empty lines have
weight 1 as the line end counts; without labels, or with one class only,
every score is that class's share (0.5 if there is none).  Rows are
independent; extra columns are ignored by ``score`` and kept by ``keep``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, text_bytes
from tessera.llm.labelled import Adam, fitted, labelled_sample, sigmoid

PER_CLASS, STEPS, SLICE_BYTES = 3000, 120, 2 << 20
#: The score from which a document counts as good.
GOOD = 0.3
N_MEASURES = 11
_UPPER, _DIGIT, _SYMBOL, _MARK, _SPACE, _HIGH = range(6)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, 255, np.uint8)
    kinds[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = _UPPER
    kinds[[*b"0123456789"]] = _DIGIT
    kinds[[*b"!#$%&*+/<=>@[\\]^_`{|}~"]] = _SYMBOL
    kinds[[*b"\"'(),-.:;?"]] = _MARK
    kinds[[*b" \t\n\x0b\x0c\r"]] = _SPACE
    kinds[128:] = _HIGH
    return kinds


_KINDS = _byte_kinds()
_MIX = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * 2 + 1


def line_measures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(measures by line, line lengths with their end, number of lines of each text)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.flatnonzero(data == 10) + 1
    starts = np.concatenate([[0], ends[:-1]])
    per_text = np.diff(np.concatenate([[0], np.searchsorted(ends, np.cumsum(sizes), side="right")]))
    length = (ends - starts).astype(np.int64)

    def per_line(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[ends] - total[starts]

    kind = _KINDS[data]
    upper = kind == _UPPER
    upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)  # capitals of U+00C0 to U+00DE
    space = kind == _SPACE
    first = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    last = np.flatnonzero(~space & np.concatenate([space[1:], [True]]))
    n_words = np.diff(np.searchsorted(first, np.concatenate([[0], ends])))
    measures = np.zeros((len(starts), N_MEASURES), np.float32)
    n, w = np.maximum(length - 1, 1), np.maximum(n_words, 1)
    if len(first):
        width = last - first + 1
        # A word's hash: its bytes' numbers times odd powers by place.
        place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data)))) if first[0] == 0 else \
            np.concatenate([np.zeros(first[0], np.int64),
                            np.arange(first[0], len(data)) - np.repeat(first, np.diff(np.append(first, len(data))))])
        hashed = np.add.reduceat(np.where(space, np.uint64(0), _MIX[data] * _MIX[place & 255]), first)
        line = np.searchsorted(ends, first, side="right")
        again = (hashed[1:] == hashed[:-1]) & (line[1:] == line[:-1])
        measures[:, 0] = np.bincount(line[1:][again], minlength=len(starts)) / w
        measures[:, 1] = np.bincount(line[kind[last] == _SYMBOL], minlength=len(starts)) / w
        measures[:, 2] = np.bincount(line, width, len(starts)) / w / 10
        measures[:, 3] = np.bincount(line[width == 1], minlength=len(starts)) / w
        measures[:, 4] = np.bincount(line[kind[last] == _MARK], minlength=len(starts)) / w
    measures[:, 5] = per_line(upper) / n
    measures[:, 6] = per_line(kind == _DIGIT) / n
    measures[:, 7] = per_line(kind == _SYMBOL) / n
    measures[:, 8] = per_line(kind == _MARK) / n
    measures[:, 9] = np.log1p(length) / 5
    measures[:, 10] = length == 1
    return measures, length, per_text


def neighbours(measures: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Each line's measures, those of the line before and after (0 beyond the text), edge flags, and 1."""
    ends = np.cumsum(per_text)
    is_first, is_last = np.zeros(len(measures), bool), np.zeros(len(measures), bool)
    is_first[ends - per_text] = True
    is_last[ends - 1] = True
    out = np.ones((len(measures), 3 * N_MEASURES + 3), np.float32)
    out[:, :N_MEASURES] = measures
    out[1:, N_MEASURES:2 * N_MEASURES] = measures[:-1]
    out[:-1, 2 * N_MEASURES:3 * N_MEASURES] = measures[1:]
    out[is_first, N_MEASURES:2 * N_MEASURES] = 0
    out[is_last, 2 * N_MEASURES:3 * N_MEASURES] = 0
    out[:, -3], out[:, -2] = is_first, is_last
    return out


class Chain:
    """Two-state chains of several texts laid end to end, run side by side, longest first."""

    def __init__(self, per_text: np.ndarray):
        self.order = np.argsort(-per_text, kind="stable")
        self.start = (np.cumsum(per_text) - per_text)[self.order]
        self.size = per_text[self.order]
        longest = int(self.size[0]) if len(self.size) else 0
        self.live = np.searchsorted(-self.size, -np.arange(longest), side="left")  # texts with more than t lines
        n = int(per_text.sum())
        self.inner = np.ones(n, bool)  # lines that have a next line
        self.inner[np.cumsum(per_text) - 1] = False

    def sums(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log forward and backward sums of each line and state; ``unary`` (lines, 2), ``pair`` (from, to)."""
        forward, backward = unary.copy(), np.zeros_like(unary)
        for t in range(1, len(self.live)):
            at = self.start[:self.live[t]] + t
            came = forward[at - 1]
            forward[at] += np.logaddexp(came[:, :1] + pair[0], came[:, 1:] + pair[1])
        for t in range(len(self.live) - 1, 0, -1):
            at = self.start[:self.live[t]] + t
            ahead = backward[at] + unary[at]
            backward[at - 1] = np.logaddexp(ahead[:, :1] + pair[:, 0], ahead[:, 1:] + pair[:, 1])
        return forward, backward

    def marginals(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each line's probability of state 1, and the expected number of each pair of neighbouring states."""
        forward, backward = self.sums(unary, pair)
        both = forward + backward
        whole = np.logaddexp(both[:, 0], both[:, 1])
        a = np.flatnonzero(self.inner)
        ahead = (unary + backward)[a + 1]
        pairs = np.exp(forward[a][:, :, None] + pair + ahead[:, None, :] - whole[a][:, None, None]).sum(0) if len(a) else np.zeros((2, 2))
        return sigmoid(both[:, 1] - both[:, 0]), pairs


def _unary(features: np.ndarray, w: np.ndarray) -> np.ndarray:
    bad = (features @ w.astype(np.float32)).astype(np.float64)
    return np.stack([np.zeros_like(bad), bad], 1)


def measured(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``line_measures`` of any number of texts, ``SLICE_BYTES`` at a time, as its work arrays are many times the text."""
    parts, held, size = [], [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= SLICE_BYTES:
            parts.append(line_measures(held))
            held, size = [], 0
    if held:
        parts.append(line_measures(held))
    return tuple(np.concatenate(p) for p in zip(*parts))


def _mean_badness(model: dict[str, np.ndarray], lines: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    measures, length, per_text = lines
    features = neighbours((measures - model["mean"]) / model["scale"], per_text)
    p, _ = Chain(per_text).marginals(_unary(features, model["w"]), model["pair"])
    starts = np.cumsum(per_text) - per_text
    return np.add.reduceat(p * length, starts) / np.add.reduceat(length, starts), p


def badness(model: dict[str, np.ndarray], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(each text's length-weighted mean marginal, each line's marginal, number of lines of each text)."""
    if not texts:
        return np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
    lines = measured(texts)
    return *_mean_badness(model, lines), lines[2]


def _curve(model: dict[str, np.ndarray], bad: np.ndarray) -> np.ndarray:
    x = np.clip(bad, 1e-4, 1 - 1e-4)
    return sigmoid(model["curve"][0] - model["curve"][1] * np.log(x / (1 - x)))


def fit(sample: pa.Table) -> dict[str, np.ndarray]:
    """Line model, relabelling, chain, and the curve from badness to the score of label 1."""
    width = 3 * N_MEASURES + 3
    model = {"mean": np.zeros(N_MEASURES), "scale": np.ones(N_MEASURES), "w": np.zeros(width),
             "pair": np.zeros((2, 2)), "curve": np.zeros(2)}
    if not sample.num_rows:
        return model
    # The order of sums, and so their rounding, does not depend on partitioning.
    sample = sample.sort_by([("label", "ascending"), ("digest", "ascending")])
    n_texts = sample.num_rows
    label, weight = sample["label"].to_numpy(), sample["weight"].to_numpy()
    share = np.clip((weight * label).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    if label.min() == label.max():
        return model | {"curve": np.array([np.log(share / (1 - share)), 0.0])}
    measures = np.frombuffer(b"".join(sample["measures"].to_pylist()), np.float32).reshape(-1, N_MEASURES)
    length = np.frombuffer(b"".join(sample["lengths"].to_pylist()), np.int64)
    per_text = sample["lines"].to_numpy()
    lines = measures, length, per_text
    model["mean"] = measures.mean(0, dtype=np.float64).astype(np.float32)
    model["scale"] = (measures.std(0, dtype=np.float64) + 1e-3).astype(np.float32)
    features = neighbours((measures - model["mean"]) / model["scale"], per_text)
    text = np.repeat(np.arange(n_texts), per_text)
    bad = 1.0 - label[text]
    # Every text weighs the same, whatever its number of lines.
    share_of_text = length / np.bincount(text, length)[text]
    p, adam = {"w": np.zeros(width)}, Adam(0.1)
    for _ in range(STEPS):
        g = share_of_text * (sigmoid(_unary(features, p["w"])[:, 1]) - bad) / n_texts
        adam.step(p, {"w": g.astype(np.float32) @ features + 1e-5 * p["w"]})
    seen = _unary(features, p["w"])[:, 1]
    worst = np.full(n_texts, -np.inf)
    np.maximum.at(worst, text, seen)
    state = (bad == 1) & ((seen > 0) | (seen == worst[text]))
    chain = Chain(per_text)
    a = np.flatnonzero(chain.inner)
    have = np.array([[((state[a] == i) & (state[a + 1] == j)).sum() for j in (0, 1)] for i in (0, 1)], float)
    q, adam = {"w": p["w"].copy(), "pair": np.zeros((2, 2))}, Adam(0.1)
    for _ in range(STEPS):
        marginal, pairs = chain.marginals(_unary(features, q["w"]), q["pair"])
        adam.step(q, {"w": (marginal - state).astype(np.float32) @ features / len(state) + 1e-4 * q["w"],
                      "pair": (pairs - have) / len(state) + 1e-4 * q["pair"]})
    model |= q
    mean_bad, _ = _mean_badness(model, lines)
    x = np.clip(mean_bad, 1e-4, 1 - 1e-4)
    x = np.log(x / (1 - x))
    c, adam = {"curve": np.array([0.0, 0.5])}, Adam(0.05)
    for _ in range(400):
        g = weight / weight.sum() * (sigmoid(c["curve"][0] - c["curve"][1] * x) - label)
        adam.step(c, {"curve": np.array([g.sum(), -(g * x).sum()])})
    return model | c


def _sample_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the fit needs of each text: its lines' measures and lengths, without the text."""
    for batch in slices(batches, "text", SLICE_BYTES):
        if not batch.num_rows:
            continue
        texts = text_bytes(batch.column("text"))
        measures, length, per_text = measured(texts)
        ends = np.cumsum(per_text)
        cuts = list(zip((ends - per_text).tolist(), ends.tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([measures[a:b].astype(np.float32).tobytes() for a, b in cuts], pa.binary()),
             pa.array([length[a:b].astype(np.int64).tobytes() for a, b in cuts], pa.binary()), pa.array(per_text, pa.int64()),
             pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), batch.column("label"), batch.column("weight")],
            ["measures", "lengths", "lines", "digest", "label", "weight"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out_of: int = 5) -> dict[str, np.ndarray]:
    rows, _ = labelled_sample(docs, labels, label, PER_CLASS, held_out_of)
    return fitted(rows.mapInArrow(
        _sample_lines, "measures binary, lengths binary, lines bigint, digest binary, label int, weight double"), fit)


def _scores(model: dict[str, np.ndarray], text_col: str, keep_from: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, SLICE_BYTES):
            found = _curve(model, badness(model, text_bytes(batch.column(text_col)))[0])
            if keep_from is not None:
                yield batch.filter(pa.array(found >= keep_from))
            else:
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found)], ["id", "score"])
    return run


def score(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_scores(model, "text", None), f"id {kind}, score double").withColumnRenamed("id", id_col)


def line_labels(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, bad array<double>): the marginal of each line of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            _, p, per_text = badness(model, text_bytes(batch.column("text")))
            cuts = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(cuts, p)], ["id", "bad"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, bad array<double>").withColumnRenamed("id", id_col)


def keep(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text", at_least: float = GOOD) -> DataFrame:
    """The rows of ``docs``, unchanged, that score at least ``at_least``."""
    return docs.mapInArrow(_scores(model, text_col, at_least), docs.schema)
