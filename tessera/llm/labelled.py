"""Bounded labelled samples, and models that one task fits on them."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import fold


#: Bytes of a class's texts in a sample, at most (a class's first text is taken whatever its size).
MOST_BYTES = 24 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, held_out_of: int,
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """(text, label, weight) of at most ``per_class`` documents and ``MOST_BYTES`` of text of each class, and the class counts.

    Only labels outside the held-out fold count; of several labels of one id
    the largest does, and of several texts of one id the least.  Labels without a document take places
    in the sample, but no text.  The sample is the ids of least hash, so it does not
    depend on partitioning; ``weight`` restores the class shares.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & (fold(id_col, held_out_of) != 0))
             .groupBy(F.col(id_col).alias("l_id")).agg(F.max(label).cast("int").alias("label")))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = None
    for c, n in counts.items():
        part = (known.where(F.col("label") == c).orderBy(F.xxhash64("l_id"), "l_id").limit(per_class)
                .withColumn("weight", F.lit(n / min(n, per_class))))
        picked = part if picked is None else picked.unionAll(part)
    if picked is None:
        picked = known.withColumn("weight", F.lit(1.0))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(picked), F.col("id") == F.col("l_id"))  # at most per_class rows a class
            .groupBy("l_id", "label", "weight").agg(F.min("text").alias("text")))
    # At most ``per_class`` rows a class: texts in the order of the ids' hashes until the class's bytes are used up.
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    before = F.sum(size).over(Window.partitionBy("label").orderBy(F.xxhash64("l_id"), "l_id").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", before).where(F.coalesce("before", F.lit(0)) + size <= F.greatest(F.lit(MOST_BYTES), size))
    return rows.select("text", "label", "weight"), counts


def fitted(rows: DataFrame, fit: Callable[[pa.Table], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The arrays that ``fit`` makes of a bounded sample, in one task."""
    nothing = pa.Table.from_batches([], pa.schema([]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        out = io.BytesIO()
        np.savez(out, **fit(pa.Table.from_batches(found) if found else nothing))
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["model"])

    model = rows.repartition(1).mapInArrow(run, "model binary").first()
    if model is None:  # no row, no task
        return fit(nothing)
    with np.load(io.BytesIO(bytes(model["model"]))) as arrays:
        return dict(arrays)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Adam:
    """Steps of Adam over named arrays."""

    def __init__(self, rate: float):
        self.rate, self.n, self.first, self.second = rate, 0, {}, {}

    def step(self, values: dict[str, np.ndarray], slopes: dict[str, np.ndarray]) -> None:
        self.n += 1
        for name, g in slopes.items():
            m = self.first[name] = 0.9 * self.first.get(name, 0) + 0.1 * g
            v = self.second[name] = 0.999 * self.second.get(name, 0) + 0.001 * g * g
            values[name] -= self.rate * (m / (1 - 0.9 ** self.n)) / (np.sqrt(v / (1 - 0.999 ** self.n)) + 1e-8)
