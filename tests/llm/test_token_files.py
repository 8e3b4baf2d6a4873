"""Token files: the chunk memory, several files of a partition, bytes that are no UTF-8."""

import glob

import numpy as np
import pytest

from tessera.llm import token_blocks
from tessera.llm.queries import vocabulary


def test_chunk_memory_is_bounded(monkeypatch):
    """Chunks that were forgotten are encoded again, and nothing else changes."""
    monkeypatch.setattr(token_blocks, "KEEP", 40)
    monkeypatch.setattr(token_blocks, "KEEP_WORDS", 5)
    own = token_blocks.ChunkEncoder(vocabulary())
    rng = np.random.default_rng(1)
    for _ in range(30):
        texts = [" ".join(f"Word{k}," if k % 3 else f"wörd{k}\n漢字" for k in rng.integers(0, 200, rng.integers(0, 30))) for _ in range(3)]
        texts.append("")
        got = own.ids([t.encode() for t in texts])
        assert [g.tolist() for g in got] == [own.library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(own.size) <= 40 + 200 and len(own.size) == len(own.chunks) and own.size.sum() == len(own.flat)


@pytest.mark.parametrize("segments", [1, 64])
def test_files_are_cut_by_segments(spark, tmp_path, monkeypatch, segments):
    monkeypatch.setattr(token_blocks, "FILE_SEGMENTS", segments)
    long = "one two three " * 200_000  # more than a segment each
    rows = [(i, long if i < 3 else f"text {i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    path = f"{tmp_path}/ids"
    token_blocks.write_ids(docs, path, vocabulary())
    files = sorted(glob.glob(f"{path}/part-*"))
    assert len(files) >= (3 if segments == 1 else 1)
    whole = b"".join(open(f, "rb").read() for f in files)
    with pytest.raises(UnicodeDecodeError):
        whole.decode("utf-8")  # the text writer left the bytes alone all the same
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in token_blocks.digest(spark, path).collect())
    own = token_blocks.ChunkEncoder(vocabulary())
    sizes = [len(x) + 1 for x in own.ids([t.encode() for _, t in rows])]
    assert got == [(sum(sizes[:i]), i, sizes[i]) for i in range(12)]
