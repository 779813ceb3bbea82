"""Embedding as a connector: rows' texts go to a model in batches inside tasks; counts and dimensions are checked."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Model = Callable[[list[str]], np.ndarray]


class HashModel:
    """A deterministic stand-in without weights: signed hashes of words, unit length. Equal texts get equal vectors."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for row, t in zip(out, texts):
            for w in t.split() or [""]:
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                row[h % self.dim] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        out[norm[:, 0] == 0, 0] = 1
        return (out / np.where(norm == 0, 1, norm)).astype(np.float32)


def embed(rows: DataFrame, make_model: Callable[[], Model], dim: int, batch: int = 128, text_col: str = "search_text", vector_col: str = "vector", attempts: int = 3) -> DataFrame:
    """rows with a vector of each text. make_model runs once a task; a batch is tried again before the task fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        for b in batches:
            texts, parts = [t or "" for t in b.column(text_col).to_pylist()], []
            for k in range(0, len(texts), batch):
                part = texts[k : k + batch]
                for left in range(attempts - 1, -1, -1):
                    try:
                        v = np.asarray(model(part), np.float32)
                        if v.shape != (len(part), dim):
                            raise ValueError(f"{v.shape} for {(len(part), dim)}")
                        break
                    except (OSError, ValueError):
                        if not left:
                            raise
                parts.append(v)
            flat = np.concatenate(parts).ravel() if parts else np.empty(0, np.float32)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, dim), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*b.columns, vectors], [*b.schema.names, vector_col])

    return rows.mapInArrow(run, rows.withColumn(vector_col, F.array().cast("array<float>")).schema)


def embed_missing(rows: DataFrame, make_model: Callable[[], Model], dim: int, **more) -> DataFrame:
    """rows (with `cached` vectors from the store's cache) with all vectors: only texts without one visit the model."""
    made = embed(rows.where("cached is null"), make_model, dim, **more)
    return rows.where("cached is not null").withColumn("vector", F.col("cached")).unionByName(made).drop("cached")
