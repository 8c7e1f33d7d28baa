"""Bounded samples of labelled documents, and small numpy training helpers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.sparkkit import bucket5, stored

#: Bytes of text of a training sample; rows beyond are left out, in the order of their ids' hashes.
TRAIN_BYTES = 48 << 20


def sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, y) of at most `rows` labelled rows outside the held-out fold.

    Rows are taken by the least hash of their id, so the choice is the same at
    each run.  Rows without id or label are left out; of those that repeat an
    id the largest label counts.
    """
    ok = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(bucket5(F.col("doc_id")) != 0)
    one = ok.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def training(docs: DataFrame, labels: DataFrame, label: str, rows: int, most: int = TRAIN_BYTES, **more: Column) -> DataFrame:
    """(doc_id, y, text, `more`) of a sample of at most `rows` labelled documents and `most` bytes of text.

    Of rows that repeat an id the one with the least text is taken.
    """
    picked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *(c.alias(k) for k, c in more.items())).join(F.broadcast(sample(labels, label, rows)), "doc_id")
    picked = picked.groupBy("doc_id", "y").agg(F.min(F.struct("text", *more)).alias("one")).select("doc_id", "y", "one.*")
    picked = stored(picked, "training")
    sizes = picked.select("doc_id", F.octet_length("text").alias("size"))  # a row for each of the sample's documents
    so_far = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    return picked.join(F.broadcast(sizes.select("doc_id", so_far.alias("so_far")).where(F.col("so_far") <= most).select("doc_id")), "doc_id")


class Adam:
    def __init__(self, parts: list[np.ndarray], rate: float):
        self.parts, self.rate, self.t = parts, rate, 0
        self.m = [np.zeros_like(p) for p in parts]
        self.v = [np.zeros_like(p) for p in parts]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.parts, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on rows that the network wasn't trained on (1 if there are too few)."""
    if len(y) < 20 or y.min() == y.max():
        return 1.0
    grid = np.geomspace(0.25, 8, 61)
    loss = [-np.mean(np.log(np.where(y == 1, p := sigmoid(logits / t), 1 - p) + 1e-12)) for t in grid]
    return float(grid[int(np.argmin(loss))])
