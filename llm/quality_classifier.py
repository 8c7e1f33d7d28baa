"""Quality classifier: random-indexing word vectors, pooled, and a two-layer numpy network.

Random indexing gives each word a fixed sparse random index vector; a word's
context vector is the sum of the index vectors of its neighbours in all
documents.  Words are hashed into a fixed number of rows, so each task adds up
one small table of whole numbers, tables are summed in a tree of bounded
groups, and the sum, whose size the parameters fix, is what is broadcast.

A document is the mean over its words of their context vectors and index
vectors, with the lengths of both means and how often neighbours have the same
index vector, which tell texts that say few words again and again.  The network is trained on the driver from a bounded sample of
labelled rows (`TRAIN_ROWS` rows and `labelled.TRAIN_BYTES` bytes of text), its probabilities are calibrated by a temperature
fitted on rows left out of that training.  Rows of the held-out fold are never
learned from; only the text is an input of a score.

Defined results: null and empty texts get the score of a text without words;
texts that repeat score the same; of rows that repeat an id one is learned from;
an empty table gives no rows; without labels
of both kinds the score is the share of good labels (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.labelled import Adam, sigmoid, temperature, training
from llm.sparkkit import bucket5, unused
from llm.textkit import buffers, runs, slices, word_hashes

#: Rows of the word table, dimensions of its vectors, and neighbours on either side.
ROWS, DIMS, REACH = 1 << 14, 32, 2
TRAIN_ROWS = 20_000
HIDDEN, EPOCHS, BATCH = 32, 40, 256
THRESHOLD = 0.3
#: Tables that one step of the tree adds up, and parts that a table is cut into.
FAN_IN, PARTS = 64, 16


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """The dimension that holds +1 and the one that holds -1, for each row."""
    rng = np.random.default_rng(5)
    plus = rng.integers(0, DIMS, ROWS)
    return plus, (plus + rng.integers(1, DIMS, ROWS)) % DIMS


def word_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The table rows of all words of the batch's texts, and the bounds of each text."""
    data, offsets = buffers(batch.column("text"))
    start, end, bounds = runs(data, offsets)
    return (word_hashes(data, start, end) & np.uint64(ROWS - 1)).astype(np.int64), bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    plus, minus = index_vectors()
    table = np.zeros(ROWS * (DIMS + 1), np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            at, bounds = word_rows(part)
            text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            for step in range(1, REACH + 1):
                same = text[step:] == text[:-step]
                a, b = at[:-step][same], at[step:][same]
                for x, y in ((a, b), (b, a)):
                    base = x * (DIMS + 1)
                    table += np.bincount(base + plus[y], minlength=len(table))
                    table -= np.bincount(base + minus[y], minlength=len(table))
            table[DIMS :: DIMS + 1] += np.bincount(at, minlength=ROWS)
    for k, piece in enumerate(np.split(table, PARTS)):
        if piece.any():
            yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "sums": pa.array([piece.tobytes()], pa.binary())})


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.int64) for x in pdf["sums"])
    return pd.DataFrame({"part": pdf["part"].iloc[:1], "task": pdf["task"].iloc[:1] // FAN_IN, "sums": [total.tobytes()]})


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table (ROWS, 2 * DIMS): scaled context vectors beside index vectors, from all documents."""
    texts = docs.select("text")
    tables = texts.mapInArrow(_count, "part int, sums binary").withColumn("task", F.spark_partition_id())
    tasks = texts.rdd.getNumPartitions()
    while True:
        group = F.floor(F.col("task") / FAN_IN).cast("int").alias("_group")
        tables = tables.groupBy("part", group).applyInPandas(_add, "part int, task int, sums binary")
        tasks = -(-tasks // FAN_IN)
        if tasks <= 1:
            break
    out = np.zeros((PARTS, ROWS // PARTS * (DIMS + 1)), np.float64)
    for row in tables.collect():  # PARTS rows, whose size the parameters fix
        out[row["part"]] += np.frombuffer(row["sums"], np.int64)
    out = out.reshape(ROWS, DIMS + 1)
    context = out[:, :DIMS] / np.sqrt(np.maximum(out[:, DIMS:], 1))
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    plus, minus = index_vectors()
    own = np.zeros((ROWS, DIMS))
    own[np.arange(ROWS), plus] += 1
    own[np.arange(ROWS), minus] -= 1
    return np.hstack([context, own]).astype(np.float32)


def pooled(batch: pa.RecordBatch, table: np.ndarray) -> np.ndarray:
    """A row for each text: the mean vector of its words, and the figures beside it."""
    at, bounds = word_rows(batch)
    n = np.diff(bounds)
    width = table.shape[1]
    out = np.zeros((len(n), width + 4), np.float32)
    some = np.flatnonzero(n)
    if len(some):
        for d in range(width):
            out[some, d] = np.add.reduceat(np.take(table[:, d], at), bounds[:-1][some]) / n[some]
        same = np.append(at[1:] == at[:-1], False)
        same[bounds[1:][some] - 1] = False
        out[some, width] = np.add.reduceat(same, bounds[:-1][some], dtype=np.int64) / n[some]
        out[:, width + 1] = np.linalg.norm(out[:, : width // 2], axis=1)
        out[:, width + 2] = np.linalg.norm(out[:, width // 2 : width], axis=1)
    out[:, -1] = np.log1p(n) / 10
    return out


def train(x: np.ndarray, y: np.ndarray, seed: int = 3) -> dict:
    """The network's weights, its inputs' scale, and the temperature."""
    if not len(y) or y.min() == y.max():
        return {"bias": float(y.mean()) if len(y) else 0.5}
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-4
    order = rng.permutation(len(y))
    held, used = order[: len(y) // 7], order[len(y) // 7 :]
    z = (x - mean) / scale
    parts = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    adam = Adam(parts, 0.005)
    for _ in range(EPOCHS if len(used) > 2000 else 3 * EPOCHS):
        for k in range(0, len(used), BATCH):
            i = (used := rng.permutation(used))[:BATCH] if k == 0 else used[k : k + BATCH]
            h = np.tanh(z[i] @ parts[0] + parts[1])
            d = (sigmoid(h @ parts[2] + parts[3]) - y[i]) / len(i)
            dh = np.outer(d, parts[2]) * (1 - h * h)
            adam.step([z[i].T @ dh + 1e-4 * parts[0], dh.sum(axis=0), h.T @ d + 1e-4 * parts[2], np.array([d.sum()])])
    logits = np.tanh(z[held] @ parts[0] + parts[1]) @ parts[2] + parts[3]
    return {"mean": mean, "scale": scale, "parts": parts, "temperature": temperature(logits, y[held])}


def probability(model: dict, x: np.ndarray) -> np.ndarray:
    if "bias" in model:
        return np.full(len(x), model["bias"])
    w1, b1, w2, b2 = model["parts"]
    return sigmoid((np.tanh((x - model["mean"]) / model["scale"] @ w1 + b1) @ w2 + b2) / model["temperature"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, dict]:
    """Word vectors from all documents, and the network from the sample of labelled ones."""
    table = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = pooled(part, shared.value)
                yield pa.RecordBatch.from_arrays([part.column("y"), pa.array([r.tobytes() for r in x], pa.binary())], ["y", "x"])

    picked = training(docs, labels, label, rows)
    got = picked.select("y", "text").mapInArrow(features, "y int, x binary").toPandas()
    got = got.sort_values(["x", "y"], ignore_index=True)  # the same order whatever the partitions were
    x = np.array([np.frombuffer(r, np.float32) for r in got["x"]], np.float64).reshape(len(got), table.shape[1] + 4)
    return table, train(x, got["y"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), label: str = "quality", name: str = "score") -> DataFrame:
    """`keep` and the calibrated probability `name` of each document, text passing through if kept."""
    table, model = fit(docs, labels, label)
    shared = docs.sparkSession.sparkContext.broadcast((table, model))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                p = probability(model, pooled(part, table))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(p, pa.float64())], [*keep, name])

    need = [*dict.fromkeys([*keep, "text"])]
    kept = docs.select(*need)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in keep)
    return kept.mapInArrow(score, f"{schema}, `{name}` double")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that score `threshold` or more."""
    name = unused(docs, "score")
    return scored(docs, labels, tuple(docs.columns), name=name).where(F.col(name) >= threshold).select(*docs.columns)


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    d = scored(docs, labels)
    return d.select("doc_id", (bucket5(F.col("doc_id")) == 0).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
