"""Toxicity: a convolutional text classifier in numpy, with thresholds calibrated by language.

Words are embedded by hashes of the whole word, two so that different words
rarely share both rows, and of its first bytes, so that words of one stem share
theirs.  Filters of several widths slide over the whole text and each keeps its
maximum; a linear layer on those maxima gives the score.  The first embedding
dimension starts from how far a word's documents lean to toxic ones in the
training rows, the rest from noise; everything is then trained by backpropagation
through the maxima on a bounded sample of labelled rows (`TRAIN_ROWS` rows and
`labelled.TRAIN_BYTES` bytes of text).

The score reads the text alone.  A threshold for each language is chosen on
rows left out of the training, and used only in the column `flagged`; languages
with too few of those rows keep the threshold 0.5.

Defined results: null and empty texts get the score of a text without words,
whatever stands beside them; texts that repeat score the same; of rows that
repeat an id one is learned from; very long texts are scanned in blocks whose
maxima combine; an empty table gives no rows; without labels of both kinds the
score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.labelled import Adam, sigmoid, training
from llm.sparkkit import bucket5
from llm.textkit import KIND, LOWER, buffers, byte_sums, mix, runs, slices, span_hash

BITS, DIMS, WIDTHS, FILTERS = 17, 8, (1, 2, 3), 8
ROWS = 1 << BITS
#: Bytes of a word's beginnings that are hashed, after the two hashes of the whole word.
STEMS = (5, 7)
TABLES = 2 + len(STEMS)
TRAIN_ROWS, EPOCHS, BATCH = 10_000, 4, 32
#: Words scanned at a time.
BLOCK = 100_000
#: Rows and toxic rows of a language that its own threshold needs.
LEAST_ROWS, LEAST_TOXIC = 40, 8
_PAD = max(WIDTHS) - 1
#: Letters, digits and bytes beyond ASCII make words; all else stands between them.
_WORDS = np.where(KIND == 1, 1, 0).astype(np.uint8)


def word_rows(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """A (TABLES, words) array of embedding rows, each text followed by rows of padding, and the texts' bounds without it.

    A text without words has one row of padding in their place.
    """
    data, offsets = buffers(part.column("text"))
    low = LOWER[data]
    start, end, bounds = runs(low, offsets, _WORDS)
    sums = byte_sums(low)
    hashes = mix(span_hash(sums, start, end))
    n = np.diff(bounds)
    ends = np.cumsum(np.maximum(n, 1) + _PAD)
    first = ends - np.maximum(n, 1) - _PAD
    out = np.full((TABLES, int(ends[-1]) if len(n) else 0), ROWS, np.int32)
    at = np.arange(len(hashes)) + np.repeat(first - bounds[:-1], n)
    out[0, at] = hashes & np.uint64(ROWS - 1)
    out[1, at] = (hashes >> np.uint64(32)) & np.uint64(ROWS - 1)
    for k, size in enumerate(STEMS):
        out[2 + k, at] = mix(span_hash(sums, start, np.minimum(start + size, end)), size) & np.uint64(ROWS - 1)
    return out, np.stack([first, first + np.maximum(n, 1)])


def embed(model: dict, rows: np.ndarray) -> np.ndarray:
    out = model["e"][0][rows[0]]
    for table, own in zip(model["e"][1:], rows[1:], strict=True):
        out += table[own]
    return out


def filtered(model: dict, e: np.ndarray) -> np.ndarray:
    """What each filter says at each place but the last _PAD: (places, all filters)."""
    n = len(e) - _PAD
    parts = []
    for w, b in zip(model["w"], model["b"], strict=True):
        z = np.broadcast_to(b, (n, FILTERS)).copy()
        for j in range(len(w)):
            z += e[j : j + n] @ w[j]
        parts.append(z)
    return np.hstack(parts)


def pooled(model: dict, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The rectified maximum of each filter over each text."""
    out = np.zeros((bounds.shape[1], len(WIDTHS) * FILTERS), np.float32)
    first, last = bounds
    total = rows.shape[1]
    for at in range(0, max(total - _PAD, 0), BLOCK):
        end = min(at + BLOCK, total - _PAD)
        z = filtered(model, embed(model, rows[:, at : end + _PAD]))
        a, b = np.searchsorted(last, at, side="right"), np.searchsorted(first, end)
        lows, highs = np.maximum(first[a:b], at) - at, np.minimum(last[a:b], end) - at
        cuts = np.stack([lows, highs], axis=1).ravel()
        if len(cuts):
            cuts = cuts[:-1] if cuts[-1] == len(z) else cuts
            out[a:b] = np.maximum(out[a:b], np.maximum.reduceat(z, cuts, axis=0)[::2])
    return out


def probability(model: dict, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    if "bias" in model:
        return np.full(bounds.shape[1], model["bias"])
    return sigmoid((pooled(model, rows, bounds) @ model["v"] + model["c"][0]).astype(float))


def leaning(texts: list[np.ndarray], y: np.ndarray) -> list[np.ndarray]:
    """For each hash, how far the documents with a row lean to the toxic ones, between -1 and 1."""
    out = []
    for k in range(TABLES):
        seen, toxic = np.zeros(ROWS + 1), np.zeros(ROWS + 1)
        for rows, label in zip(texts, y, strict=True):
            own = np.unique(rows[k])
            seen[own] += 1
            if label:
                toxic[own] += 1
        expected = seen * y.mean()
        out.append(np.tanh((toxic - expected) / np.sqrt(expected + 1) / 5))
    return out


def train(texts: list[np.ndarray], y: np.ndarray, seed: int = 11) -> dict:
    """The model, from (TABLES, words) rows of each text, padding included, and labels."""
    if not len(y) or y.min() == y.max():
        return {"bias": float(y.mean()) if len(y) else 0.0}
    rng = np.random.default_rng(seed)
    e = [rng.normal(0, 0.02, (ROWS + 1, DIMS)).astype(np.float32) for _ in range(TABLES)]
    for k, (table, lean) in enumerate(zip(e, leaning(texts, y), strict=True)):
        table[:, max(k - 1, 0)] = lean / (2 if k < 2 else 1)  # whole words, and each kind of stem, in a dimension of their own
        table[ROWS] = 0
    w = [rng.normal(0, 0.3, (k, DIMS, FILTERS)).astype(np.float32) for k in WIDTHS]
    b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    for k in range(len(WIDTHS)):
        w[k][:, : TABLES - 1, : FILTERS // 2] = np.abs(w[k][:, : TABLES - 1, : FILTERS // 2]) + 0.5  # these look for what leans to toxic
    v, c = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32), np.full(1, -1.0, np.float32)
    model = {"e": e, "w": w, "b": b, "v": v, "c": c}
    adam = Adam([*w, *b, v, c], 0.02)
    for _ in range(EPOCHS if len(y) > 1500 else 4 * EPOCHS):
        order = rng.permutation(len(y))
        for i in (order[k : k + BATCH] for k in range(0, len(y), BATCH)):
            rows = np.hstack([texts[j] for j in i])
            ends = np.cumsum([texts[j].shape[1] for j in i])
            starts = ends - [texts[j].shape[1] for j in i]
            vectors = embed(model, rows)
            z = filtered(model, vectors)
            place = np.array([s + np.argmax(z[s : max(t - _PAD, s + 1)], axis=0) for s, t in zip(starts, ends, strict=True)])
            top = np.maximum(np.take_along_axis(z, place, axis=0), 0)
            d = ((sigmoid(top @ v + c[0]) - y[i]) / len(i)).astype(np.float32)
            dz = np.outer(d, v) * (top > 0)
            grads_w, grads_b, moves = [], [], []
            for k in range(len(WIDTHS)):
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                g, p = dz[:, own], place[:, own]
                grads_w.append(np.stack([np.einsum("bf,bfd->df", g, vectors[p + j]) for j in range(len(w[k]))]))
                grads_b.append(g.sum(axis=0))
                moves += [(p + j, g[..., None] * w[k][j].T[None]) for j in range(len(w[k]))]
            grad_v = top.T @ d
            for p, g in moves:
                for k in range(TABLES):
                    np.subtract.at(e[k], rows[k][p], g.astype(np.float32))
                    e[k][ROWS] = 0
            adam.step([*grads_w, *grads_b, grad_v, np.array([d.sum()], np.float32)])
    return model


def language_thresholds(p: np.ndarray, y: np.ndarray, lang: np.ndarray) -> dict[str, float]:
    """For each language with enough rows, the threshold of the best F1, the nearest to 0.5 if tied."""
    out, grid = {}, np.arange(5, 96) / 100
    for one in sorted({x for x in lang if x is not None}):
        own = lang == one
        if own.sum() >= LEAST_ROWS and y[own].sum() >= LEAST_TOXIC:
            hit = p[own][None] >= grid[:, None]
            f1 = 2 * (hit & (y[own] == 1)).sum(axis=1) / (hit.sum(axis=1) + y[own].sum())
            out[one] = float(grid[max(range(len(grid)), key=lambda k: (f1[k], -abs(grid[k] - 0.5)))])
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> tuple[dict, dict[str, float]]:
    """The model and the thresholds by language, from a bounded sample of labelled documents."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                at, (first, last) = word_rows(part)
                x = [np.ascontiguousarray(at[:, s : t + _PAD]).tobytes() for s, t in zip(first, last, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("y"), part.column("lang"), pa.array(x, pa.binary())], ["y", "lang", "x"])

    picked = training(docs, labels, label, rows, lang=F.col("lang").cast("string"))
    got = picked.select("y", "lang", "text").mapInArrow(hashed, "y int, lang string, x binary").toPandas()
    got = got.sort_values(["x", "y"], ignore_index=True)  # the same order whatever the partitions were
    texts = [np.frombuffer(x, np.int32).reshape(TABLES, -1) for x in got["x"]]
    y, lang = got["y"].to_numpy(int), got["lang"].to_numpy(object)
    held = np.random.default_rng(2).random(len(y)) < 0.2
    model = train([x for x, h in zip(texts, held, strict=True) if not h], y[~held])
    if "bias" in model or not held.any():
        return model, {}
    p = np.concatenate([probability(model, x, np.array([[0], [max(x.shape[1] - _PAD, 1)]])) for x, h in zip(texts, held, strict=True) if h])
    return model, language_thresholds(p, y[held], lang[held])


def scored(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang"), label: str = "toxic") -> DataFrame:
    """`keep`, the score of each whole text, its language's threshold, and `flagged`; lang is in `keep`."""
    model, thresholds = fit(docs, labels, label)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                p = probability(shared.value, *word_rows(part))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(p, pa.float64())], [*keep, "score"])

    need = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in need.schema if f.name in keep)
    threshold = F.lit(0.5)
    for lang, t in thresholds.items():
        threshold = F.when(F.col("lang") == lang, F.lit(t)).otherwise(threshold)
    out = need.mapInArrow(score, f"{schema}, score double").withColumn("lang_threshold", threshold)
    return out.withColumn("flagged", F.col("score") >= F.col("lang_threshold"))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    d = scored(docs, labels)
    return d.select("doc_id", (bucket5(F.col("doc_id")) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "lang_threshold", "flagged")
