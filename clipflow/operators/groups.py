"""What hangs together through links, by joins alone."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


_own_dir: list[str] = []


def durable(df: DataFrame) -> DataFrame:
    """df written once to the cluster's checkpoint folder and read back; a folder of this machine stands in only where all tasks run on it.

    Unlike a checkpoint the table is computed a single time, and the planner
    carries nothing of how it was made into the next round of an iteration.
    """
    spark = df.sparkSession
    root, master = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not root:
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own_dir:
            _own_dir.append("file://" + tempfile.mkdtemp(prefix="clipflow-"))
        root = _own_dir[0]
    path = f"{root.rstrip('/')}/clipflow-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def linked_groups(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the links (a, b); root is the least node that is reached.

    In each round a node takes the least root of its neighbours and then the
    root of its root, so that ways halve; rounds end when no root changes.
    """
    both = durable(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    roots = both.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    while True:
        near = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("_near"))
        lower = roots.join(near, "node").select("node", F.least("root", "_near").alias("_lower"), F.col("root").alias("_was"))
        above = lower.select(F.col("node").alias("_lower"), F.col("_lower").alias("_above"))
        moved = durable(lower.join(above, "_lower").select("node", F.least("_lower", "_above").alias("root"), (F.least("_lower", "_above") != F.col("_was")).alias("_moved")))
        roots = moved.select("node", "root")
        if moved.where("_moved").isEmpty():
            return roots


def leaders(nodes: DataFrame, covers: DataFrame) -> DataFrame:
    """(id, leader): nodes (id, place), taken in the order of their places, where each that no leader before it covers leads, and others follow the first leader that covers them.

    covers (a, b): a covers b; pairs of which a doesn't come before b count for
    nothing.  A round makes leaders of the nodes that nothing undecided covers
    from before, and takes out whom they cover: the same leaders as one by one.
    """
    at = lambda k: nodes.select(F.col("id").alias(k), F.col("place").alias(f"_{k}"))
    before = durable(covers.join(at("a"), "a").join(at("b"), "b").where("_a < _b").select("a", "b", "_a").distinct())
    left, edges, found = durable(nodes.select("id")), before.select("a", "b"), []
    while not left.isEmpty():
        first = durable(left.join(edges.select(F.col("b").alias("id")), "id", "left_anti"))
        found.append(first)
        out = edges.join(first.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).union(first).distinct()
        left = durable(left.join(out, "id", "left_anti"))
        edges = durable(edges.join(left.withColumnRenamed("id", "a"), "a", "left_semi").join(left.withColumnRenamed("id", "b"), "b", "left_semi"))
    lead = nodes.select("id").where("false")
    for part in found:
        lead = lead.union(part)
    covered = before.join(lead.withColumnRenamed("id", "a"), "a", "left_semi").join(lead.withColumnRenamed("id", "b"), "b", "left_anti")
    follow = covered.groupBy(F.col("b").alias("id")).agg(F.min_by("a", "_a").alias("leader"))
    return lead.select("id", F.col("id").alias("leader")).union(follow)


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by the keys, none of them null, in one table for each key."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        new = np.zeros(len(batch), bool)
        for k in keys:
            v = batch[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(new), len(batch)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            part = batch.iloc[i:j]
            if len(part) and held and any(held[-1][k].iloc[-1] != part[k].iloc[0] for k in keys):
                yield pd.concat(held, ignore_index=True)
                held = []
            if len(part):
                held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True)
