"""Small Spark helpers of this subpackage: shared tables and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
_own_dir: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the cluster shares.

    The folder is the session's `spark.checkpoint.dir`; only where that is
    unset and all tasks run on this machine, as in tests, a temporary folder
    stands in.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        if not _own_dir:
            _own_dir.append("file://" + tempfile.mkdtemp(prefix="llm-shared-"))
        root = _own_dir[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df once to the shared folder and returns it read back.

    Unlike a cache the table survives the loss of executors, and unlike a
    checkpoint it is computed a single time.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A side of a join is broadcast up to this many bytes, and shuffled beyond.
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, rows: int, width: int = 64) -> DataFrame:
    """df with a broadcast hint if its counted rows, of about `width` bytes each, are few; else as it is.

    Where a column is an array, rows is the number of its elements besides.
    """
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bucket5(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 marks the held-out fold (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


#: Maximal runs of characters other than space and \\t \\n \\v \\f \\r.
WORD = r"[^\x20\x09-\x0D]+"
NOT_SPACE = r"[\x20\x09-\x0D]+"
