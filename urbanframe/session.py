"""Session helpers: lineage cuts and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder serves a session on one machine; on
    a cluster other machines would not see it, so that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage; survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As ``checkpointed``, as a Parquet table: smaller, and read by column."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """Hint a broadcast only when ``df`` (already materialised, narrow rows) has at
    most ``max_rows`` rows; above that the join shuffles instead."""
    few = df.limit(max_rows + 1).agg(F.count(F.lit(1))).first()[0] <= max_rows
    return F.broadcast(df) if few else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that shall shuffle both sides, whatever size the planner guesses.

    Its guess comes from file sizes and misses what exploding adds to rows (tiles,
    segments, texts), so that a side of hundreds of MB would pass through the driver
    and the other side be joined by as few tasks as it has files.
    """
    return df.hint("merge")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` over as many tasks as shuffles have, its columns computed once.

    Few files make few tasks, and a column of nested expressions would be computed
    anew wherever a step names it.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


#: Rows that a task of a sorted join shall hold, where they are counted.
ROWS = 50_000


def tasks_for(*sides: DataFrame) -> int:
    """As many tasks as shuffles have, or more, so that none has many more than ``ROWS`` rows of all sides.

    The session's number is fixed, so the memory of a task would grow with the tables.
    """
    rows = sum(df.count() for df in sides)
    return max(int(sides[0].sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS))
