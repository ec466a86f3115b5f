"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanframe.session import checkpointed

#: Links up to which one task joins them all, as their number is checked.
ONE_TASK = 200_000
#: Links that a task joins on its own before the distributed rounds, and links in a written part.
BLOCK = 200_000


def _forests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links from every node to the smallest node it reaches within a block of links."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above[x]) != x:
            above[x] = x = above[y]
        return x

    def stars() -> pd.DataFrame:
        out = pd.DataFrame([(x, top(x)) for x in above], columns=["u", "v"])
        above.clear()
        return out.astype("int64")

    held = 0
    for frame in frames:
        for u, v in zip(frame["u"].tolist(), frame["v"].tolist()):
            above.setdefault(u, u)
            above.setdefault(v, v)
            a, b = top(u), top(v)
            if a != b:
                above[max(a, b)] = min(a, b)
        held += len(frame)
        if held >= BLOCK:
            yield stars()
            held = 0
    if above:
        yield stars()


def components_by_place(edges: DataFrame, place: list[str], a: str = "a", b: str = "b", one_task: int = ONE_TASK) -> DataFrame:
    """As ``components``, for links between neighbours: the columns ``place`` name the block that a link lies in.

    A block's links are joined by one task, in blocks of any choice. What is left
    are the blocks' smallest nodes, linked where a node has several of them: few,
    as only nodes on a border have. Every node then takes over the component of
    its smallest one. So neither the number of rounds nor their size grows with
    the links, but with the borders.
    """
    ends = (F.col(a).cast("bigint"), F.col(b).cast("bigint"))
    links = edges.select(F.greatest(*ends).alias("u"), F.least(*ends).alias("v"), *place).where(ends[0].isNotNull() & ends[1].isNotNull() & (ends[0] != ends[1]))
    local = links.repartition(*place).sortWithinPartitions(*place).select("u", "v").mapInPandas(_forests, "u long, v long")
    known = checkpointed(local.groupBy("u").agg(F.min("v").alias("m"), F.collect_set("v").alias("_all")))
    border = known.select(F.explode("_all").alias("u"), F.col("m").alias("v")).where("u <> v")
    label = components(border, "u", "v", one_task).select(F.col("node").alias("m"), "component")
    return known.join(label, "m", "left").select(F.col("u").alias("node"), F.coalesce("component", "m").alias("component"))


def components(edges: DataFrame, a: str = "a", b: str = "b", one_task: int = ONE_TASK) -> DataFrame:
    """``node, component`` for every node (long) of ``edges``; the component is its smallest node.

    Every task first joins its own links, which leaves a star per group. Where
    there were no more than ``one_task`` links in all, one task does and that is
    the result. Else two local steps alternate until nothing changes: every node
    hooks its larger neighbours to the smallest node it knows (large star), then
    hooks itself and its smaller neighbours to that node (small star). Both are
    a grouped minimum, which combines before the shuffle, and a join back; the
    number of rounds grows with the logarithm of the longest path. Null ends
    and loops are dropped; an edge table without rows gives no rows.
    """
    ends = (F.col(a).cast("bigint"), F.col(b).cast("bigint"))
    links = checkpointed(edges.select(F.greatest(*ends).alias("u"), F.least(*ends).alias("v")).where(ends[0].isNotNull() & ends[1].isNotNull() & (ends[0] != ends[1])))
    n = links.count()
    if n <= one_task:
        return checkpointed(links.coalesce(1).mapInPandas(_forests, "u long, v long").select(F.col("u").alias("node"), F.col("v").alias("component")))
    links = checkpointed(links.mapInPandas(_forests, "u long, v long").where("u <> v").distinct())
    parts = max(1, -(-n // BLOCK))
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where("u <> v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = checkpointed(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().coalesce(parts))
        # The sum of a hash of all links is the same only when no link changed.
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("v").alias("node")).distinct()
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(roots.join(found, "node", "left_anti").withColumn("component", F.col("node")))
