"""Merkle manifest of a table with proofs for every row.

Rows are leaves; the leaves of a group (by default of a language) ascend by
``doc_id`` and form a binary tree in which the last node of an odd level is
hashed alone; the groups' roots, in byte order of the group, form one more tree.

Positions come from a range sort that is written once, and counts per sorted
part. A tree is built in rounds: tasks fold runs of ``2 ** RUN`` nodes to one,
so a round leaves a 4096th of the nodes and no task holds more than one run.

Proofs are octopus multiproofs. A leaf partition is a run of leaves; it works
out which node coordinates (level, index) the proofs of all its leaves need and
its leaves don't determine, the minimal union; these are fetched once, in one
join with the written nodes. The shared interiors are then derived and the
single proofs expanded where the leaves are. ``multiproof`` does this for any
set of positions, so a proof of few rows fetches few nodes.

Defined results: null values read as ``-``; null ids come first in their group,
rows with one id ascend by leaf, so repeated rows are different leaves of equal
value; a null group comes first; a table of one row has its leaf as root and an
empty proof; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.llm.common import broadcast_if_small, documents, id_fold, small_batches, written
from urbanframe.llm.sharding import crc_sql

#: Levels that a task folds at a time: runs of 4,096 nodes.
RUN = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "grp long, level int, idx long, hash binary"


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    """Lowercase hex sha256 of the encoded values."""
    return F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256)


def joined_hash(*hexes: str) -> str:
    return sha256("".join(hexes).encode()).hexdigest()


def width(n: int, level: int) -> int:
    """Nodes at ``level`` of a tree of ``n`` leaves."""
    return -(-n >> level) if level else n


def height(n: int) -> int:
    """Levels above the leaves."""
    return max(0, int(n) - 1).bit_length()


def missing_coordinates(positions: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Minimal union of the nodes (level, index) that prove ``positions`` in a tree of ``n`` leaves.

    A sibling is missing if it exists and none of the positions stands below it.
    """
    out, known = [], np.unique(positions)
    for level in range(height(n)):
        beside = known ^ 1
        absent = beside[(beside < width(n, level)) & ~np.isin(beside, known, assume_unique=True)]
        out += [(level, i) for i in absent.tolist()]
        known = np.unique(known >> 1)
    return out


def derived(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> list[dict[int, str]]:
    """All nodes that leaves and fetched nodes determine on the leaves' paths, by level; the last is the root."""
    levels = [dict(leaves)]
    for level in range(height(n)):
        own, above = levels[-1], {}
        last = width(n, level) - 1
        for i in list(own):
            own.setdefault(i ^ 1, fetched[level, i ^ 1]) if (i ^ 1) <= last and (i ^ 1) not in own else None
        for i in {i >> 1 for i in own}:
            left = own[2 * i]
            above[i] = joined_hash(left, own[2 * i + 1]) if 2 * i + 1 <= last else joined_hash(left)
        levels.append(above)
    return levels


def expanded(position: int, levels: list[dict[int, str]]) -> list[tuple[str, bool]]:
    """The proof of one leaf: siblings from the bottom up, and whether each stands to the left."""
    out = []
    for own in levels[:-1]:
        beside = position ^ 1
        out.append((own[beside], beside < position) if beside in own else ("", False))
        position >>= 1
    return out


def folded(leaf: str, proof: list[tuple[str, bool]]) -> str:
    """The root that a leaf and its proof lead to; an empty sibling is a node hashed alone."""
    for beside, left in proof:
        leaf = joined_hash(beside, leaf) if left else joined_hash(leaf, beside)
    return leaf


def positioned(rows: DataFrame, group: str | None, order: list[str | Column]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their ``position`` in the group, and the groups' counts (``group, n``).

    Rows are range-sorted over all tasks by group and ``order``, so a large
    group is spread; counts of (part, group) give each part's start.
    """
    keys = [F.col(group).asc_nulls_first()] if group else []
    sorted_rows = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    sorted_rows = written(sorted_rows.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    by = [group] if group else []
    parts = sorted_rows.groupBy("_part", *by).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_least"))
    parts = written(parts.withColumn("_start", F.coalesce(F.sum("_n").over(W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) - F.col("_least")))
    sums = parts.groupBy(*by).agg(F.sum("_n").alias("n"))
    named = parts.select(F.col("_part").alias("_p"), "_start", *[F.col(c).alias("_g") for c in by])
    same = F.col("_part") == F.col("_p")
    if group:
        same &= F.col(group).eqNullSafe(F.col("_g"))
    found = sorted_rows.join(broadcast_if_small(named), same).withColumn("position", F.col("_at") + F.col("_start"))
    return found.select(*rows.columns, "position"), sums


def _fold_run(frame: pd.DataFrame, levels: int, base: int, run: int) -> Iterator[tuple[int, int, bytes]]:
    """Nodes above a run of consecutive nodes, level by level: ``level, index, hash``."""
    frame = frame.sort_values("idx")
    start, nodes = int(frame["idx"].iloc[0]), [bytes(h).hex() for h in frame["hash"]]
    for level in range(base + 1, min(base + run, levels) + 1):
        nodes = [joined_hash(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        start >>= 1
        yield from ((level, start + i, bytes.fromhex(h)) for i, h in enumerate(nodes))


def build(leaves: DataFrame, run: int = RUN, keep_all: bool = False) -> DataFrame:
    """Nodes of all trees from ``grp, position, n, hash``: ``grp, level, idx, hash``.

    Levels below ``run`` are left out unless ``keep_all``, as every leaf
    partition derives them itself; the top node of a tree is always kept.
    """

    def fold(base: int, all_levels: bool):
        def of(frame: pd.DataFrame) -> pd.DataFrame:
            n = int(frame["n"].iloc[0])
            top = height(n)
            rows = [(int(frame["grp"].iloc[0]), *x) for x in _fold_run(frame, top, base, run) if all_levels or x[0] in (base + run, top)]
            if base == 0 and (top == 0 or all_levels):
                rows += [(int(frame["grp"].iloc[0]), 0, int(i), bytes(h)) for i, h in zip(frame["idx"], frame["hash"])]
            return pd.DataFrame(rows, columns=["grp", "level", "idx", "hash"])

        return of

    def above(nodes: DataFrame, base: int, all_levels: bool) -> DataFrame:
        return written(nodes.groupBy("grp", F.shiftright("idx", run).alias("_run")).applyInPandas(fold(base, all_levels), NODE))

    counts = leaves.groupBy("grp").agg(F.max("n").alias("n"))
    most = leaves.agg(F.max("n")).first()[0] or 0
    base, out = 0, above(leaves.select("grp", F.col("position").alias("idx"), "hash", "n"), 0, keep_all)
    while height(most) > base + run:
        base += run
        # Trees that have more levels than these go on.
        nodes = out.where(F.col("level") == base).join(broadcast_if_small(counts), "grp").where(F.col("n") > (1 << base))
        out = out.unionByName(above(nodes.select("grp", "idx", "hash", "n"), base, True))
    return out


PROOF = "grp long, position long, proof array<struct<hash: string, left: boolean>>, top string"


def _wanted(partitions: DataFrame) -> DataFrame:
    """``grp, chunk, level, idx``: what each leaf partition has to fetch."""

    def of(frame: pd.DataFrame) -> pd.DataFrame:
        asked = missing_coordinates(frame["position"].to_numpy(), int(frame["n"].iloc[0]))
        out = pd.DataFrame(asked, columns=["level", "idx"])
        return out.assign(grp=frame["grp"].iloc[0], chunk=frame["chunk"].iloc[0])[["grp", "chunk", "level", "idx"]]

    return partitions.groupBy("grp", "chunk").applyInPandas(of, "grp long, chunk long, level int, idx long")


def multiproof(leaves: DataFrame, nodes: DataFrame, expand, schema: str, run: int = RUN) -> DataFrame:
    """Proofs of ``leaves`` (``grp, position, n, hash`` and more), made a leaf partition at a time.

    ``expand(frame, levels)`` turns a partition's rows and its derived nodes
    into rows of ``schema``. ``leaves`` may be any rows of the trees; ``nodes``
    must hold what their partitions don't determine.
    """
    dealt = leaves.withColumn("chunk", F.shiftright("position", run))
    fetched = _wanted(dealt.select("grp", "chunk", "position", "n")).join(nodes, ["grp", "level", "idx"]).select("grp", "chunk", "level", "idx", "hash")

    def of(own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        held = {(int(a), int(b)): bytes(h).hex() for a, b, h in zip(got["level"], got["idx"], got["hash"])}
        first = {int(p): bytes(h).hex() for p, h in zip(own["position"], own["hash"])}
        return expand(own, derived(first, held, int(own["n"].iloc[0])))

    return dealt.groupBy("grp", "chunk").cogroup(fetched.groupBy("grp", "chunk")).applyInPandas(of, schema)


def _proofs(frame: pd.DataFrame, levels: list[dict[int, str]]) -> pd.DataFrame:
    proofs = [[{"hash": h, "left": left} for h, left in expanded(int(p), levels)] for p in frame["position"]]
    return pd.DataFrame({"grp": frame["grp"], "position": frame["position"], "proof": proofs, "top": levels[-1][0]})


class Manifest:
    """Tree over a table: positioned leaves, nodes of the groups' trees, the groups with their roots' proofs.

    ``more`` names further columns of ``rows`` to carry with the leaves.
    """

    def __init__(self, rows: DataFrame, group: str = "lang", id_: str = "doc_id", run: int = RUN, keep_all: bool = False):
        small_batches(rows.sparkSession)
        self.run, self.id = run, id_
        placed, sums = positioned(written(rows), group, [F.col(id_).asc_nulls_first(), F.col("hash")])
        numbered, _ = positioned(sums.withColumnRenamed(group, "_value"), None, [F.col("_value").asc_nulls_first()])
        groups = written(numbered.select(F.col("_value"), F.col("n"), F.col("position").alias("grp")))
        same = F.col(group).eqNullSafe(F.col("_value"))
        self.leaves = written(placed.join(broadcast_if_small(groups), same).drop("_value"))
        self.nodes = build(self.leaves, run, keep_all)
        tops = self.nodes.join(broadcast_if_small(groups), "grp").where(F.col("level") == _height(F.col("n"))).select("grp", F.hex("hash").alias("subroot"), "hash")
        count = groups.count()
        upper = written(tops.select(F.lit(0).cast("bigint").alias("grp"), F.col("grp").alias("position"), F.lit(count).cast("bigint").alias("n"), "hash"))
        nodes = build(upper, run)
        proofs = multiproof(upper, nodes, _proofs, PROOF, run)
        self.groups = written(proofs.select(F.col("position").alias("grp"), F.col("proof").alias("upper"), F.col("top").alias("root")))

    def proved(self, expand, schema: str, leaves: DataFrame | None = None) -> DataFrame:
        """``expand(frame, levels)`` over leaf partitions whose rows carry ``upper`` and ``root``."""
        own = (self.leaves if leaves is None else leaves).join(broadcast_if_small(self.groups), "grp")
        # Ids travel as text: pandas would make floats of longs beside nulls.
        kind = dict(own.dtypes)[self.id]
        found = multiproof(own.withColumn(self.id, F.col(self.id).cast("string")), self.nodes, expand, schema, self.run)
        return found.withColumn(self.id, F.col(self.id).cast(kind))

    def proofs(self, leaves: DataFrame | None = None) -> DataFrame:
        """``doc_id, leaf, proof, root`` of all leaves, or of some of ``self.leaves``.

        Some leaves need nodes inside other rows' partitions: build the manifest with ``keep_all`` then.
        """
        self_id = self.id

        def expand(frame: pd.DataFrame, levels: list[dict[int, str]]) -> pd.DataFrame:
            proofs = [[{"hash": h, "left": left} for h, left in expanded(int(p), levels)] + [{"hash": x["hash"], "left": x["left"]} for x in upper] for p, upper in zip(frame["position"], frame["upper"])]
            return pd.DataFrame({self_id: frame[self_id], "leaf": [bytes(h).hex() for h in frame["hash"]], "proof": proofs, "root": frame["root"]})

        return self.proved(expand, f"{self.id} string, leaf string, proof array<struct<hash: string, left: boolean>>, root string", leaves)


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


AUDIT = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _audited(frame: pd.DataFrame, levels: list[dict[int, str]]) -> pd.DataFrame:
    upper = [(x["hash"], x["left"]) for x in frame["upper"].iloc[0]]
    root, rows = frame["root"].iloc[0], []
    for doc, position, leaf, changed in zip(frame["doc_id"], frame["position"], frame["hash"], frame["changed"]):
        proof = expanded(int(position), levels) + upper
        found = folded(bytes(leaf if changed is None else changed).hex(), proof)
        rows.append((doc, bytes(leaf).hex(), levels[-1][0], root, joined_hash(*[h for h, _ in proof]), found, found == root))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in AUDIT.split(", ")])


def audit(docs: DataFrame, tampered: Column) -> DataFrame:
    """``AUDIT`` of every row: its proof, and where the proof leads once ``tampered`` rows gain 1 in ``n_chars``."""
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    differs = tampered & F.col("n_chars").isNotNull()
    rows = docs.select("doc_id", "lang", F.unhex(leaf_hash([F.col(c) for c in FIELDS])).alias("hash"), F.when(differs, F.unhex(leaf_hash(changed))).alias("changed"))
    return Manifest(rows).proved(_audited, AUDIT)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), id_fold(7) == 0)


def _leaf_sql(n_chars: str) -> str:
    values = ["doc_id", "source", "lang", n_chars, "text"]
    return f"SHA256({' || '.join(f"COALESCE(STRLEN(CAST({v} AS VARCHAR)) || ':' || {v}, '-')" for v in values)})"


OP13_SQL = f"""
WITH RECURSIVE leaf AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, lang, {_leaf_sql("n_chars")} AS leaf, CASE WHEN {crc_sql("COALESCE(CAST(doc_id AS VARCHAR), '')")} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS changed FROM documents),
placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, COUNT(*) OVER (PARTITION BY lang) AS n FROM leaf),
tree AS (SELECT lang, 0 AS level, p AS i, n AS w, leaf AS h FROM placed UNION ALL SELECT lang, level + 1, i // 2, (w + 1) // 2, SHA256(STRING_AGG(h, '' ORDER BY i)) FROM tree WHERE w > 1 GROUP BY lang, level, w, i // 2),
sub AS (SELECT lang, h, ROW_NUMBER() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, COUNT(*) OVER () AS n FROM tree WHERE w = 1),
top AS (SELECT 1000 AS level, p AS i, n AS w, h FROM sub UNION ALL SELECT level + 1, i // 2, (w + 1) // 2, SHA256(STRING_AGG(h, '' ORDER BY i)) FROM top WHERE w > 1 GROUP BY level, w, i // 2),
ways AS (
  SELECT r, level, (p >> level) AS own, t.lang, TRUE AS low FROM placed JOIN (SELECT DISTINCT lang, level FROM tree WHERE w > 1) t ON t.lang IS NOT DISTINCT FROM placed.lang
  UNION ALL
  SELECT r, level, (sub.p >> (level - 1000)), NULL, FALSE FROM placed JOIN sub ON sub.lang IS NOT DISTINCT FROM placed.lang, (SELECT DISTINCT level FROM top WHERE w > 1) t),
steps AS (
  SELECT r, ways.level, own, h FROM ways LEFT JOIN tree ON tree.lang IS NOT DISTINCT FROM ways.lang AND tree.level = ways.level AND tree.i = XOR(own, 1) WHERE low
  UNION ALL
  SELECT r, ways.level, own, h FROM ways LEFT JOIN top ON top.level = ways.level AND top.i = XOR(own, 1) WHERE NOT low),
proof AS (SELECT r, SHA256(STRING_AGG(h, '' ORDER BY level)) AS proof, LIST(CASE WHEN h IS NULL THEN 'R' WHEN own % 2 = 1 THEN 'L' || h ELSE 'R' || h END ORDER BY level) AS path FROM steps GROUP BY r),
found AS (SELECT doc_id, leaf, sub.h AS subroot, (SELECT h FROM top WHERE w = 1) AS root, COALESCE(proof, SHA256('')) AS proof_sha256, LIST_REDUCE(LIST_CONCAT([changed], COALESCE(path, [])), LAMBDA x, s: SHA256(CASE WHEN s[1] = 'L' THEN s[2:] || x ELSE x || s[2:] END)) AS folded_root FROM placed LEFT JOIN proof USING (r) JOIN sub ON sub.lang IS NOT DISTINCT FROM placed.lang)
SELECT *, folded_root = root AS verified FROM found
"""
