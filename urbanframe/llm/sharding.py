"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves of a tree of regions and racks. A key descends the tree;
at each level every child draws ``-ln(u) / weight`` from a hash of the key and
the child's name, and the smallest draw wins. A child is chosen in proportion
to its weight, and a child's draw depends on nothing but its own name and
weight, so a changed weight moves keys only into or out of that subtree: the
other children keep their order for every key.

A new shard is added as a region of its own, so it is the only subtree whose
weight changes and rows move into it alone.

DataFrame code only. Slots are gapless row numbers per shard, numbered without
sorting a shard in one task: keys are cut into hash buckets, buckets are
counted, and a row's slot is the rows of earlier buckets plus its number in its
own bucket.

Defined results: a null id hashes as the empty text; null and empty texts have
size 1 (their bytes plus one) and checksum 0; repeated rows keep separate slots
(their order among each other does not show); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.llm.common import documents, id_text, unit_draw

#: (region, rack, shard, weight) for each leaf.
Topology = list[tuple[str, str, int, float]]

#: Hash buckets per shard for slot numbers.
SLOT_BUCKETS = 512


def topology(shards: int, regions: int = 2, racks: int = 2, per_rack: int = 2) -> Topology:
    """``regions x racks x per_rack`` base shards; each further one is a region of its own."""
    base = regions * racks * per_rack
    tree: Topology = []
    for shard in range(min(shards, base)):
        region, inside = divmod(shard, racks * per_rack)
        tree.append((f"region{region}", f"region{region}/rack{inside // per_rack}", shard, 1.0))
    return tree + [(f"added{s}", f"added{s}/rack0", s, 1.0) for s in range(base, shards)]


def _winner(key: Column, seed: str, children: dict[str, tuple[float, Column]]) -> Column:
    """The value of the child with the smallest weighted draw."""
    live = {name: child for name, child in children.items() if child[0] > 0}
    if len(live) == 1:
        return next(iter(live.values()))[1]
    draws = [F.struct((-F.ln(unit_draw(seed, F.lit(name), key)) / F.lit(weight)).alias("draw"), F.lit(i).alias("child")) for i, (name, (weight, _)) in enumerate(live.items())]
    best = F.array_min(F.array(*draws))["child"]
    value = F.lit(None).cast("int")
    for i, (_, below) in enumerate(live.values()):
        value = F.when(best == i, below).otherwise(value)
    return value


def shard_of(key: Column, tree: Topology, seed: str = "shard") -> Column:
    """The shard (int) that ``key`` (text) descends to."""
    regions: dict[str, dict[str, dict[str, tuple[float, Column]]]] = {}
    for region, rack, shard, weight in tree:
        regions.setdefault(region, {}).setdefault(rack, {})[f"shard{shard}"] = (weight, F.lit(shard).cast("int"))
    top = {}
    for region, racks in regions.items():
        below = {rack: (sum(w for w, _ in leaves.values()), _winner(key, seed, leaves)) for rack, leaves in racks.items()}
        top[region] = (sum(w for w, _ in below.values()), _winner(key, seed, below))
    return _winner(key, seed, top)


def with_slots(rows: DataFrame, group: str, key: Column, order: list[str], slot: str = "slot", buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps, in hash-bucket order of ``key``."""
    dealt = rows.withColumn("_bucket", (F.conv(F.substring(F.md5(key), 14, 4), 16, 10).cast("int") % buckets))
    counts = dealt.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ahead = F.sum("_n").over(W.partitionBy(group).orderBy("_bucket")) - F.col("_n")
    starts = counts.select(group, "_bucket", ahead.alias("_start"))
    own = F.row_number().over(W.partitionBy(group, "_bucket").orderBy(*order)) - 1
    return dealt.join(starts, [group, "_bucket"]).withColumn(slot, (F.col("_start") + own).cast("bigint")).drop("_bucket", "_start")


def shard(docs: DataFrame, shards: int = 8, seed: str = "shard") -> DataFrame:
    """Place documents: ``doc_id, size, text_crc32, shard, slot, grown_shard``.

    ``grown_shard`` is the place with one more shard.
    """
    placed = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("bigint").alias("text_crc32"),
        shard_of(id_text(), topology(shards), seed).alias("shard"),
        shard_of(id_text(), topology(shards + 1), seed).alias("grown_shard"),
    )
    return with_slots(placed, "shard", F.concat_ws(":", id_text(), F.col("text_crc32")), ["doc_id", "text_crc32", "size"])


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(documents(spark, sf_dir), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        table.append(n)
    return table


def _winner_sql(children: dict[str, tuple[float, str]]) -> str:
    if len(children) == 1:
        return next(iter(children.values()))[1]
    draws = [f"-LN((CAST('0x' || SUBSTR(MD5('shard:{name}:' || k), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / {weight}::DOUBLE" for name, (weight, _) in children.items()]
    values = ", ".join(value for _, value in children.values())
    return f"[{values}][LIST_POSITION([{', '.join(draws)}], LIST_MIN([{', '.join(draws)}]))]"


def _shard_sql(shards: int) -> str:
    """The descent of the tree as SQL over a key ``k``."""
    top = {}
    tree = topology(shards)
    for region in dict.fromkeys(leaf[0] for leaf in tree):
        below = {}
        for rack in dict.fromkeys(leaf[1] for leaf in tree if leaf[0] == region):
            leaves = {f"shard{s}": (w, str(s)) for _, r, s, w in tree if r == rack}
            below[rack] = (sum(w for w, _ in leaves.values()), _winner_sql(leaves))
        top[region] = (sum(w for w, _ in below.values()), _winner_sql(below))
    return _winner_sql(top)


def crc_sql(text: str) -> str:
    """SQL of the unsigned crc32 of a text expression's UTF-8 bytes."""
    codes = f"LIST_TRANSFORM(REGEXP_EXTRACT_ALL(HEX(ENCODE({text})), '..'), LAMBDA x: CAST('0x' || x AS BIGINT))"
    step = f"XOR(c >> 8, CAST([{', '.join(map(str, _crc_table()))}][CAST(XOR(c, b) & 255 AS INT) + 1] AS BIGINT))"
    return f"COALESCE(XOR(LIST_REDUCE({codes}, LAMBDA c, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT), 0)"


OP7_SQL = f"""
WITH keyed AS (SELECT doc_id, COALESCE(CAST(doc_id AS VARCHAR), '') AS k, CAST(STRLEN(COALESCE(text, '')) + 1 AS BIGINT) AS size, {crc_sql("COALESCE(text, '')")} AS text_crc32 FROM documents),
placed AS (SELECT doc_id, size, text_crc32, {_shard_sql(8)} AS shard, {_shard_sql(9)} AS grown_shard, CAST('0x' || SUBSTR(MD5(k || ':' || text_crc32), 14, 4) AS INT) % {SLOT_BUCKETS} AS bucket FROM keyed)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INT) AS shard, CAST(ROW_NUMBER() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS BIGINT) AS slot, CAST(grown_shard AS INT) AS grown_shard FROM placed
"""
