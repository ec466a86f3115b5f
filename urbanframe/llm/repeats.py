"""Removal of long repeats with a logarithmic family of sampled suffix arrays.

Every byte string of ``length`` bytes that also starts earlier (smaller id, or
same document and earlier start) is covered; covered bytes are removed.

A new batch of documents gets suffix arrays: each task samples suffixes by
content (see ``anchors``: a repeat always shares one), sorts blocks of about
400,000 of them, and sets aside those that an earlier one of the block repeats.
The arrays are then merge-scanned, in one sort by suffix hash, against each other
and all existing levels. A whole segment that stands earlier is covered at
once. Segments that share their suffix but not their surroundings are noted; at
the end they are cut in pieces of a few windows, matched by the bytes that all
windows of a piece share, and only pieces whose core repeats are compared window
by window. What the scan finds new becomes a level; two levels of equal size
merge into one of twice the size when the next batch comes, so ``n`` batches
keep at most ``log2(n) + 1`` levels. Levels are tables bucketed by suffix hash:
a scan or a merge moves only the new batch, and texts are read once for their
suffixes and once for the pieces, whatever the number of batches.

The arrays hold one suffix in about 32 and are ordered by hashes of the suffixes'
first bytes, not by the bytes: equality over ``length`` bytes is all that counts
here, and arrays of all suffixes cost more than the budget (see README). Whole
segments are equal when two 64-bit hashes are, pieces when a 64-bit and a 32-bit
hash and the bytes beside them are.

Hot groups: of equal segments or windows a block keeps one. A suffix with many
surroundings in a block leaves a mark under its hash, and its segments are dealt
out by their surroundings.

Defined results: null texts are empty and keep nothing; texts shorter than
``length`` are whole; an exact copy of an earlier text of at least ``length``
bytes goes wholly; rows that repeat an id with the same text count as one
document, so both keep the same bytes; texts that share an id are ordered by a
hash; null ids come last; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.llm.anchors import GRAM, LENGTH, Hashed, mixed, segments
from urbanframe.llm.common import broadcast_if_small, checkpointed, documents, fresh, keyed, small_batches, trimmed, written
from urbanframe.session import shared_folder

BLOCK_SUFFIXES = 400_000
BLOCK_PIECES = 120_000
#: Different surroundings of a suffix in a block from which its segments are dealt out by them.
HOT = 64
#: Windows of a piece.
STRIDE = 6
BATCHES = 4

ARRAY = "gram long, whole long, _key long, first int, shape int, kind int"
CANDIDATE, COVERED, HOT_SEGMENT, MARK = range(4)
PIECE = "kind int, core long, mark int, _key long, start int, t_low int, t_high int, `left` long, `right` long"


def _raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Which rows of sorted columns differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def suffix_arrays(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Sampled suffix arrays of blocks of texts (``_key, text``).

    ``shape`` packs a segment's windows and its suffix's offset. Rows of kind
    COVERED repeat an earlier segment of their block; they need no comparison
    and are dealt out by a hash of their place. HOT_SEGMENT rows are dealt out
    by suffix and surroundings, and a MARK row stands for them under the suffix.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        total = 0

        def sorted_block() -> pd.DataFrame:
            grams, whole, key, first, shape = (np.concatenate(x) for x in zip(*held))
            held.clear()
            order = np.lexsort((first, key, whole, grams))
            grams, whole, key, first, shape = (x[order] for x in (grams, whole, key, first, shape))
            new = _starts(grams, whole)
            head = np.flatnonzero(_starts(grams))
            group = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(grams))))
            hot = np.bincount(group, weights=new, minlength=len(head)) >= HOT
            kind = np.where(new, np.where(hot[group], HOT_SEGMENT, CANDIDATE), COVERED)
            marks = grams[head[hot]]
            place = mixed(key.view(np.uint64) * np.uint64(31) + first.astype(np.uint64)).view(np.int64)
            around = mixed(grams.view(np.uint64) * np.uint64(31) + whole.view(np.uint64)).view(np.int64)
            grams = np.choose(kind, [grams, place, around])
            none = np.zeros(len(marks), np.int64)
            columns = ((grams, marks), (whole, none), (key, none), (first, none), (shape, none), (kind, none + MARK))
            names = [c.split()[0] for c in ARRAY.split(", ")]
            return pd.DataFrame({n: np.concatenate(c) for n, c in zip(names, columns)})

        for frame in frames:
            for key, text in zip(frame["_key"].tolist(), frame["text"]):
                raw = _raw(text)
                if len(raw) < length:
                    continue
                grams, whole, first, windows, offset = segments(raw, length, gram)
                held.append((grams, whole, np.full(len(grams), key, np.int64), first, windows * 256 + offset))
                total += len(grams)
                if total > BLOCK_SUFFIXES:
                    yield sorted_block()
                    total = 0
        if held:
            yield sorted_block()

    return texts.select("_key", "text").mapInPandas(trimmed(run), ARRAY)


def _cut_in_pieces(raw: np.ndarray, first: np.ndarray, shape: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Core hashes, starts, window ranges and bytes beside the cores of the pieces of some segments."""
    core = length - STRIDE + 1
    high = shape % 256
    low = high - shape // 256 + 1
    count = high // STRIDE - low // STRIDE + 1
    own = np.repeat(np.arange(len(first)), count)
    turn = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count) + (low // STRIDE)[own]
    start = (first + high)[own] - STRIDE * turn
    t_low = np.maximum(low[own] - STRIDE * turn, 0)
    t_high = np.minimum(high[own] - STRIDE * turn, STRIDE - 1)
    edge = np.concatenate([np.zeros(STRIDE, np.uint8), raw, np.zeros(STRIDE, np.uint8)])
    left, right = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    for i in range(STRIDE - 1):
        left = left << 8 | edge[start + i + 1]
        right = right << 8 | edge[start + core + STRIDE + i]
    return _slices(raw, start, core, 0), (_slices(raw, start, core, 1) >> 32).astype(np.int32), start, t_low, t_high, left, right


def _slices(raw: np.ndarray, start: np.ndarray, size: int, family: int, chunk: int = 1 << 18) -> np.ndarray:
    """Hashes of ``size`` bytes from each start; a long text is hashed in chunks."""
    if len(raw) <= 2 * chunk:
        return Hashed(raw, family).slices(start, start + size).view(np.int64)
    out = np.zeros(len(start), np.int64)
    for begin in range(0, len(raw), chunk):
        own = np.flatnonzero((start >= begin) & (start < begin + chunk))
        if len(own):
            out[own] = Hashed(raw[begin : begin + chunk + size], family).slices(start[own] - begin, start[own] - begin + size).view(np.int64)
    return out


def _pieces(texts: DataFrame, length: int) -> DataFrame:
    """Pieces of the segments (arrays ``firsts, shapes``) of each text.

    Of windows that a block of pieces repeats only the first is kept, as a piece
    of one window. The others are covered: rows of kind COVERED have the begin
    (``start``) and, in ``left``, the end of runs of them.
    """
    names = [c.split()[0].strip("`") for c in PIECE.split(", ")]

    def block(held: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
        key, core, mark, start, t_low, t_high, left, right = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((mark, core))
        new = _starts(core[order], mark[order])
        group = np.cumsum(new) - 1
        again = np.zeros(len(core), bool)
        again[order] = (np.bincount(group) > 1)[group]
        lone = [c[~again] for c in (core, mark, key, start, t_low, t_high, left, right)]
        # Windows of the repeated cores, one row each.
        some = np.flatnonzero(again)
        count = (t_high - t_low + 1)[some]
        own = np.repeat(some, count)
        t = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count) + t_low[own]
        l, r = left[own] & ((np.int64(1) << 8 * t) - 1), right[own] >> 8 * t
        order = np.lexsort((start[own] - t, key[own], r, l, t, mark[own], core[own]))
        own, t = own[order], t[order]
        new = _starts(core[own], mark[own], t, l[order], r[order])
        kept, one = own[new], t[new]
        firsts = [core[kept], mark[kept], key[kept], start[kept], one, one, left[kept], right[kept]]
        where, begin = key[own[~new]], (start[own] - t)[~new]
        order = np.lexsort((begin, where))
        where, begin = where[order], begin[order]
        head = np.ones(len(begin), bool)
        head[1:] = (where[1:] != where[:-1]) | (begin[1:] > begin[:-1] + length)
        head = np.flatnonzero(head)
        last = np.append(head[1:], len(begin)) - 1 if len(head) else head
        none = np.zeros(len(head), np.int64)
        deal = mixed(where[head].view(np.uint64) * np.uint64(31) + begin[head].astype(np.uint64)).view(np.int64)
        covered = [deal, none, where[head], begin[head], none, none, begin[last] + length, none]
        kind = np.repeat([CANDIDATE, CANDIDATE, COVERED], [len(lone[0]), len(firsts[0]), len(head)])
        return pd.DataFrame(dict(zip(names, [kind, *(np.concatenate(x) for x in zip(lone, firsts, covered))])))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        total = 0
        for frame in frames:
            for key, text, first, shape in zip(frame["_key"].tolist(), frame["text"], frame["firsts"], frame["shapes"]):
                cut = _cut_in_pieces(_raw(text), np.asarray(first, np.int64), np.asarray(shape, np.int64), length)
                held.append((np.full(len(cut[0]), key, np.int64), *cut))
                total += len(cut[0])
                if total > BLOCK_PIECES:
                    yield block(held)
                    held, total = [], 0
        if held:
            yield block(held)

    return texts.select("_key", "text", "firsts", "shapes").mapInPandas(trimmed(run), PIECE)


class IndexFamily:
    """Levels of suffix tables over the batches added so far.

    Tables are made in a database of their own in the shared folder; ``close`` drops it with all of them.
    """

    def __init__(self, spark: SparkSession, length: int = LENGTH, gram: int = GRAM):
        self.spark, self.length, self.gram = spark, length, gram
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.base = f"suffixes_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.base} LOCATION '{shared_folder(spark)}/{self.base}'")
        self.tables = 0
        self.levels: list[tuple[int, str]] = []  # batches held, table
        self.merges = 0
        self.spots: list[DataFrame] = []
        self.spans: list[DataFrame] = []

    def _saved(self, rows: DataFrame) -> str:
        """A new table of ``rows``, bucketed by suffix hash."""
        self.tables += 1
        name = f"{self.base}.part{self.tables}"
        rows.write.bucketBy(self.buckets, "gram").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.base} CASCADE")
        self.levels = []

    def _merge(self) -> None:
        """Equal-sized levels become one; done lazily, before the next scan."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * n, self._saved(self.spark.table(b).unionByName(self.spark.table(a)))))
            self.merges += 1
            self._drop(a)
            self._drop(b)

    def add(self, batch: DataFrame, last: bool = False) -> None:
        """Index a batch (``_key, text``) whose keys follow those of all batches before.

        ``last`` leaves the levels as they are.
        """
        batch = batch.select("_key", "text")
        self._merge()
        bytes_of = batch.select("_key", F.octet_length("text").alias("n"), F.xxhash64("text").alias("h1"), F.crc32(F.col("text").cast("binary")).alias("h2")).where(F.col("n") >= self.length)
        rep = bytes_of.groupBy("h1", "h2", "n").agg(F.min("_key").alias("rep"), F.max("_key").alias("_top")).where("_top > rep").drop("_top")
        copies = checkpointed(bytes_of.join(broadcast_if_small(checkpointed(rep)), ["h1", "h2", "n"]).where("_key <> rep").select("_key", "n"))
        texts = batch.join(broadcast_if_small(copies.select("_key")), "_key", "left_anti")
        self.spans.append(copies.select("_key", F.lit(0).alias("begin"), F.col("n").cast("int").alias("end")))

        entries = suffix_arrays(texts, self.length, self.gram).repartition(self.buckets, "gram").withColumn("new", F.lit(1))
        for _, name in self.levels:
            entries = entries.unionByName(self.spark.table(name).withColumn("new", F.lit(0)))
        by_gram, in_order = W.partitionBy("gram"), W.partitionBy("gram", "whole").orderBy("_key", "first")
        state = (
            F.when(F.col("kind") == MARK, F.when(F.col("turn") > 1, COVERED).otherwise(0))
            .when((F.col("kind") == COVERED) | (F.col("turn") > 1), COVERED)
            .when(F.col("mixed") | ((F.col("kind") == HOT_SEGMENT) & (F.col("new") == 1)), 2)
            .otherwise(0)
        )
        scanned = (
            entries.withColumn("turn", F.row_number().over(in_order))
            .withColumn("mixed", (F.min("whole").over(by_gram) < F.max("whole").over(by_gram)) & (F.max("new").over(by_gram) == 1))
            .withColumn("state", state)
            .where("state = 2 OR new = 1" if not last else "state > 0 AND (state = 2 OR new = 1)")
            .select("gram", "whole", "_key", "first", "shape", "kind", "new", "state")
        )
        name = self._saved(scanned)
        table = self.spark.table(name)
        end = F.col("first") + F.floor(F.col("shape") / 256).cast("int") + (self.length - 1)
        self.spans.append(written(table.where(f"state = {COVERED} AND new = 1 AND kind <> {MARK}").select("_key", F.col("first").alias("begin"), end.alias("end"))))
        self.spots.append(written(table.where("state = 2").select("_key", "first", "shape")))
        if not last:
            kept = table.where(f"new = 1 AND state <> {COVERED}").select("gram", "whole", "_key", "first", "shape", "kind")
            self.levels.append((1, self._saved(kept)))
        self._drop(name)

    def covered(self, texts: DataFrame) -> DataFrame:
        """``_key, spans`` (array of ``begin, end`` in bytes, merged and sorted) of every
        text added so far that has any; ``texts`` has all of their rows."""
        spots, spans = self.spots[0], self.spans[0]
        for more in self.spots[1:]:
            spots = spots.unionByName(more)
        for more in self.spans[1:]:
            spans = spans.unionByName(more)
        return checkpointed(_merged(spans.unionByName(self._compared(spots, texts))))

    def _compared(self, spots: DataFrame, texts: DataFrame) -> DataFrame:
        """Covered windows of segments whose suffix stands in other surroundings too."""
        spots = spots.groupBy("_key").agg(F.collect_set(F.struct("first", "shape")).alias("s")).select("_key", F.col("s.first").alias("firsts"), F.col("s.shape").alias("shapes"))
        pieces = _pieces(texts.join(spots, "_key"), self.length)
        by_core = W.partitionBy("core", "mark", "kind")
        place = F.struct("_key", "start")
        pieces = pieces.withColumn("_again", F.min(place).over(by_core) < F.max(place).over(by_core)).where(f"_again OR kind = {COVERED}")
        # One read of the pieces serves both kinds: a covered run is one row.
        rows = pieces.withColumn("t", F.explode(F.sequence("t_low", "t_high"))).select(
            "kind", "core", "mark", "_key", "t", (F.col("start") - F.col("t")).alias("begin"),
            F.when(F.col("kind") == COVERED, F.col("left")).otherwise(F.expr("`left` & (shiftleft(1L, 8 * t) - 1)")).alias("l"),
            F.expr("shiftright(`right`, 8 * t)").alias("r"),
        )
        turn = F.row_number().over(W.partitionBy("core", "mark", "kind", "t", "l", "r").orderBy("_key", "begin"))
        rows = rows.withColumn("_turn", turn).where(f"_turn > 1 OR kind = {COVERED}")
        return rows.select("_key", "begin", F.when(F.col("kind") == COVERED, F.col("l")).otherwise(F.col("begin") + self.length).cast("int").alias("end"))


def _merged(spans: DataFrame) -> DataFrame:
    """``_key, spans``: overlapping and touching spans of each document as one."""
    in_order = W.partitionBy("_key").orderBy("begin", "end")
    reach = F.max("end").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    runs = spans.withColumn("_new", F.when(F.col("begin") <= reach, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(in_order.rowsBetween(W.unboundedPreceding, 0)))
    joined = runs.groupBy("_key", "_run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return joined.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))


def covered(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES) -> DataFrame:
    """``_key, spans`` of a whole table ``_key, text``, added in ``batches`` of rising keys."""
    family = IndexFamily(docs.sparkSession, length, gram)
    cuts = docs.select(F.percentile_approx("_key", [i / batches for i in range(1, batches)], 10_000)).first()[0] if batches > 1 else []
    cuts = sorted(set(cuts or []))
    try:
        for i in range(len(cuts) + 1):
            part = docs
            if i:
                part = part.where(F.col("_key") > cuts[i - 1])
            if i < len(cuts):
                part = part.where(F.col("_key") <= cuts[i])
            family.add(part, last=i == len(cuts))
        return family.covered(docs)
    finally:
        family.close()


def _without(text: str | None, begin, end) -> bytes:
    """A text's bytes outside its spans."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    at, kept = 0, []
    for a, b in zip(begin, end) if begin is not None else ():
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]])


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES) -> DataFrame:
    """``docs`` plus ``spans`` (covered bytes), ``kept`` (the other bytes) and ``n_bytes``."""
    small_batches(docs.sparkSession)
    key = fresh("_key", docs)
    docs, names = keyed(docs, key)
    texts = docs.select(F.col(key).alias("_key"), "text")
    spans = covered(texts if names is None else texts.dropDuplicates(["_key"]), length, gram, batches)
    n = spans.agg(F.coalesce(F.sum(F.size("spans") + 4), F.lit(0))).first()[0]
    spans = spans.withColumnRenamed("_key", key)
    joined = docs.join(F.broadcast(spans) if n <= 2_000_000 else spans, key, "left").drop(key)

    @F.pandas_udf("binary")
    def cut(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([_without(*row) for row in zip(texts, begins, ends)], dtype=object)

    return joined.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")).withColumn("kept", cut("text", "spans.begin", "spans.end"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def stage_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their covered bytes; documents that lose all their text go.

    A cut inside a character drops what is left of that character.
    """
    columns = docs.columns
    clash = {c: fresh(f"_own_{c}", docs) for c in columns if c.lower() in ("spans", "kept", "n_bytes")}
    cut = fresh("_cut", docs)
    found = without_repeats(docs.withColumnsRenamed(clash))

    @F.pandas_udf("string")
    def decoded(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([_without(*row).decode("utf-8", "ignore") for row in zip(texts, begins, ends)], dtype=object)

    # The bytes in ``kept`` are not asked for here, and a function that counts as not deterministic
    # is not repeated in the filter below: texts are cut once, by one Python worker a task.
    decoded = decoded.asNondeterministic()
    found = found.withColumn(cut, F.col("spans").isNotNull()).withColumn("text", F.when(F.col(cut), decoded("text", "spans.begin", "spans.end")).otherwise(F.col("text")))
    if "n_chars" in columns:
        found = found.withColumn("n_chars", F.when(F.col(cut), F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return found.where(~F.col(cut) | (F.length("text") > 0)).select(*[F.col(clash.get(c, c)).alias(c) for c in columns])


OP8_SQL = """
WITH docs AS (SELECT doc_id, ENCODE(COALESCE(text, '')) AS h FROM documents),
places AS (SELECT doc_id, h, UNNEST(RANGE(0, OCTET_LENGTH(h) - 99)) AS p FROM docs WHERE OCTET_LENGTH(h) >= 100),
windows AS (SELECT doc_id, p, ARRAY_SLICE(h, p + 1, p + 100) AS w FROM places),
later AS (SELECT doc_id, p FROM windows QUALIFY ROW_NUMBER() OVER (PARTITION BY w ORDER BY doc_id, p) > 1),
fresh AS (SELECT doc_id, p, CASE WHEN p <= LAG(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS f FROM later),
runs AS (SELECT doc_id, p, SUM(f) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM fresh),
spans AS (SELECT doc_id, run, MIN(p) AS b, MAX(p) + 100 AS e FROM runs GROUP BY 1, 2),
cuts AS (SELECT doc_id, b, e, LAG(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY b) AS a FROM spans),
kept AS (SELECT doc_id, COUNT(*) AS n_spans, SUM(e - b) AS n_removed, STRING_AGG(HEX(ARRAY_SLICE(h, a + 1, b)), '' ORDER BY b) || HEX(ARRAY_SLICE(ANY_VALUE(h), MAX(e) + 1, OCTET_LENGTH(ANY_VALUE(h)))) AS k FROM cuts JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(OCTET_LENGTH(h) AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, CAST(COALESCE(n_spans, 0) AS BIGINT) AS n_spans, SHA256(COALESCE(UNHEX(k), h)) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""
