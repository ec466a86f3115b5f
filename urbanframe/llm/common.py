"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanframe.session import broadcast_if_small, checkpointed, written  # noqa: F401

#: White space that separates words: space and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"


#: Rows and bytes of an Arrow batch that a Python worker gets.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20)}
#: Environment of Python workers: they live on between tasks, so freed memory goes back to the system.
WORKER = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(8 << 20)}


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, so that texts of any length fit a worker, and what workers hold between tasks.

    Spark's own bound is 10,000 rows of whatever size. A setting that the
    session already has is kept.
    """
    for key, value in WORKER.items():
        spark.sparkContext.environment.setdefault(key, value)
    for key, value in BATCH.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A batch function after whose end the worker, which lives on, gives its freed memory back to the system."""

    @functools.wraps(run)
    def go(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
                trim(0)

    return go


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with as many underscores before it as keep it apart from the frames' columns."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keyed(docs: DataFrame, key: str = "_key") -> tuple[DataFrame, DataFrame | None]:
    """``docs`` plus a long ``key`` that tells its documents apart, in the order of ``doc_id``.

    Rows with the same id and text share a key; null ids come last. Where ids
    are unique and not null, the usual case, the key is the id and the second
    result is None. Else keys are numbers given to the distinct pairs of id and
    text hash (ordered by id, then hash), and the second result, ``key,
    doc_id``, leads back.
    """
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    if not ids.head(1):
        return docs.withColumn(key, F.col("doc_id").cast("bigint")), None
    mark, doc, text_hash, number = (fresh(c, docs) for c in ("_mark", "_doc", "_hash", "_number"))
    marked = docs.withColumn(mark, F.coalesce(F.xxhash64("text"), F.lit(0)))
    pairs = marked.select(F.col("doc_id").alias(doc), F.col(mark).alias(text_hash)).distinct()
    names = checkpointed(pairs.orderBy(F.col(doc).asc_nulls_last(), text_hash).withColumn(number, F.monotonically_increasing_id()))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(mark) == F.col(text_hash))
    found = marked.join(broadcast_if_small(names), same).withColumn(key, F.col(number)).select(*docs.columns, key)
    return found, names.select(F.col(number).alias(key), F.col(doc).alias("doc_id"))


def id_text(column: str | Column = "doc_id") -> Column:
    """Decimal text of an id; a null id reads as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def id_fold(folds: int, column: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo ``folds``."""
    return F.crc32(id_text(column).cast("binary")) % F.lit(folds)


def unit_draw(*parts: str | Column) -> Column:
    """A reproducible number strictly between 0 and 1 from the md5 of ``parts``.

    md5 keeps the draw the same in any SQL engine; 52 bits are used.
    """
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def word_count(text: Column) -> Column:
    """Number of runs of characters other than white space; null counts 0."""
    body = F.regexp_replace(text, f"^[{SPACE}]+", "")
    marks = F.regexp_replace(body, f"[^{SPACE}]+[{SPACE}]*", "w")
    return F.coalesce(F.length(marks), F.lit(0)).cast("bigint")


def labelled_sample(labels: DataFrame, label: str, keep: Column | None, rows: int, seed: int = 17) -> DataFrame:
    """About ``rows`` labelled ids (``doc_id, label``), picked by a hash of the id.

    The sample only fits classifiers; its expected size is bounded by ``rows``
    whatever the table's size, so it may be broadcast. Rows with a null id or a
    label other than 0 and 1 are left out; several labels of one id count as 1
    if any of them is 1.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (F.lit(True) if keep is None else keep)).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    total = known.count()
    share = 2**30 if total <= rows else int(2**30 * rows / total)
    return known.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2**30)) < share)
