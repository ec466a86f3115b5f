"""Media columns: lossless FLAC storage of byte payloads and seekable PCM blocks.

``encode_media`` writes a text's payload (its UTF-8 bytes, filled up with zero
bytes to a positive multiple of 64) as an 8-bit FLAC stream. ``decode_media``
reads stored streams back, verifying frame and stream checksums, into PCM
blocks with the sample they start at and the place of their frame, so a reader
can seek. ``block_features`` summarises the PCM. Texts are handled in parts of
bounded size; the frames of a part are coded together. Null ids are kept as they are.

Defined results: null and empty texts store 64 zero bytes; equal texts give
equal streams and features; a damaged stream fails the job with its reason; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanframe.llm import flac
from urbanframe.llm.common import documents, small_batches

UNIT = 64
#: Payload bytes coded together.
PART_BYTES = 1_000_000


def payload(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % UNIT if raw else UNIT)


def _parts(sizes: list[int]) -> Iterator[slice]:
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > PART_BYTES:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def encode_column(text: str = "text") -> Column:
    """The FLAC stream of each text's payload."""

    @F.pandas_udf("binary")
    def stored(texts: pd.Series) -> pd.Series:
        out: list[bytes] = []
        own = texts.tolist()
        for part in _parts([len(t or "") + UNIT for t in own]):
            out += flac.encode([payload(t) for t in own[part]])
        return pd.Series(out, dtype=object)

    return stored(F.col(text))


def encode_media(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, media``: the FLAC stream of each text's payload."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"), encode_column(text).alias("media"))


def _read_back(media: pd.Series) -> Iterator[tuple[bytes, list[tuple[int, int, bytes]]]]:
    """Every stored stream and its PCM blocks, decoded part by part."""
    streams = [bytes(m) for m in media]
    for part in _parts(list(map(len, streams))):
        yield from zip(streams[part], flac.decode(streams[part]))


def decode_media(stored: DataFrame) -> DataFrame:
    """Adds ``blocks``: array of ``sample, place, pcm`` of each stored stream."""
    small_batches(stored.sparkSession)

    @F.pandas_udf("array<struct<sample: long, place: long, pcm: binary>>")
    def blocks(media: pd.Series) -> pd.Series:
        return pd.Series([[{"sample": s, "place": p, "pcm": b} for s, p, b in own] for _, own in _read_back(media)], dtype=object)

    return stored.withColumn("blocks", blocks("media"))


def block_features(pcm: bytes) -> str:
    """Summary of unsigned 8-bit samples: count, mean, RMS, zero crossings, peak."""
    x = np.frombuffer(pcm, np.uint8).astype(np.int64) - 128
    if not len(x):
        return "samples=0"
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"samples={len(x)};mean={x.sum() / len(x):.6f};rms={math.sqrt(int((x * x).sum()) / len(x)):.6f};crossings={crossings};peak={int(np.abs(x).max())}"


def media_digests(stored: DataFrame) -> DataFrame:
    """Digests and features of stored streams, from the PCM blocks read back out of them.

    Only the numbers leave the worker: where ``stored`` comes straight from
    ``encode_media``, both steps run in one Python worker, part by part.
    """
    small_batches(stored.sparkSession)

    @F.pandas_udf(DIGEST)
    def digest(media: pd.Series) -> pd.DataFrame:
        rows = []
        for stream, blocks in _read_back(media):
            data = b"".join(pcm for _, _, pcm in blocks)
            rows.append((len(data), sha256(data).hexdigest(), zlib.crc32(data[-UNIT:]), len(stream), sha256(stream).hexdigest(), block_features(data)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in DIGEST.split(", ")])

    return stored.select("doc_id", "n_bytes", digest("media").alias("_d")).select("doc_id", "n_bytes", "_d.*")


DIGEST = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(encode_media(documents(spark, sf_dir)))
