"""Document fingerprints: quartile digests of hashed byte triplets.

Every triplet of a sliding five-byte window that includes its newest byte is
hashed to one of 256 buckets. A bucket's count against the three quartiles of
all counts gives two bits; with the logarithm of the length and two quartile
ratios they make the fingerprint, a short hex string. Two fingerprints are
compared by a difference score: bucket distance (a jump from the lowest to the
highest quarter costs double), plus length and quartile-ratio steps, each
bounded, so the score has a fixed maximum and likeness is one minus its share
of it.

Defined results: null texts are empty; texts shorter than three bytes have no
triplets and an all-zero body; equal texts have equal fingerprints; two
fingerprints of nothing are alike (1); malformed or null fingerprints compare
to 0; null ids come last in falling order; rows that share an id follow each
other by a hash of their text; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.llm.common import checkpointed, documents, small_batches, written

BUCKETS = 256
#: Bytes hashed at a time.
CHUNK = 1 << 20
#: Bytes of text in a part of neighbouring documents.
PART_BYTES = 16_000_000

_MIX = np.random.default_rng(3).permutation(256).astype(np.uint8)
#: Distance of two two-bit codes.
_STEP = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]])
MOST_LENGTH, MOST_RATIO = 24, 12
MOST = 6 * BUCKETS // 2 + MOST_LENGTH + 2 * MOST_RATIO


def triplet_counts(raw: np.ndarray) -> np.ndarray:
    """Counts of hashed triplets of a byte string."""
    counts = np.zeros(BUCKETS, np.int64)
    for begin in range(0, max(1, len(raw) - 2), CHUNK):
        part = raw[begin : begin + CHUNK + 4]
        fresh = min(CHUNK, len(part))  # windows that start in this chunk
        for salt, (i, j) in enumerate(((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))):
            n = min(fresh, len(part) - j)
            if n <= 0:
                continue
            h = _MIX[_MIX[_MIX[part[:n] ^ np.uint8(37 * salt)] ^ part[i : i + n]] ^ part[j : j + n]]
            counts += np.bincount(h, minlength=BUCKETS)
    return counts


def fingerprint(data: bytes) -> str:
    """Hex digest of a byte string: length step, two ratio steps, two bits a bucket."""
    counts = triplet_counts(np.frombuffer(data, np.uint8))
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1])
    step = min(255, round(12 * math.log2(1 + len(data))))
    ratios = [min(15, int(16 * q / (q3 + 1))) for q in (q1, q2)]
    return bytes([step, ratios[0] << 4 | ratios[1]]).hex() + body.astype(np.uint8).tobytes().hex()


def _parts(digest: str) -> tuple[int, int, int, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(digest), np.uint8)
    body = raw[2:]
    return int(raw[0]), int(raw[1] >> 4), int(raw[1] & 15), np.stack([body >> 6, body >> 4 & 3, body >> 2 & 3, body & 3], 1).reshape(-1)


def difference(a: str, b: str) -> int:
    """Difference score, 0 to ``MOST``."""
    (la, qa, ra, ca), (lb, qb, rb, cb) = _parts(a), _parts(b)
    ring = lambda x, y: min(abs(x - y), 16 - abs(x - y))
    body = int(_STEP[ca, cb].sum())
    return min(body, 6 * BUCKETS // 2) + min(abs(la - lb), MOST_LENGTH) + min(2 * ring(qa, qb), MOST_RATIO) + min(2 * ring(ra, rb), MOST_RATIO)


def likeness(a: str | None, b: str | None) -> float:
    """1 for equal fingerprints, 0 for the largest difference or what is no fingerprint."""
    size = 2 * (2 + BUCKETS // 4)
    if a is None or b is None or len(a) != size or len(b) != size:
        return 0.0
    return 1.0 if a == b else 1 - difference(a, b) / MOST


def fingerprint_column(text: str = "text"):
    """Fingerprint of a text column."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint((t or "").encode("utf-8", "surrogatepass")) for t in texts], dtype=object)

    return run(F.col(text))


def edited_text(text: str, following: str) -> str:
    """The last third of the characters replaced by as many first ones of the next text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def neighbours(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Fingerprints of every text, its edited text, and their likeness; see the query's contract.

    Rows are dealt by range in falling id order to parts of about ``part_bytes``
    and read in order with one row held back, so a row meets the next one in its
    part. What a part can't finish, its last row, waits with the part's first
    row for the second step: the parts' first keys are ranked (one narrow row a
    part), and each last row is joined to the first row of the following part.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    order = (F.col("doc_id").desc_nulls_last(), F.col("mark"))
    ordered = rows.repartitionByRange(max(1, -(-total // part_bytes)), *order).sortWithinPartitions(*order, "text")
    done = written(ordered.mapInPandas(_run_of_neighbours, f"{SCHEMA}, head_id long, head_mark long, head_text string, head_print string, tail_text string"))

    edges = done.where("head_print IS NOT NULL")
    ranked = edges.select(F.col("head_id").alias("_id"), F.col("head_mark").alias("_mark")).withColumn("part", F.row_number().over(W.orderBy(F.col("_id").desc_nulls_last(), "_mark")))
    ranked = checkpointed(ranked)
    parts = ranked.count()
    edges = edges.join(ranked, F.col("head_id").eqNullSafe(F.col("_id")) & (F.col("head_mark") == F.col("_mark")))
    following = edges.select(((F.col("part") + (parts - 2)) % max(parts, 1) + 1).alias("part"), F.col("head_text").alias("next_text"), F.col("head_print").alias("next_print"))
    tails = edges.select("part", "doc_id", "fingerprint", "tail_text").join(following, "part")
    return done.where("head_print IS NULL").select(*COLUMNS).unionByName(tails.mapInPandas(_last_of_parts, SCHEMA))


def _compared(doc, text: str, digest: str, following: str, next_digest: str) -> tuple:
    """The result row of a text and the text that follows it."""
    edited = edited_text(text, following).encode("utf-8", "surrogatepass")
    changed = fingerprint(edited)
    return doc, len(text), sha256(edited).hexdigest(), digest, changed, likeness(digest, changed), likeness(digest, next_digest)


def _run_of_neighbours(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Finished rows of an ordered part, then its last row with the first row beside it."""
    head = held = None  # id, mark, text, fingerprint
    for frame in frames:
        out = []
        for doc, mark, text in zip(frame["doc_id"].astype("Int64"), frame["mark"], frame["text"]):
            text = text or ""
            digest = held[3] if held is not None and held[2] == text else fingerprint(text.encode("utf-8", "surrogatepass"))
            if held is None:
                head = (doc, mark, text, digest)
            else:
                out.append(_compared(held[0], held[2], held[3], text, digest))
            held = (doc, mark, text, digest)
        done = pd.DataFrame(out, columns=COLUMNS).astype({"doc_id": "Int64"})
        yield done.assign(head_id=pd.array([None] * len(done), "Int64"), head_mark=pd.array([None] * len(done), "Int64"), head_text=None, head_print=None, tail_text=None)
    if held is not None:
        last = (held[0], len(held[2]), None, held[3], None, None, None, *head, held[2])
        yield pd.DataFrame([last], columns=[*COLUMNS, "head_id", "head_mark", "head_text", "head_print", "tail_text"]).astype({"doc_id": "Int64", "head_id": "Int64"})


def _last_of_parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        columns = (frame["doc_id"].astype("Int64"), *(frame[c] for c in ("tail_text", "fingerprint", "next_text", "next_print")))
        yield pd.DataFrame([_compared(*row) for row in zip(*columns)], columns=COLUMNS).astype({"doc_id": "Int64"})


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def op9_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(documents(spark, sf_dir))


def _triplets_sql() -> str:
    """The six salted triplets of a window ``x0`` to ``x4`` as a list of buckets."""
    mix = f"[{', '.join(map(str, _MIX.tolist()))}]"
    at = lambda x: f"{mix}[{x} + 1]"
    rows = []
    for salt, (i, j) in enumerate(((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))):
        inner = at(f"XOR(x0, {37 * salt})")
        inner = at(f"XOR({inner}, x{i})")
        rows.append(f"CASE WHEN x{j} IS NOT NULL THEN {at(f'XOR({inner}, x{j})')} END")
    return f"[{', '.join(rows)}]"


def _likeness_sql(a: str, b: str) -> str:
    ring = lambda q: f"LEAST(2 * LEAST(ABS({a}.{q} - {b}.{q}), 16 - ABS({a}.{q} - {b}.{q})), {MOST_RATIO})"
    steps = f"LIST_SUM(LIST_TRANSFORM(LIST_ZIP({a}.codes, {b}.codes), LAMBDA z: CASE ABS(z[1] - z[2]) WHEN 3 THEN 6 ELSE ABS(z[1] - z[2]) END))"
    return f"CASE WHEN {a}.print = {b}.print THEN 1.0::DOUBLE ELSE 1 - (LEAST({steps}, {6 * BUCKETS // 2}) + LEAST(ABS({a}.step - {b}.step), {MOST_LENGTH}) + {ring('r1')} + {ring('r2')}) / {MOST}::DOUBLE END"


OP9_SQL = f"""
WITH docs AS (SELECT doc_id, COALESCE(text, '') AS t, ROW_NUMBER() OVER (ORDER BY doc_id DESC) AS r, COUNT(*) OVER () AS n FROM documents),
edited AS (SELECT a.doc_id, b.doc_id AS next_id, a.t, LEFT(a.t, LENGTH(a.t) - LENGTH(a.t) // 3) || LEFT(b.t, LENGTH(a.t) // 3) AS e FROM docs a JOIN docs b ON b.r = a.r % a.n + 1),
versions AS (SELECT doc_id, 0 AS v, HEX(ENCODE(t)) AS h FROM edited UNION ALL SELECT doc_id, 1, HEX(ENCODE(e)) FROM edited),
cells AS (SELECT doc_id, v, UNNEST(REGEXP_EXTRACT_ALL(h, '..')) AS x, GENERATE_SUBSCRIPTS(REGEXP_EXTRACT_ALL(h, '..'), 1) AS p FROM versions),
bytes AS (SELECT doc_id, v, p, CAST('0x' || x AS INT) AS x0 FROM cells),
spread AS (SELECT doc_id, v, x0, LEAD(x0, 1) OVER o AS x1, LEAD(x0, 2) OVER o AS x2, LEAD(x0, 3) OVER o AS x3, LEAD(x0, 4) OVER o AS x4 FROM bytes WINDOW o AS (PARTITION BY doc_id, v ORDER BY p)),
hits AS (SELECT doc_id, v, UNNEST({_triplets_sql()}) AS h FROM spread),
counts AS (SELECT doc_id, v, h, COUNT(*) AS c FROM hits WHERE h IS NOT NULL GROUP BY ALL),
grid AS (SELECT doc_id, v, LENGTH(h) // 2 AS size, UNNEST(RANGE({BUCKETS})) AS h FROM versions),
lists AS (SELECT doc_id, v, ANY_VALUE(size) AS size, LIST(COALESCE(c, 0) ORDER BY h) AS cs FROM grid LEFT JOIN counts USING (doc_id, v, h) GROUP BY doc_id, v),
quarters AS (SELECT *, LIST_SORT(cs)[{BUCKETS // 4}] AS q1, LIST_SORT(cs)[{BUCKETS // 2}] AS q2, LIST_SORT(cs)[{3 * BUCKETS // 4}] AS q3 FROM lists),
coded AS (SELECT doc_id, v, LIST_TRANSFORM(cs, LAMBDA c: CAST(c > q1 AS INT) + CAST(c > q2 AS INT) + CAST(c > q3 AS INT)) AS codes, LEAST(255, CAST(ROUND_EVEN(12 * LOG2(1 + size), 0) AS INT)) AS step,
  CAST(LEAST(15, 16 * q1 // (q3 + 1)) AS INT) AS r1, CAST(LEAST(15, 16 * q2 // (q3 + 1)) AS INT) AS r2 FROM quarters),
prints AS (SELECT *, PRINTF('%02x%x%x', step, r1, r2) || ARRAY_TO_STRING(LIST_TRANSFORM(RANGE({BUCKETS // 4}), LAMBDA k: PRINTF('%02x', 64 * codes[4 * k + 1] + 16 * codes[4 * k + 2] + 4 * codes[4 * k + 3] + codes[4 * k + 4])), '') AS print FROM coded)
SELECT d.doc_id, CAST(LENGTH(d.t) AS BIGINT) AS n_chars, SHA256(d.e) AS edited_sha256, a.print AS fingerprint, b.print AS edited_fingerprint, {_likeness_sql('a', 'b')} AS near_edited, {_likeness_sql('a', 'c')} AS near_next
FROM edited d JOIN prints a ON a.doc_id = d.doc_id AND a.v = 0 JOIN prints b ON b.doc_id = d.doc_id AND b.v = 1 JOIN prints c ON c.doc_id = d.next_id AND c.v = 0
"""
