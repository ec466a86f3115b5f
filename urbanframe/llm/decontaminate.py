"""Benchmark decontamination: which words of documents stand in a benchmark's texts.

Texts are lower-cased (A-Z) and cut into words, runs of characters other than
ASCII ones that are no letter or digit. Windows are ``words`` consecutive words
of an item; an item of fewer words is one window. A document word is hit if it
stands in any occurrence of a window.

The windows are broadcast as a set of hashes with the items' normalised texts
beside it; workers hash all windows of a document with numpy, look them up, and
compare the bytes of what they find, so a hash that happens to be equal counts
for nothing. The broadcast is made only after a check of the benchmark's size
(``BROADCAST_BYTES``). A larger benchmark becomes a table of windows: workers
send on the document windows that a bit table of fixed size lets pass, and a
join with the table on the hash and the text itself confirms them.

Defined results: null, empty and wordless texts have no words and no hits;
repeated rows get equal results; null ``doc_id`` values are kept; items of one
``item_id`` count once, a null ``item_id`` reads as the empty text, items
without words have no window; an empty benchmark hits nothing and an empty
table gives no rows. Other columns are kept by ``decontaminate`` and ignored by
``contamination``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanframe.llm.common import documents, fresh, keyed, small_batches, written
from urbanframe.llm.words import Block, blocks, byte_set, run_hashes

WINDOW = 10
#: Bytes of benchmark text up to which the set of windows is broadcast.
BROADCAST_BYTES = 16 << 20
#: Bits of the table that rules most windows out.
SIFT = 22
#: The same for a benchmark that is joined.
JOIN_SIFT = 26

SEPARATORS = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<begin: long, end: long>>"
WINDOWS = "hash long, words int, window binary, item string"


def _item_windows(texts: list[str | None], words: int) -> Iterator[tuple[int, Block, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: number of its first text, the block, and each window's hash, first and last word."""
    for first, block in blocks(texts, SEPARATORS):
        word = block.hashes()
        long = block.same_piece(words)
        short = np.flatnonzero(np.diff(np.concatenate([[-1], block.text])) > 0)
        sizes = np.diff(np.append(short, len(block)))
        short, sizes = short[sizes < words], sizes[sizes < words]
        begin, size = np.concatenate([long, short]), np.concatenate([np.full(len(long), words), sizes])
        code = np.zeros(len(begin), np.uint64)
        for n in np.unique(size):
            code[size == n] = run_hashes(word, int(n))[begin[size == n]]
        yield first, block, code, begin, begin + size - 1


class WindowSet:
    """Windows of items with their texts: sorted hashes, slices of one byte string, and the items that hold each."""

    def __init__(self, items: list[tuple[str, str | None]], words: int = WINDOW):
        parts, code, begin, end, size, owner = [], [], [], [], [], []
        at = 0
        for first, block, h, a, b in _item_windows([t for _, t in items], words):
            parts.append(block.raw.tobytes())
            code.append(h)
            begin.append(block.start[a] + at)
            end.append(block.end[b] + at)
            size.append(b - a + 1)
            owner.append(block.text[a] + first)
            at += len(parts[-1])
        names = {name: i for i, name in enumerate(sorted({name for name, _ in items}))}
        self.names = list(names)
        number = np.array([names[name] for name, _ in items], np.int64)
        empty = [np.zeros(0, np.int64)]
        code = np.concatenate([np.zeros(0, np.uint64), *code])
        begin, end, size, owner = (np.concatenate(x or empty) for x in (begin, end, size, owner))
        self.text = b"".join(parts)
        order = np.lexsort((end - begin, code))
        code, begin, end, size, owner = code[order], begin[order], end[order], size[order], number[owner[order]]
        # Equal windows become one entry; entries whose hashes are equal by chance stay apart.
        entry, firsts = np.zeros(len(code), np.int64), []
        run = 0
        for i, fresh_code in enumerate(np.concatenate([[True], code[1:] != code[:-1]]).tolist() if len(code) else []):
            if fresh_code:
                run = len(firsts)
            own = self.text[begin[i] : end[i]]
            for k in range(run, len(firsts)):
                if self.text[begin[firsts[k]] : end[firsts[k]]] == own:
                    entry[i] = k
                    break
            else:
                entry[i] = len(firsts)
                firsts.append(i)
        firsts = np.array(firsts, np.int64)
        self.code, self.begin, self.end, self.size = code[firsts], begin[firsts], end[firsts], size[firsts]
        pairs = np.unique(np.stack([entry, owner], 1), axis=0) if len(code) else np.zeros((0, 2), np.int64)
        self.owners = pairs[:, 1]
        self.first_owner = np.searchsorted(pairs[:, 0], np.arange(len(firsts) + 1))
        self.sizes = np.unique(self.size).tolist()

    def look_up(self, block: Block, sift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words of the block's windows that are in the set, and the entries they equal."""
        word = block.hashes()
        at, entry = [], []
        for n in self.sizes:
            first = block.same_piece(n)
            code = run_hashes(word, n)[first]
            maybe = sift[code >> np.uint64(64 - SIFT)]
            first, code = first[maybe], code[maybe]
            low, high = np.searchsorted(self.code, code), np.searchsorted(self.code, code, "right")
            for i in np.flatnonzero(low < high).tolist():
                own = block.raw[block.start[first[i]] : block.end[first[i] + n - 1]].tobytes()
                for k in range(low[i], high[i]):
                    if self.text[self.begin[k] : self.end[k]] == own:
                        at.append(first[i])
                        entry.append(k)
        return np.array(at, np.int64), np.array(entry, np.int64)


def _sift(code: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << SIFT, bool)
    table[code >> np.uint64(64 - SIFT)] = True
    return table


def _covered(block: Block, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Words inside any of the windows."""
    step = np.zeros(len(block) + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + size, -1)
    return np.cumsum(step[:-1]) > 0


def _found_in(block: Block, known: WindowSet, sift: np.ndarray) -> Iterator[tuple]:
    """``FOUND`` of every text of a block."""
    n_words = np.bincount(block.text, minlength=block.texts).tolist()
    at, entry = known.look_up(block, sift)
    if not len(at):
        yield from ((n, 0, [], []) for n in n_words)
        return
    hit = _covered(block, at, known.size[entry])
    n_hit = np.bincount(block.text[hit], minlength=block.texts).tolist()
    items: dict[int, set[int]] = {}
    for text, k in np.unique(np.stack([block.text[at], entry], 1), axis=0).tolist():
        items.setdefault(text, set()).update(known.owners[known.first_owner[k] : known.first_owner[k + 1]].tolist())
    word = np.flatnonzero(hit)
    new = np.concatenate([[True], (word[1:] != word[:-1] + 1) | (block.text[word[1:]] != block.text[word[:-1]])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(word)) - 1
    spans: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(word[first].tolist(), word[last].tolist()):
        spans.setdefault(int(block.text[a]), []).append((int(block.source_start[a]), int(block.source_end[b])))
    for i in range(block.texts):
        yield n_words[i], n_hit[i], [known.names[k] for k in sorted(items.get(i, ()))], spans.get(i, [])


def _scanned(docs: DataFrame, known: WindowSet) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf(FOUND)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        sift = _sift(own.code)
        for texts in batches:
            rows = [row for _, block in blocks(texts.tolist(), SEPARATORS) for row in _found_in(block, own, sift)]
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return docs.withColumn("_found", scan("text"))


def _window_table(benchmark: DataFrame, words: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names = frame["item"].tolist()
            for first, block, code, a, b in _item_windows(frame["text"].tolist(), words):
                cut = pd.Series([block.raw[s:e].tobytes() for s, e in zip(block.start[a], block.end[b])], dtype=object)
                yield pd.DataFrame({"hash": code.view(np.int64), "words": b - a + 1, "window": cut, "item": pd.Series([names[first + t] for t in block.text[a]], dtype=object)})

    return benchmark.mapInPandas(run, WINDOWS)


def _candidates(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """``_key, n_words`` of every row, and ``_key, hash, words, window, at, begin, end`` of windows that pass the bit table."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    schema = "_key long, n_words long, hash long, words int, window binary, at long, begin long, end long"
    columns = [c.split()[0] for c in schema.split(", ")]

    def passed(block: Block, keys: np.ndarray, size: int, word: np.ndarray) -> dict:
        at = block.same_piece(size)
        code = run_hashes(word, size)[at]
        place = (code >> np.uint64(64 - JOIN_SIFT)).astype(np.int64)
        maybe = (shared.value[place >> 6] >> (place & 63)) & 1 == 1
        at, code = at[maybe], code[maybe]
        last, text = at + size - 1, block.text[at]
        cut = pd.Series([block.raw[s:e].tobytes() for s, e in zip(block.start[at], block.end[last])], dtype=object)
        own = {"hash": code.view(np.int64), "words": size, "window": cut, "at": at - np.searchsorted(block.text, text)}
        return {"_key": keys[text], "n_words": None} | own | {"begin": block.source_start[at], "end": block.source_end[last]}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys = frame["_key"].to_numpy()
            for first, block in blocks(frame["text"].tolist(), SEPARATORS):
                own = keys[first : first + block.texts]
                rows = {"_key": own, "n_words": np.bincount(block.text, minlength=block.texts)}
                yield pd.DataFrame(rows | dict.fromkeys(columns[2:]), columns=columns)
                word = block.hashes()
                for size in sizes:
                    yield pd.DataFrame(passed(block, own, size, word), columns=columns)

    return docs.select("_key", "text").mapInPandas(run, schema)


def _union_of(runs: Column) -> Column:
    """Merged ``at, upto, begin, end`` of windows, words that follow each other joined."""
    none = F.array().cast("array<struct<at: bigint, upto: bigint, begin: bigint, end: bigint>>")

    def step(out: Column, r: Column) -> Column:
        last = F.element_at(out, -1)
        joined = F.struct(last["at"].alias("at"), F.greatest(last["upto"], r["upto"]).alias("upto"), last["begin"].alias("begin"), F.greatest(last["end"], r["end"]).alias("end"))
        return F.when((F.size(out) > 0) & (r["at"] <= last["upto"]), F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(joined))).otherwise(F.concat(out, F.array(r)))

    return F.aggregate(F.array_sort(runs), none, step)


def _joined(docs: DataFrame, benchmark: DataFrame, words: int) -> DataFrame:
    """As ``_scanned``, with the windows as a table that is joined by hash and text."""
    own, _ = keyed(docs, key := fresh("_key", docs))
    table = written(_window_table(benchmark, words).distinct())
    place = F.shiftrightunsigned("hash", 64 - JOIN_SIFT)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))
    filled = table.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(1 << JOIN_SIFT - 6, np.int64)
    bits[filled["at"].to_numpy()] = filled["bits"].to_numpy()
    sizes = sorted(r.words for r in table.select("words").distinct().collect())
    texts = own.select(F.col(key).alias("_key"), "text").dropDuplicates(["_key"])
    seen = written(_candidates(texts, bits, sizes))
    windows = table.select("hash", "words", "window").distinct()
    true = written(seen.where("hash IS NOT NULL").join(windows, ["hash", "words", "window"]))
    held = true.select("_key", "hash", "words", "window").distinct().join(table, ["hash", "words", "window"])
    items = held.groupBy("_key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    run = F.struct("at", (F.col("at") + F.col("words")).alias("upto"), "begin", "end")
    runs = true.groupBy("_key").agg(_union_of(F.collect_set(run)).alias("runs"))
    n_hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda s, r: s + r["upto"] - r["at"])
    spans = F.transform("runs", lambda r: F.struct(r["begin"].alias("begin"), r["end"].alias("end")))
    found = F.struct(
        "n_words",
        F.coalesce(n_hit, F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(spans, F.array().cast("array<struct<begin: bigint, end: bigint>>")).alias("spans"),
    )
    found = seen.where("hash IS NULL").join(runs, "_key", "left").join(items, "_key", "left").select(F.col("_key").alias(key), found.alias("_found"))
    return own.join(found, key).select(*docs.columns, "_found")


def _with_found(docs: DataFrame, benchmark: DataFrame, words: int, broadcast_bytes: int) -> DataFrame:
    small_batches(docs.sparkSession)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    if (items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0) > broadcast_bytes:
        return _joined(docs, items, words)
    return _scanned(docs, WindowSet([tuple(r) for r in items.collect()], words))


def contamination(docs: DataFrame, benchmark: DataFrame, words: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id``, number of words, of hit words, ids of the items met (sorted as strings), and ``spans``.

    Spans are the maximal runs of hit words, as places in the UTF-8 bytes.
    """
    found = _with_found(docs.select("doc_id", "text"), benchmark, words, broadcast_bytes)
    return found.select("doc_id", "_found.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", words: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The documents without hit spans (``remove="spans"``) or without hit documents (``"documents"``)."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    other = {c: fresh("_own_found", docs) for c in docs.columns if c.lower() == "_found"}
    found = _with_found(docs.withColumnsRenamed(other), benchmark, words, broadcast_bytes)
    back = [F.col(f"`{other.get(c, c)}`").alias(c) for c in docs.columns]
    if remove == "documents":
        return found.where(F.col("_found.n_hit") == 0).select(*back)
    return found.withColumn("text", F.pandas_udf(_cut_spans, "string")("text", "_found.spans")).select(*back)


def _cut_spans(text: pd.Series, spans: pd.Series) -> pd.Series:
    """``text`` less its ``spans`` of bytes."""
    out = []
    for own, cut in zip(text, spans):
        if cut is not None and len(cut):
            data, at, kept = own.encode("utf-8", "surrogatepass"), 0, []
            for span in cut:
                kept.append(data[at : span["begin"]])
                at = span["end"]
            own = b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")
        out.append(own)
    return pd.Series(out, dtype=object)


def op12_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS_SQL = r"REGEXP_EXTRACT_ALL(TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP12_SQL = f"""
WITH item AS (SELECT COALESCE(CAST(item_id AS VARCHAR), '') AS item, {_WORDS_SQL} AS w FROM benchmark),
win AS (SELECT DISTINCT item, size, ARRAY_TO_STRING(w[i:i + size - 1], ' ') AS win FROM (SELECT item, w, LEAST(LEN(w), {WINDOW}) AS size, UNNEST(RANGE(1, LEN(w) - LEAST(LEN(w), {WINDOW}) + 2)) AS i FROM item WHERE LEN(w) > 0)),
doc AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM win),
place AS (SELECT r, size, i, ARRAY_TO_STRING(w[i:i + size - 1], ' ') AS win FROM (SELECT r, w, size, UNNEST(RANGE(1, LEN(w) - size + 2)) AS i FROM doc, sizes WHERE LEN(w) >= size)),
met AS (SELECT DISTINCT r, item, i, size FROM place JOIN win USING (size, win)),
hits AS (SELECT r, COUNT(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT r, i, size FROM met), LATERAL (SELECT UNNEST(RANGE(size)) AS k) GROUP BY r),
own AS (SELECT r, COUNT(*) AS n_items, STRING_AGG(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM met) GROUP BY r)
SELECT doc_id, CAST(LEN(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit, CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, SHA256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hits USING (r) LEFT JOIN own USING (r)
"""
