"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Encoding: a text is cut into words that no piece can cross; each distinct word
is encoded once per task and kept in a bounded cache. All new words of a chunk
are encoded together in flat numpy arrays: every round finds the best-ranked
pair of each fragment with a segmented minimum, merges all its leftmost
non-overlapping places at once, and compacts the arrays, until no pair is
left. The library merges one pair at a time; doing a fragment's equal-ranked
places in one round gives the same result unless a merge makes a pair that
ranks no worse than the one being merged. Such fragments are detected and
merge only their leftmost place in that round.

Decoding: bytes of all pieces are gathered with one index array per chunk.

Defined results: a null text encodes as the empty text, which has no ids; white
space, line ends and control characters are kept (the model's normaliser is the
identity); characters without a piece become their UTF-8 bytes' pieces; other
columns are ignored; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanframe.llm.common import documents, small_batches, trimmed

#: Words kept per Python worker, and characters or ids handled at a time.
CACHE_WORDS = 100_000
CHUNK = 200_000
NEVER = np.int64(2**40)
#: Marks a cache key without a space mark; a lone surrogate is in no valid text.
RAW = "\ud800"


def read_model(path: str) -> bytes:
    """A tokenizer file's bytes (about half a megabyte), to be broadcast."""
    with open(path, "rb") as file:
        return file.read()


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of ``[s, s + n)`` for each start and length, one after the other."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


class PieceModel:
    """Tables of one BPE model with byte fallback, and the merge rounds."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only the identity normaliser is supported")
        self.dummy_prefix = proto.normalizer_spec.add_dummy_prefix
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        if any("▁" in piece.lstrip("▁") for piece in normal):
            raise ValueError("pieces that cross words are not supported")
        self.size = len(proto.pieces)
        self.byte_ids = np.zeros(256, np.int64)
        text = [b""] * self.size
        for i, p in enumerate(proto.pieces):
            if p.type == 6:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                text[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == 1:
                text[i] = p.piece.replace("▁", " ").encode()
            elif p.type == 2:
                text[i] = " ⁇ ".encode()
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.text_len = np.array([len(t) for t in text], np.int64)
        self.text_at = np.cumsum(self.text_len) - self.text_len
        order = {s: k for k, s in enumerate(sorted({proto.pieces[i].score for i in normal.values()}, reverse=True))}
        pairs = {}
        bigrams = set()
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = normal.get(piece[:cut]), normal.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (order[proto.pieces[i].score], i)
                bigrams.add((ord(piece[cut - 1]) << 21) | ord(piece[cut]))
        self._fill_pairs(pairs)
        self.bigrams = np.array(sorted(bigrams), np.int64)
        self.char_id = {ord(p): i for p, i in normal.items() if len(p) == 1}
        # A line end that is in no piece always stands alone, so lines can be cut there.
        self.cut_lines = not any("\n" in p for p in normal)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.ids_at = np.zeros(0, np.int64)
        self.ids_len = np.zeros(0, np.int64)

    # -- merge rounds ---------------------------------------------------------

    def _fill_pairs(self, pairs: dict[int, tuple[int, int]]) -> None:
        """A hash table of pair keys with linear probing, in numpy."""
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        keys = np.array(list(pairs), np.int64)
        values = np.array(list(pairs.values()), np.int64).reshape(-1, 2)
        self.slots = np.full(2**bits + 64, -1, np.int64)
        self.slot_rank, self.slot_id = np.full(len(self.slots), NEVER), np.zeros(len(self.slots), np.int64)
        at, left, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            free = left[self.slots[at[left]] == -1]
            self.slots[at[free]] = keys[free]  # of several on one slot the last stays
            settled = self.slots[at[left]] == keys[left]
            won = left[settled]
            self.slot_rank[at[won]], self.slot_id[at[won]] = values[won, 0], values[won, 1]
            left = left[~settled]
            at[left] += 1
            self.probes += 1
        self.slots[self.slots == -1] = -2

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NEVER where it is no piece) and the merged id."""
        key = left * self.size + right
        key[(left < 0) | (right < 0)] = -1
        at = self._slot(key)
        for _ in range(self.probes - 1):
            miss = np.flatnonzero((self.slots[at] != key) & (self.slots[at] != -2))
            if not len(miss):
                break
            at[miss] += 1
        rank = self.slot_rank[at]
        rank[self.slots[at] != key] = NEVER
        return rank, self.slot_id[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word (already with its space marks): flat ids and their counts."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        distinct, inverse = np.unique(points, return_inverse=True)
        sym = np.array([self.char_id.get(p, -1 - p) for p in distinct.tolist()], np.int64)[inverse]
        # A fragment ends where two characters stand together in no piece.
        key = (points[:-1] << 21) | points[1:]
        at = np.minimum(np.searchsorted(self.bigrams, key), len(self.bigrams) - 1)
        joined = (self.bigrams[at] == key) & (word[:-1] == word[1:])
        fragment = np.concatenate([[0], np.cumsum(~joined)]) if len(sym) else np.zeros(0, np.int64)
        place = np.arange(len(sym))
        done_sym, done_place = [], []
        rank = np.full(len(sym), NEVER)
        merged = np.zeros(len(sym), np.int64)
        if len(sym) > 1:
            rank[:-1], merged[:-1] = self._rank(sym[:-1], sym[1:])
            rank[:-1][~joined] = NEVER
        while len(sym):
            start = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
            count = np.diff(np.append(start, len(sym)))
            best = np.repeat(np.minimum.reduceat(rank, start), count)
            live = best < NEVER
            if not live.all():
                done_sym.append(sym[~live])
                done_place.append(place[~live])
                sym, place, fragment, rank, merged, best = (x[live] for x in (sym, place, fragment, rank, merged, best))
                if not len(sym):
                    break
            spots = np.flatnonzero(rank == best)
            new_run = np.concatenate([[True], np.diff(spots) != 1])
            run_start = np.flatnonzero(new_run)
            in_run = np.arange(len(spots)) - np.repeat(run_start, np.diff(np.append(run_start, len(spots))))
            spots = spots[in_run % 2 == 0]
            spots = self._safe(spots, sym, fragment, rank, merged)
            sym[spots] = merged[spots]
            keep = np.ones(len(sym), bool)
            keep[spots + 1] = False
            changed = np.zeros(len(sym), bool)
            changed[spots] = True
            sym, place, fragment, rank, merged, changed = (x[keep] for x in (sym, place, fragment, rank, merged, changed))
            redo = changed.copy()
            redo[:-1] |= changed[1:]
            at = np.flatnonzero(redo)
            last = at == len(sym) - 1
            after = np.minimum(at + 1, len(sym) - 1)
            new_rank, merged[at] = self._rank(sym[at], sym[after])
            new_rank[last | (fragment[at] != fragment[after])] = NEVER
            rank[at] = new_rank
        flat = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int64)
        order = np.argsort(np.concatenate(done_place)) if done_place else np.zeros(0, np.int64)
        place = np.concatenate(done_place)[order] if done_place else np.zeros(0, np.int64)
        return self._fall_back(flat[order], word[place], len(words))

    def _safe(self, spots, sym, fragment, rank, merged):
        """Of fragments with several places, keep only the first where doing all at once could differ."""
        owner = fragment[spots]
        first = np.concatenate([[True], owner[1:] != owner[:-1]])
        several = np.zeros(len(spots), bool)
        several[1:] |= ~first[1:]
        several[:-1] |= ~first[1:]
        at = np.flatnonzero(several)
        if not len(at):
            return spots
        s = spots[at]
        here = rank[s]
        before, after = np.maximum(s - 1, 0), np.minimum(s + 2, len(sym) - 1)
        twin = np.zeros(len(at), bool)  # the place just before was merged in this round too
        prev = np.maximum(at - 1, 0)
        twin[:] = (at > 0) & (spots[prev] == s - 2) & (fragment[spots[prev]] == fragment[s])
        left = np.where(twin, merged[np.maximum(s - 2, 0)], sym[before])
        left_rank = np.where((s > 0) & (fragment[before] == fragment[s]), self._rank(left, merged[s])[0], NEVER)
        right_rank = np.where((s + 2 < len(sym)) & (fragment[after] == fragment[s]), self._rank(merged[s], sym[after])[0], NEVER)
        clash = np.unique(fragment[s][(left_rank <= here) | (right_rank <= here)])
        return spots[first | ~np.isin(owner, clash)] if len(clash) else spots

    def _fall_back(self, sym, word, n):
        """Characters without a piece become the pieces of their bytes."""
        odd = sym < 0
        if odd.any():
            coded = [chr(-1 - p).encode("utf-8", "surrogatepass") for p in sym[odd].tolist()]
            times = np.ones(len(sym), np.int64)
            times[odd] = [len(c) for c in coded]
            sym, word = np.repeat(sym, times), np.repeat(word, times)
            sym[sym < 0] = self.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
        return sym.astype(np.int32), np.bincount(word, minlength=n)

    # -- texts ----------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """Cache keys of a text's words. A key that starts with a space is the word as
        it stands, one that starts with a line end has no space mark, any other has one."""
        if not text:
            return []
        text = text.replace("▁", " ")
        spread = text.replace("\n", " \n") if self.cut_lines else text
        if not self.dummy_prefix or spread[0] == " " or spread[-1] == " " or "  " in spread:
            return [w if w[0] == " " else RAW + w for w in re.findall(" *[^ ]+| +", " " * self.dummy_prefix + text)]
        return spread.split(" ")

    @staticmethod
    def _marked(key: str, cut_lines: bool) -> str:
        if key[0] == RAW:
            return key[1:]
        if key[0] == " ":
            return key.replace(" ", "▁")
        return key if cut_lines and key[0] == "\n" else "▁" + key

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each."""
        keys: list[str] = []
        counts = []
        for text in texts:
            own = self.words(text)
            counts.append(len(own))
            keys += own
        new = list(set(keys).difference(self.known))
        if new and len(self.known) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(set(keys))
        if new:
            ids, lengths = self.merge([self._marked(k, self.cut_lines) for k in new])
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.ids_at = np.concatenate([self.ids_at, len(self.ids) + np.cumsum(lengths) - lengths])
            self.ids_len = np.concatenate([self.ids_len, lengths])
            self.ids = np.concatenate([self.ids, ids])
        index = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        lengths = self.ids_len[index]
        flat = self.ids[ragged(self.ids_at[index], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        return flat, np.diff(ends[at])

    def decode(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of lists of ids that stand one after the other in ``flat``."""
        lengths = self.text_len[flat]
        raw = self.text[ragged(self.text_at[flat], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])
        at = ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)].tolist()
        drop = b" " if self.dummy_prefix else b""
        return [_text(raw[a:b].removeprefix(drop)) for a, b in zip(at, at[1:])]


def _text(raw: bytes) -> str:
    """UTF-8 to text; each byte that is part of no character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            n = 1 if raw[i] < 0x80 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
            try:
                out.append(raw[i : i + n].decode())
                i += n
            except UnicodeDecodeError:
                out.append("�")
                i += 1
        return "".join(out)


_MODELS: dict[int, PieceModel] = {}


def _model(data: bytes) -> PieceModel:
    """The tables, built once per Python worker."""
    key = hash(data)
    if key not in _MODELS:
        _MODELS[key] = PieceModel(data)
    return _MODELS[key]


def _chunks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``limit``; one row at least."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, model_path: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, ids``: the ids of each whole text, as the library's ``encode`` gives them."""
    small_batches(docs.sparkSession)
    data = docs.sparkSession.sparkContext.broadcast(read_model(model_path or default_model()))
    key_type = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(data.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _chunks([len(t) for t in texts], CHUNK):
                flat, counts = model.encode(texts[a:b])
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], names=["key", "ids"])

    out = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(trimmed(run), f"key {key_type}, ids array<int>")
    return out.withColumnRenamed("key", key)


def decode(encoded: DataFrame, model_path: str | None = None, key: str = "doc_id") -> DataFrame:
    """Adds ``text``, the decoded text of ``ids``; null ids decode as the empty text."""
    small_batches(encoded.sparkSession)
    data = encoded.sparkSession.sparkContext.broadcast(read_model(model_path or default_model()))
    key_type = encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(data.value)
        for batch in batches:
            ids = batch.column(1)
            counts = np.asarray(ids.value_lengths().fill_null(0))
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(counts)])
            for a, b in _chunks(counts.tolist(), CHUNK // 2):
                texts = model.decode(flat[at[a] : at[b]], counts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids.slice(a, b - a), pa.array(texts, pa.string())], names=["key", "ids", "text"])

    out = encoded.select(F.col(key).alias("key"), F.col("ids")).mapInArrow(trimmed(run), f"key {key_type}, ids array<int>, text string")
    return out.withColumnRenamed("key", key)


def digests(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """Encode, decode and reduce both to digests: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    One worker does all three for a part of the texts, so ids and decoded texts
    do not leave it.
    """
    small_batches(docs.sparkSession)
    data = docs.sparkSession.sparkContext.broadcast(read_model(model_path or default_model()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(data.value)
        decimal = [b"%d" % i for i in range(model.size)]
        try:
            for batch in batches:
                texts = [t or "" for t in batch.column(1).to_pylist()]
                ids_hash: list[str] = []
                text_hash: list[str] = []
                tokens: list[int] = []
                for a, b in _chunks([len(t) for t in texts], CHUNK):
                    flat, counts = model.encode(texts[a:b])
                    text_hash += [sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in model.decode(flat, counts)]
                    written = list(map(decimal.__getitem__, flat.tolist()))
                    at = np.concatenate([[0], np.cumsum(counts)]).tolist()
                    ids_hash += [sha256(b",".join(written[x:y])).hexdigest() for x, y in zip(at, at[1:])]
                    tokens += counts.tolist()
                columns = [batch.column(0), pa.array(tokens, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            model.clear()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(trimmed(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))


def stage_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digests(docs)
