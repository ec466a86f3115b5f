"""The registered corpus queries against their contracts, and models against brute force."""

import hashlib
import math
import zlib

import duckdb
import numpy as np
import pytest

from urbanframe.llm import flac, language, quality, sharding, toxicity
from urbanframe.llm.common import documents, id_fold, labels
from urbanframe.llm.queries import oracle_sql, queries

COLUMNS = {
    "op1_mix": {"size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op2_pieces": {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op3_language": {"held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_jaccard": {"n_shingles": "bigint", "component_id": "bigint"},
    "op5_toxicity": {"held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_quality": {"held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_shard": {"size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op8_repeats": {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op9_digest": {"n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op10_media": {"n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string"},
    "op12_leaks": {"n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op13_manifest": {"leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
}
FOLDS = {"op3_language": (4, 2), "op5_toxicity": (5, 0), "op6_quality": (3, 1)}


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql(spark, data, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    want = con.execute(oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries()[name](spark, data)
    assert sorted(got.columns) == sorted(columns)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    assert sorted(tuple(map(plain, r)) for r in got.select(*columns).collect()) == sorted(tuple(map(plain, r)) for r in want.fetchall())


def crc(text):
    return zlib.crc32((text or "").encode())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract(spark, data, name):
    docs = {r.doc_id: r.text or "" for r in documents(spark, data).collect()}
    found = queries()[name](spark, data)
    kinds = dict(found.dtypes)
    assert all(kinds[c] == t for c, t in COLUMNS[name].items()) and kinds["doc_id"] == "bigint"
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    if name in FOLDS:
        folds, kept = FOLDS[name]
        assert all(r.held_out == (crc(str(r.doc_id)) % folds == kept) and 0 <= r.score <= 1 for r in rows)
        assert name == "op3_language" or all(r.predicted == int(r.score >= 0.5) for r in rows)
    if name == "op2_pieces":
        import sentencepiece

        from urbanframe.llm.pieces import default_model

        library = sentencepiece.SentencePieceProcessor(model_file=default_model())
        for r in rows:
            ids = library.encode(docs[r.doc_id])
            assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
            assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    if name == "op7_shard":
        for r in rows:
            assert (r.law, r.size, r.text_crc32) == ("key", len(docs[r.doc_id].encode()) + 1, crc(docs[r.doc_id]))
            assert (r.shard, r.grown_shard) == (plain_shard(str(r.doc_id), 8), plain_shard(str(r.doc_id), 9))


def plain_shard(key, shards):
    """The tree's descent in plain Python."""

    def cost(name, weight):
        bits = int(hashlib.md5(f"shard:{name}:{key}".encode()).hexdigest()[:13], 16)
        return -math.log((bits + 0.5) / 2**52) / weight

    tree = sharding.topology(shards)
    for level in (0, 1):
        weights = {}
        for leaf in tree:
            weights[leaf[level]] = weights.get(leaf[level], 0) + leaf[3]
        if len(weights) > 1:
            best = min(weights, key=lambda n: cost(n, weights[n]))
            tree = [leaf for leaf in tree if leaf[level] == best]
    return min(tree, key=lambda leaf: cost(f"shard{leaf[2]}", leaf[3]))[2] if len(tree) > 1 else tree[0][2]


# -- scores from the fitted models, computed another way ------------------------


def test_language_scores(spark, data):
    docs = documents(spark, data)
    model = language.fit(docs, id_fold(4) != 2)
    got = docs.select("text", "lang", (id_fold(4) == 2).alias("out"), language.predict_column(model).alias("p")).collect()
    for r in got[:60]:
        if not any(map(str.isalpha, r.text or "")):
            assert r.p.lang_pred == "und"
            continue
        logit = model.bias.astype(float).copy()
        counts = language.subword_counts(r.text)
        for bucket in np.flatnonzero(counts):
            logit += counts[bucket] / counts.sum() * (model.embedding[bucket].astype(float) @ model.weights.astype(float))
        p = np.exp(logit / model.temperature - (logit / model.temperature).max())
        assert r.p.lang_pred == model.languages[int(p.argmax())] and abs(r.p.score - p.max() / p.sum()) < 1e-3
    known = [r for r in got if r.out and r.lang and r.p.lang_pred != "und"]
    assert sum(r.p.lang_pred == r.lang for r in known) >= 0.95 * len(known)


def test_quality_scores(spark, data):
    docs = documents(spark, data)
    model = quality.fit(docs, labels(spark, data), quality.learnable())
    covariances = [np.linalg.inv(f.T @ f) for f in model.inverse_factors]
    for r in docs.select("text", quality.score_column(model).alias("s")).limit(60).collect():
        x = np.array(quality.statistics(r.text))
        density = [-0.5 * ((x - m) @ np.linalg.solve(c, x - m) + np.linalg.slogdet(c)[1]) for m, c in zip(model.means, covariances)]
        odds = model.prior + (density[1] - density[0]) / model.temperature
        assert abs(r.s - 1 / (1 + math.exp(-max(-40, min(40, odds))))) < 1e-6


def test_toxicity_scores_and_pairs(spark, data):
    docs, known = documents(spark, data), labels(spark, data)
    model = toxicity.fit(docs, known, id_fold(5) != 0)
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist()))
    for r in docs.select("text", toxicity.score_column(model).alias("s")).limit(60).collect():
        held = {h for w in toxicity.WORD.findall((r.text or "").lower()) for h in toxicity.word_features(w)}
        odds = model.bias + sum(weight.get(h, 0.0) for h in held)
        assert abs(r.s - 1 / (1 + math.exp(-max(-40, min(40, odds))))) < 1e-9


def test_toxicity_learns_exchangeable_terms(spark):
    # "zorb" is over-represented in toxic texts, though most mentions are harmless.
    # The toxic texts without "vile" all hold it, so a classifier that is free to leans on it.
    rows = [(i, f"{'vile ' * (i % 8 == 0)}{'zorb ' * (i % 8 == 4 or i % 4 == 1)}{'plum ' * (i % 3 == 0)}word{i % 7} again") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(1200)], "doc_id long, toxic int")
    before = toxicity.HARMLESS
    try:
        toxicity.HARMLESS = 0.6
        fair = toxicity.fit(df, known)
        free = toxicity.fit(df, known, counterfactual=0.0)
    finally:
        toxicity.HARMLESS = before
    assert fair.terms == (("zorb", "plum"),) and fair.pairs == 450
    gap = lambda m: abs(m.score("zorb word1 again") - m.score(f"{dict(m.terms)['zorb']} word1 again"))
    assert gap(fair) < 0.5 * gap(free) and gap(free) > 0.1 and fair.score("vile word1") > 0.5 > fair.score("zorb word1 again")
    report = toxicity.mention_report(df, known, fair).first()
    assert report.texts > 0 and report.false_positives == 0


# -- an independent reader of the stored streams --------------------------------


class Reader:
    """A FLAC reader that takes one bit after the other, as the format's text describes it."""

    def __init__(self, data):
        self.data, self.at = data, 0

    def bits(self, n):
        value = 0
        for _ in range(n):
            value = value << 1 | (self.data[self.at >> 3] >> (7 - (self.at & 7)) & 1)
            self.at += 1
        return value

    def signed(self, n):
        value = self.bits(n)
        return value - (1 << n) if n and value >> (n - 1) else value

    def unary(self):
        n = 0
        while not self.bits(1):
            n += 1
        return n

    def residual(self, size, order):
        width = 4 if self.bits(2) == 0 else 5
        parts = 1 << self.bits(4)
        out = []
        for p in range(parts):
            k = self.bits(width)
            n = size // parts - (order if p == 0 else 0)
            if k == (1 << width) - 1:
                raw = self.bits(5)
                out += [self.signed(raw) for _ in range(n)]
                continue
            for _ in range(n):
                folded = self.unary() << k
                folded |= self.bits(k)
                out.append(folded >> 1 if folded % 2 == 0 else -(folded + 1) >> 1)
        return out

    def frame(self, block):
        begin = self.at >> 3
        assert self.bits(15) == 0x7FFC
        self.bits(1)
        size_code, rate_code, channel, depth, zero = self.bits(4), self.bits(4), self.bits(4), self.bits(3), self.bits(1)
        assert (channel, zero) == (0, 0) and depth in (0, 1)
        lead = self.bits(8)
        for _ in range(0 if lead < 0x80 else 6 - (0xFF ^ lead).bit_length()):
            assert self.bits(2) == 2
            self.bits(6)
        size = self.bits(8) + 1 if size_code == 6 else self.bits(16) + 1 if size_code == 7 else block
        self.bits({12: 8, 13: 16, 14: 16}.get(rate_code, 0))
        c = 0
        for byte in self.data[begin : self.at >> 3]:
            for i in range(7, -1, -1):
                c = ((c << 1) ^ (0x07 if (c >> 7 & 1) ^ (byte >> i & 1) else 0)) & 0xFF
        assert self.bits(8) == c
        assert self.bits(1) == 0
        kind, wasted = self.bits(6), self.bits(1)
        assert not wasted
        if kind == 0:
            out = [self.signed(8)] * size
        elif kind == 1:
            out = [self.signed(8) for _ in range(size)]
        else:
            order = kind - 31 if kind >= 32 else kind - 8
            out = [self.signed(8) for _ in range(order)]
            shift, weights = 0, ([], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1])[order if kind < 32 else 0]
            if kind >= 32:
                precision = self.bits(4) + 1
                shift = self.signed(5)
                weights = [self.signed(precision) for _ in range(order)]
            for r in self.residual(size, order):
                out.append(r + (sum(w * out[-1 - j] for j, w in enumerate(weights)) >> shift))
        self.at = -(-self.at // 8) * 8
        c = 0
        for byte in self.data[begin : self.at >> 3]:
            for i in range(7, -1, -1):
                c = ((c << 1) ^ (0x8005 if (c >> 15 & 1) ^ (byte >> i & 1) else 0)) & 0xFFFF
        assert self.bits(16) == c
        return out

    def stream(self):
        assert bytes(self.bits(8) for _ in range(4)) == b"fLaC"
        last = 0
        while not last:
            last, kind, size = self.bits(1), self.bits(7), self.bits(24)
            end = self.at + 8 * size
            if kind == 0:
                block = self.bits(16)
                self.bits(16 + 24 + 24 + 20)
                assert self.bits(3) == 0 and self.bits(5) == 7
                samples = self.bits(36)
            self.at = end
        out = []
        while len(out) < samples:
            out += self.frame(block)
        assert len(out) == samples and self.at == 8 * len(self.data)
        return bytes(s + 128 for s in out)


def test_another_reader_reads_the_streams():
    draw = np.random.default_rng(2)
    payloads = [bytes(64), b"plain words and more of them, " * 90, bytes(range(256)) * 9, draw.integers(0, 256, 2500, dtype=np.uint8).tobytes(), np.clip(128 + 60 * np.sin(np.arange(3000) / 9), 0, 255).astype(np.uint8).tobytes()]
    assert [Reader(s).stream() for s in flac.encode(payloads)] == payloads
