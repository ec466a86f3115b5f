"""The corpus operators on awkward small tables, against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanframe.llm import digest, flac, jaccard, language, media, mixing, pieces, quality, repeats, sharding, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, spans string, kept string, n_bytes int, gram string, score string, comp string"
SPACE = " \t\n\x0b\x0c\r"
RNG = random.Random(8)
WORDS = ["alpha", "Beta", "gamma", "délta", "日本", "epsilon", "zeta,", "eta", "theta", "iota", "kappa", "lambda"]


def prose(n):
    return " ".join(RNG.choice(WORDS) + str(RNG.randrange(40)) for _ in range(n))


def make_texts():
    base = [prose(RNG.randrange(30, 120)) for _ in range(12)]
    texts = [None, "", " \t\n", "one", "ONE", "a b c d e", "!!! 123", "\x00 nul", "▁ marks ▁", "🎉" * 40, "x" * 5000, "ab" * 3000, "  spaced   out  \n\n lines\n"]
    for t in base:
        words = t.split(" ")
        texts += [t, t, t.upper(), " ".join(words[:-2] + ["new", "end"]), " ".join(words[:5] + ["mid"] + words[5:]), t + "\n" + base[0][:150]]
    return texts + [prose(20_000)] + [base[1]] * 40


TEXTS = make_texts()


@pytest.fixture(scope="module")
def rows():
    return [(i * 3, t, [None, "en", "fr"][i % 3], ["s1", None, "s0", "hot", "hot"][i % 5], 1, 7, "a", "b", 1, "c", "d", "e") for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return (text or "").encode().translate(bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))).split()


# -- 1 mixing -----------------------------------------------------------------


def test_mixing(docs, rows, nothing):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    size = {r[0]: len((r[1] or "").translate({ord(c): " " for c in SPACE}).split(" ")) - (r[1] or "").translate({ord(c): " " for c in SPACE}).split(" ").count("") for r in rows}
    assert {r.doc_id: r.size for r in got} == size
    held, target, taken, largest = defaultdict(int), {}, defaultdict(int), defaultdict(int)
    for r in got:
        held[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken == r.copies * r.size <= 2 * r.size
    weight = dict(zip(sorted(s for s in held if s) + [None], [3, 1, 2] * 9))
    want, open_, budget = {}, set(held), 1.5 * sum(held.values())
    while open_:  # shares by weight, stopped at twice the source
        share = {s: budget * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * held[s]}
        for s in full or open_:
            want[s] = 2 * held[s] if full else share[s]
            budget -= want[s] if full else 0
        open_ = open_ - full if full else set()
    for s in held:
        assert abs(want[s] - target[s]) < 1e-6
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    assert mixing.mix(nothing).count() == 0


def test_mixing_is_unequal_and_allocates_certain_copies(spark):
    # Half the words are wanted of a source whose texts are short or long: long ones oftener.
    df = spark.createDataFrame([(i, "w " * (200 if i % 2 else 8), "s") for i in range(3000)], "doc_id long, text string, source string")
    got = mixing.mix(df, budget_factor=0.5).groupBy((F.col("size") > 100).alias("long")).agg(F.avg("copies").alias("n"), F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    n = {r.long: r.n for r in got}
    assert 2 * n[False] < n[True] < 1 and abs(sum(r.taken for r in got) - got[0].target) <= 100
    # Near the cap the long ones are certain copies and the short ones fill the rest.
    got = mixing.mix(df, budget_factor=1.9).groupBy((F.col("size") > 100).alias("long")).agg(F.min("copies").alias("lo"), F.max("copies").alias("hi"), F.sum("taken").alias("taken")).collect()
    n = {r.long: (r.lo, r.hi) for r in got}
    assert n[True][0] >= 1 and n[False] != n[True] and abs(sum(r.taken for r in got) - 1.9 * 1500 * 208) <= 100


def test_mixing_repeated_rows_null_ids_and_clashing_names(spark):
    rows = [(None, f"null id {i} " * 5, "s", i) for i in range(200)] + [(7, "the same row again", "s", 0)] * 30 + [(8, None, None, 1), (8, "x y", None, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    got = mixing.mix(df, budget_factor=0.5).collect()
    assert len(got) == len(rows) and abs(sum(r.taken for r in got if r.source == "s") - got[0].target) <= 10
    clash = df.withColumn("_id", F.lit("a")).withColumn("_source", F.lit("b")).withColumn("_copy", F.lit("c")).withColumn("size", F.lit("d"))
    out = mixing.stage_mix(spark, clash, "")
    assert out.columns == clash.columns and {(r["_id"], r["_source"], r["_copy"], r["size"]) for r in out.collect()} == {("a", "b", "c", "d")}


def test_mixing_by_importance(spark):
    df = spark.createDataFrame([(i, "w " * 10, "s", 5.0 if i % 2 else 1.0) for i in range(2000)], "doc_id long, text string, source string, w double")
    got = mixing.mix(df, budget_factor=0.3, importance="w").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("copies").alias("n")).collect()
    n = {r.odd: r.n for r in got}
    assert abs(sum(n.values()) - 600) <= 1 and n[1] > 4 * n[0]


# -- 2 pieces -----------------------------------------------------------------


def test_pieces_equal_the_library(docs, rows, nothing):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    text = {r[0]: r[1] or "" for r in rows}
    ids = {k: library.encode(t) for k, t in text.items()}
    encoded = pieces.encode(docs)
    assert {r.doc_id: r.ids for r in encoded.collect()} == ids
    assert {r.doc_id: r.text for r in pieces.decode(encoded).collect()} == {k: library.decode(v) for k, v in ids.items()}
    assert pieces.digests(nothing).count() == 0


def test_pieces_random_texts():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    model = pieces.PieceModel(pieces.read_model(pieces.default_model()))
    bits = ["a", "aa", "ab", " ", "  ", "the", "\n", "é", "日本", "🎉", "\t", "banana", "<0x41>", "ing", "1", "00", "▁", "\x00"]
    texts = ["".join(RNG.choice(bits) for _ in range(RNG.randrange(60))) for _ in range(3000)]
    flat, counts = model.encode(texts)
    at = np.concatenate([[0], np.cumsum(counts)])
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == library.encode(texts)


# -- 3 language, 5 toxicity, 6 quality ---------------------------------------


def test_language(spark, docs, nothing):
    letters = {"xx": "abcdefg", "yy": "hijklmn", "zz": "àéîöüßç"}
    train = [(i, " ".join("".join(RNG.choice(letters[k]) for _ in range(5)) for _ in range(30)), k) for i in range(240) for k in [sorted(letters)[i % 3]]]
    df = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = language.fit(df, F.col("doc_id") % 4 != 0)
    got = df.where("doc_id % 4 = 0").select("lang", language.predict_column(model).alias("p")).select("lang", "p.*").collect()
    assert all(r.lang == r.lang_pred and 0 <= r.score <= 1 for r in got)
    odd = {r.text: r.p for r in docs.select("text", language.predict_column(model).alias("p")).collect()}
    for text, p in odd.items():
        blank = not any(map(str.isalpha, text or ""))
        assert (p.lang_pred == "und" and p.score == 0 and not p.accepted) if blank else p.lang_pred in letters
    assert language.fit(nothing) is None
    assert {r.p.lang_pred for r in docs.select(language.predict_column(None).alias("p")).collect()} == {"und"}


def labelled(spark, n, name, positive, negative):
    docs = [(i, positive(i) if i % 3 == 0 else negative(i)) for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(n)] + [(None, 1), (5, None)], f"doc_id long, {name} int")
    return spark.createDataFrame(docs, "doc_id long, text string"), labels


def test_toxicity_and_neutral_mentions(spark, docs, nothing):
    # Toxic texts name one group far more often; the swap keeps its name from counting.
    bad = lambda i: f"{prose(20)} vile{'ness' * (i % 2)} {'muslim' if i % 6 else 'christian'} {prose(10)}"
    good = lambda i: f"{prose(30)} {'christian' if i % 4 == 0 else ''}"
    df, labels = labelled(spark, 600, "toxic", bad, good)
    fair = toxicity.fit(df, labels)
    free = toxicity.fit(df, labels, counterfactual=0.0)
    neutral, swapped = "a muslim family alpha3 beta2", "a christian family alpha3 beta2"
    gap = lambda m: abs(m.score(neutral) - m.score(swapped))
    assert gap(fair) < 0.02 < gap(free) and fair.score(neutral) < 0.5
    assert fair.score("such a vile thing") > 0.5 > fair.score("such a fine thing")
    scored = docs.select("text", toxicity.score_column(fair).alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in scored)
    none = toxicity.fit(nothing, labels)
    assert none.score("vile") < 0.5


def test_quality(spark, docs, nothing):
    df, labels = labelled(spark, 400, "quality", lambda i: prose(60), lambda i: " ".join(w + "%%%" for w in prose(60).split()))
    model = quality.fit(df, labels, F.col("doc_id") % 2 == 0)
    got = df.select("doc_id", quality.score_column(model).alias("s")).collect()
    assert all((r.s >= 0.5) == (r.doc_id % 3 == 0) for r in got)
    assert all(0 <= r.s <= 1 for r in docs.select(quality.score_column(model).alias("s")).collect())
    assert quality.fit(nothing, labels).score(np.zeros((1, len(quality.statistics(""))))).tolist() == [0.5]


def test_discriminant_log_density():
    x = np.random.default_rng(1).normal(size=(300, 3))
    y = (x[:, 0] > 0).astype(int)
    model = quality.fit_discriminant(x, y, shrinkage=0.2)
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.9
    c = 1
    cov = np.linalg.inv(model.inverse_factors[c].T @ model.inverse_factors[c])
    assert np.allclose(np.linalg.slogdet(cov)[1], model.log_dets[c])


# -- 4 Jaccard join -----------------------------------------------------------


def brute_components(rows):
    sets = {}
    for r in rows:
        w = words_of(r[1])
        sets[r[0]] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.mark.parametrize("many,hot", [(64, 512), (0, 2)])
def test_jaccard(docs, rows, nothing, monkeypatch, many, hot):
    monkeypatch.setattr(jaccard, "MANY", many)
    monkeypatch.setattr(jaccard, "HOT", hot)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(docs, hub_rounds=2).collect()}
    assert got == brute_components(rows)
    assert jaccard.link_components(nothing).count() == 0


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_jaccard_family_near_the_threshold(spark, monkeypatch, rounds):
    monkeypatch.setattr(jaccard, "MANY", 3)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(RNG.randrange(1, 6)):
            words[RNG.randrange(150)] = f"x{RNG.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(df, hub_rounds=rounds).collect()}
    assert got == brute_components(rows)


def test_jaccard_repeated_rows_null_ids_and_one_id_with_two_texts(spark):
    base = [f"w{i}" for i in range(60)]
    near, far = " ".join([*base[:-1], "other"]), " ".join(f"z{i}" for i in range(30))
    rows = [(7, " ".join(base)), (7, " ".join(base)), (7, far), (9, near), (None, near), (None, far + " end"), (None, None), (3, far + " more"), (None, "alone here"), (None, "alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link_components(df).collect()), key=str)
    want = [(7, 56, 7)] * 2 + [(7, 26, 3), (9, 56, 7), (None, 56, 7), (None, 27, 3), (None, 0, None), (3, 27, 3)] + [(None, 1, None)] * 2
    assert got == sorted(want, key=str)
    kept = jaccard.stage_jaccard(spark, df.withColumn("_key", F.lit("mine")), "")
    assert kept.columns == ["doc_id", "text", "_key"]
    assert sorted((r.text or "" for r in kept.collect())) == sorted([" ".join(base), far + " more", "", "alone here"])


def test_jaccard_equal_blank_texts_stand_alone(spark):
    texts = [" ", " ", "\n\n", "\n\n", " \t\x0b\x0c\r", " \t\x0b\x0c\r", "", "", None, None, "\xa0", "\xa0", "a b", "a b"]
    rows = [(i * 2 + 1, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_components(df).collect()}
    assert got == brute_components(rows)
    kept = jaccard.stage_jaccard(spark, df, "").collect()
    assert len(kept) == len(rows) - 2


# -- 7 sharding ---------------------------------------------------------------


def test_sharding(docs, rows, nothing):
    got = sharding.shard(docs).collect()
    text = {r[0]: r[1] or "" for r in rows}
    slots = defaultdict(list)
    for r in got:
        assert (r.size, r.text_crc32) == (len(text[r.doc_id].encode()) + 1, zlib.crc32(text[r.doc_id].encode()))
        assert 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(nothing).count() == 0


def test_shards_are_even_and_weights_move_only_their_subtree(spark):
    ids = spark.range(8000).select(F.col("id").cast("string").alias("k"))
    tree = sharding.topology(8)
    heavy = [(a, b, s, 3.0 if s == 5 else w) for a, b, s, w in tree]
    got = ids.select(sharding.shard_of(F.col("k"), tree).alias("a"), sharding.shard_of(F.col("k"), sharding.topology(9)).alias("b"), sharding.shard_of(F.col("k"), heavy).alias("c")).collect()
    counts = Counter(r.a for r in got)
    assert min(counts.values()) > 850 and max(counts.values()) < 1150
    assert 700 < sum(r.b == 8 for r in got) < 1080 and all(r.b in (r.a, 8) for r in got)
    # A larger shard 5 takes keys into its region (shards 4 to 7) only.
    assert all(r.c == r.a or r.c in (4, 5, 6, 7) for r in got)
    assert Counter(r.c for r in got)[5] > 2 * counts[5]


# -- 8 repeats ----------------------------------------------------------------


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for key, text in sorted(rows):
        raw = (text or "").encode()
        mark = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                mark[i : i + length] = b"\1" * length
            else:
                seen.add(window)
        out[key] = (bytes(b for b, m in zip(raw, mark) if not m), sum(m and (i == 0 or not mark[i - 1]) for i, m in enumerate(mark)))
    return out


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_repeats(docs, rows, batches, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_SUFFIXES", 500)
    monkeypatch.setattr(repeats, "BLOCK_PIECES", 300)
    monkeypatch.setattr(repeats, "HOT", 3)
    got = {r.doc_id: (bytes(r.kept), len(r.spans or [])) for r in repeats.without_repeats(docs.select("doc_id", "text"), batches=batches).collect()}
    assert got == brute_repeats([r[:2] for r in rows])


def test_repeats_random_and_empty(spark, nothing):
    base = ["".join(RNG.choice("abcé \n") for _ in range(RNG.randrange(700))) for _ in range(20)]
    rows = [(i, "".join(b[slice(*sorted((RNG.randrange(700), RNG.randrange(700))))] for b in RNG.sample(base, 3))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: bytes(r.kept) for r in repeats.without_repeats(df).collect()} == {k: v[0] for k, v in brute_repeats(rows).items()}
    assert repeats.without_repeats(nothing.select("doc_id", "text")).count() == 0


def test_index_levels_merge(spark):
    family = repeats.IndexFamily(spark)
    base = prose(60)
    rows = [(i, f"{base[: 150 + 40 * i]} and {prose(20)} {base}") for i in range(5)]
    for row in rows:
        family.add(spark.createDataFrame([row], "_key long, text string"))
    assert [n for n, _ in family.levels] == [4, 1] and family.merges == 3
    spans = {r["_key"]: [tuple(s) for s in r.spans] for r in family.covered(spark.createDataFrame(rows, "_key long, text string")).collect()}
    family.close()
    kept = {k: b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in spans.get(k, []))], [*(s for s, _ in spans.get(k, [])), len(raw)])) for k, text in rows for raw in [text.encode()]}
    assert kept == {k: v[0] for k, v in brute_repeats(rows).items()}


def test_the_query_merges_levels(spark, docs, monkeypatch):
    seen = []
    close = repeats.IndexFamily.close
    monkeypatch.setattr(repeats.IndexFamily, "close", lambda self: (seen.append((self.merges, [n for n, _ in self.levels])), close(self))[1])
    repeats.without_repeats(docs.select("doc_id", "text"))
    assert seen == [(1, [2, 1])]


def test_repeats_null_and_repeated_ids(spark):
    base, other = prose(40), prose(40)
    rows = [(4, base + " x"), (4, base + " x"), (4, other), (None, base + other), (None, None), (2, other + " first")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(bytes(r.kept) for r in repeats.without_repeats(df).collect())
    # 2 comes first, then the two texts of 4 in either order (they share nothing), then the null id.
    want = {k: v[0] for k, v in brute_repeats([(2, other + " first"), (4.1, base + " x"), (4.2, other), (9, base + other)]).items()}
    assert got == sorted([want[2], want[4.1], want[4.1], want[4.2], want[9], b""])


def test_repeats_stage_keeps_columns(spark, docs, rows):
    out = repeats.stage_repeats(spark, docs, "")
    assert out.columns == docs.columns
    want = {k: v[0].decode("utf-8", "ignore") for k, v in brute_repeats([r[:2] for r in rows]).items()}
    got = {r.doc_id: r.text for r in out.collect()}
    assert all((got[k] or "") == want[k] for k in got) and all(want[k] == "" for k in want.keys() - got.keys())


# -- 9 digest -----------------------------------------------------------------


@pytest.mark.parametrize("size", [10**9, 20_000])
def test_digest(docs, rows, nothing, size):
    got = {r.doc_id: r for r in digest.neighbours(docs, size).collect()}
    order = sorted(((r[0], r[1] or "") for r in rows), reverse=True)
    for i, (key, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        edited = digest.edited_text(text, following)
        r = got[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == digest.fingerprint(text.encode()) and r.edited_fingerprint == digest.fingerprint(edited.encode())
        assert r.near_next == digest.likeness(r.fingerprint, digest.fingerprint(following.encode())) and 0 <= r.near_edited <= 1
    assert len(got) == len(rows) and digest.neighbours(nothing).count() == 0


def test_digest_null_and_repeated_ids(spark):
    rows = [(5, "five five five"), (5, "five five five"), (None, "nothing known"), (None, None), (2, "two"), (9, "nine nine")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for size in (10**6, 5):
        got = digest.neighbours(df, size).collect()
        assert sorted((r.doc_id or -1, r.n_chars) for r in got) == sorted((i or -1, len(t or "")) for i, t in rows)
        nine = next(r for r in got if r.doc_id == 9)
        assert nine.edited_sha256 == hashlib.sha256(digest.edited_text("nine nine", "five five five").encode()).hexdigest()
        assert sorted(r.near_next == 1 for r in got if r.doc_id == 5) == [False, True]


def test_likeness_bounds():
    a, b = digest.fingerprint(b"alpha beta " * 50), digest.fingerprint(RNG.randbytes(3000))
    assert digest.likeness(a, a) == 1 and 0 <= digest.likeness(a, b) < 0.8 and digest.likeness(a, b) == digest.likeness(b, a)
    assert digest.likeness(None, a) == 0 and digest.likeness("", a) == 0


# -- 10 media -----------------------------------------------------------------


def test_media(docs, rows, nothing):
    got = {r.doc_id: r for r in media.media_digests(media.decode_media(media.encode_media(docs))).collect()}
    for r in rows:
        raw = (r[1] or "").encode()
        data = raw + bytes(-len(raw) % 64 if raw else 64)
        g = got[r[0]]
        assert (g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32) == (len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
        assert g.feature == media.block_features(data)
    assert media.media_digests(media.decode_media(media.encode_media(nothing))).count() == 0


def test_flac_round_trip_and_damage():
    payloads = [bytes(64), bytes(range(256)) * 20, RNG.randbytes(200 * 1024), b"\0\xff" * 900, b"abc" * 1000]
    streams = flac.encode(payloads)
    for payload, stream, blocks in zip(payloads, streams, flac.decode(streams)):
        assert b"".join(b for _, _, b in blocks) == payload
        for sample, place, pcm in blocks:  # a reader can start at any block
            assert payload[sample : sample + len(pcm)] == pcm and stream[place : place + 2] == b"\xff\xf8"
    broken = bytearray(streams[1])
    broken[-20] ^= 4
    with pytest.raises(ValueError):
        flac.decode([bytes(broken)])
    plain = streams[2]
    head = flac.Stream(plain)
    unsought = b"fLaC" + bytes([0x80]) + plain[5:42] + plain[head.audio :]  # without its seek table
    assert b"".join(b for _, _, b in flac.decode([unsought])[0]) == payloads[2]


# -- pipeline -----------------------------------------------------------------


def test_pipeline(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, data)
        assert after.columns == docs.columns, name
        before = spark.createDataFrame(after.collect(), docs.schema)
        if name == "near_duplicates":
            found = brute_components([(r.doc_id, r.text) for r in before.collect()])
            assert all(k == c for k, (_, c) in found.items())
    assert before.count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, before, data)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in before.collect())
    assert corpus_pipeline.run(spark, data).count() == before.count()


def test_stages_keep_clashing_columns_null_ids_and_repeated_rows(spark, data):
    import corpus_pipeline

    own = spark.read.parquet(f"{data}/documents.parquet").limit(40).collect()
    rows = [tuple(r) for r in own]
    some = next(r for r in own if r.text and len(r.text) > 400)
    rows += [tuple(some)] * 3 + [(None, some.text, None, None, some.n_chars), (None, None, None, None, None), (own[0].doc_id, "one id, another text " * 9, "en", "src1", 189)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    clash = ("_key", "_score", "_id", "_source", "_mark", "copies", "_copies", "_copy", "spans", "kept", "n_bytes", "size", "mark", "gram", "rep", "component", "_doc", "_hash", "_number")
    for c in clash:
        df = df.withColumn(c, F.lit(f"own {c}"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, data)
        assert out.columns == df.columns, name
        found = out.select(*clash).distinct().collect()
        assert [tuple(r) for r in found] == [tuple(f"own {c}" for c in clash)], name
    last = corpus_pipeline.STAGES[-1][1](spark, df, data)
    assert last.count() == len(rows)
    none = df.where("doc_id < -5")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, data).count() == 0, name
