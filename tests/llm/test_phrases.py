"""Collocations, decontamination and the Merkle manifest on awkward small tables, against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from urbanframe.llm import collocations, decontaminate, merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, _found string, items string, grp string, position int, hash string, level int, chunk int"
MORE = (7, "a", "b", "c", 1, "d", 2, 3)
RNG = random.Random(4)
LIST = ["alpha", "Beta", "gamma", "délta", "日本", "of", "the", "in", "a", "x1"]


def prose(n, stops=" "):
    return "".join(RNG.choice(LIST) + RNG.choice(stops) for _ in range(n))


ITEMS = [(1, prose(25)), (2, "Short item, only five words"), (10, None), (11, ""), (12, prose(10)), (13, "of"), (2, "another text of item two"), (None, prose(14)), (20, prose(40, "  .\n"))]


def make_rows():
    texts = [None, "", " \t\n", "...", "of", "OF", "short ITEM only -- five\nwords", "x" * 5000, "the in. the in; the in! the in? the in, the in: the in\nthe in\rthe in\x0bthe in\x0cthe in", "a\x00b a\x00b"]
    texts += [prose(60, " ,\n\t ") for _ in range(30)] + ["the of in a " * 300] * 3
    for _, item in ITEMS:
        if item:
            texts += [prose(5) + item + " " + prose(5), item.upper() * 2, " ".join(item.split()[:9])]
    texts.append(prose(30_000, "    .") + ITEMS[0][1] + prose(30_000))
    rows = [(i * 5, t, [None, "en", "fr", "en", "en"][i % 5], ["s", None][i % 2], None if i % 7 == 0 else i, *MORE) for i, t in enumerate(texts)]
    return rows + [(None, texts[12], "en", None, 3, *MORE), (None, "other", None, "s", None, *MORE)] + rows[20:22]


ROWS = make_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def key(row):
    return tuple((v is not None, v) if not isinstance(v, list) else (True, str(v)) for v in row)


# -- 11 collocations ----------------------------------------------------------


def brute_phrases(rows, least, longest, top, share=50):
    counts, totals = defaultdict(Counter), Counter()
    for row in rows:
        lang = row[2] or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(row[1])):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        known = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in known.items():
            longer = [b for q, b in known.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= share * a for b in longer):
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least,longest,top,listed,dense", [(10, 3, 2000, 1_000_000, 8192), (4, 3, 50, 6, 1), (3, 4, 2000, 0, 8192), (2, 4, 2000, 40, 100)])
def test_collocations(docs, nothing, monkeypatch, least, longest, top, listed, dense):
    monkeypatch.setattr(collocations, "DENSE", dense)
    monkeypatch.setattr(collocations, "TILE", 4)
    got = collocations.collocations(docs, least=least, longest=longest, top=top, listed=listed)
    assert sorted(map(tuple, got.collect())) == brute_phrases(ROWS, least, longest, top)
    assert collocations.collocations(nothing).count() == 0


def test_tiles_count_all_pairs(monkeypatch):
    monkeypatch.setattr(collocations, "TILE", 8)
    rng = np.random.default_rng(2)
    units = rng.integers(0, 2**63, 50, dtype=np.uint64)
    left, right = (units[np.minimum(rng.geometric(0.2, 5000) - 1, 49)] for _ in "ab")
    want = Counter(zip(left.tolist(), right.tolist()))
    for dense in (1, 100, 10**9):
        monkeypatch.setattr(collocations, "DENSE", dense)
        for a, b in ((50, 50), (9, 50), (9, 3), (0, 0)):
            ranks = [collocations.Ranks(units[:n], n == 50) for n in (a, b)]
            got = Counter()
            for x, y, n in collocations.counted_pairs(left, right, *ranks):
                got.update(dict(zip(zip(x.tolist(), y.tolist()), n.tolist())))
            assert got == want


def test_scores_beyond_64_bits(spark):
    big, schema = 10**12 + 39, "grp string, words array<string>, names array<long>, unit long, n long"
    levels = [spark.createDataFrame(rows, schema) for rows in (
        [("en", [w], [i], i, n) for i, (w, n) in enumerate([("a", 3 * big), ("b", big + 7), ("c", 2 * big)])],
        [("en", ["a", "b"], [0, 1], 10, big), ("en", ["b", "c"], [1, 2], 11, big - 1)],
        [("en", ["a", "b", "c"], [0, 1, 2], 20, big // 3)],
    )]
    (pair, _), (three,) = sorted(collocations._scores(levels, 2).collect()), collocations._scores(levels, 3).collect()
    assert (pair.l, pair.r, pair.score) == (3 * big, big + 7, 10**6 * big * big // (3 * big * (big + 7)))
    cuts = [(10**6 * (big // 3) ** 2 // (x * y), k, x, y) for k, (x, y) in enumerate([(3 * big, big - 1), (big, 2 * big)], 1)]
    assert (three.score, three.k, three.l, three.r) == min(cuts)


# -- 12 decontamination -------------------------------------------------------


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_leaks(rows, items, n=10):
    windows = defaultdict(set)
    for item, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - n + 1) if words else 0):
            windows[tuple(words[i : i + n])].add("" if item is None else str(item))
    out = []
    for row in rows:
        words, hit, met = words_of(row[1]), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (w := tuple(words[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    met |= windows[w]
        out.append((row[0], len(words), len(hit), sorted(met), hit))
    return out


@pytest.mark.parametrize("limit", [1 << 24, 0])
def test_contamination(spark, docs, nothing, limit):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(docs, benchmark, broadcast_bytes=limit).collect()
    want = brute_leaks(ROWS, ITEMS)
    assert sorted((tuple(r[:4]) for r in got), key=key) == sorted((w[:4] for w in want), key=key)
    assert sum(w[2] > 0 for w in want) > 20
    texts = {r[0]: (r[1] or "").encode() for r in ROWS if r[0] is not None}
    hits = {w[0]: w[4] for w in want}
    for r in got:
        if r.doc_id is not None:
            cut = [texts[r.doc_id][s.begin : s.end].decode() for s in r.spans]
            assert sum(len(words_of(c)) for c in cut) == r.n_hit and len(cut) == sum(i - 1 not in hits[r.doc_id] for i in hits[r.doc_id])
    assert decontaminate.contamination(nothing, benchmark, broadcast_bytes=limit).count() == 0
    bare = decontaminate.contamination(docs, benchmark.limit(0)).collect()
    assert len(bare) == len(ROWS) and not any(r.n_hit or r["items"] or r.spans for r in bare)


@pytest.mark.parametrize("limit", [1 << 24, 0])
def test_decontaminate(spark, docs, limit):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    hits = {w[0]: w[4] for w in brute_leaks(ROWS, ITEMS)}
    kept = decontaminate.decontaminate(docs, benchmark, "documents", broadcast_bytes=limit)
    assert kept.dtypes == docs.dtypes
    assert sorted(map(tuple, kept.collect()), key=key) == sorted((r for r, w in zip(ROWS, brute_leaks(ROWS, ITEMS)) if not w[4]), key=key)
    cut = decontaminate.decontaminate(docs, benchmark, "spans", broadcast_bytes=limit)
    assert cut.dtypes == docs.dtypes and cut.count() == len(ROWS)
    whole = {r[0]: r for r in ROWS}
    for r in cut.collect():
        if r.doc_id is None:
            continue
        row, hit = whole[r.doc_id], hits[r.doc_id]
        assert tuple(r[2:]) == row[2:]
        if not hit:
            assert r.text == row[1]
        else:
            assert words_of(r.text) == [w for i, w in enumerate(words_of(row[1])) if i not in hit]
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, benchmark, "pages")


def test_equal_hashes_count_for_nothing(monkeypatch):
    monkeypatch.setattr(decontaminate, "run_hashes", lambda word, n: np.full(max(0, len(word) - n + 1), 5, np.uint64))
    known = decontaminate.WindowSet([("1", "a b c d e f g h i j k"), ("2", "b c d e f g h i j k")], 10)
    assert len(known.code) == 2
    sift = decontaminate._sift(known.code)
    (first, block), = decontaminate.blocks(["z a b c d e f g h i j z", "q r s t u v w x y z"], decontaminate.SEPARATORS)
    assert list(decontaminate._found_in(block, known, sift)) == [(12, 10, ["1"], [(2, 21)]), (10, 0, [], [])]


# -- 13 manifest --------------------------------------------------------------


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, change=0):
    n = None if row[4] is None else row[4] + change
    return h(*map(enc, (row[0], row[3], row[2], n, row[1])))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, p):
    out = []
    for level in levels[:-1]:
        out.append((level[p ^ 1] if p ^ 1 < len(level) else "", (p ^ 1) < p))
        p >>= 1
    return out


def fold(value, path):
    for s, left in path:
        value = h(s, value) if left else h(value, s)
    return value


def brute_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    trees, names = {}, sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: ((r[0] is not None, r[0] or 0), leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for p, row in enumerate(groups[g]):
            path = siblings(trees[g], p) + siblings(top, k)
            tampered = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 7 == 0
            end = fold(leaf(row, int(tampered)), path)
            out.append((row[0], leaf(row), trees[g][-1][0], top[-1][0], h(*[s for s, _ in path]), end, end == top[-1][0]))
    return sorted(out, key=key)


@pytest.mark.parametrize("run", [1, 2, 12])
def test_manifest(docs, nothing, monkeypatch, run):
    manifest = merkle.Manifest
    monkeypatch.setattr(merkle, "Manifest", lambda rows: manifest(rows, run=run))
    got = merkle.audit(docs, merkle.id_fold(7) == 0)
    want = brute_manifest(ROWS)
    assert sorted(map(tuple, got.collect()), key=key) == want
    assert {r[-1] for r in want} == {True, False} and dict(got.dtypes)["doc_id"] == "bigint"
    assert merkle.audit(nothing, merkle.id_fold(7) == 0).count() == 0


def test_manifest_of_one_row_and_of_large_ids(spark, docs):
    one = docs.where("doc_id = 15").withColumn("doc_id", merkle.F.lit(2**62 + 1).cast("bigint"))
    (row,) = merkle.audit(one, merkle.F.lit(False)).collect()
    assert row.doc_id == 2**62 + 1 and row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == h("") and row.verified
    both = one.unionByName(docs.where("doc_id IS NULL"))
    assert {r.doc_id for r in merkle.audit(both, merkle.F.lit(False)).collect()} == {2**62 + 1, None}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 64, 77])
def test_missing_coordinates_are_minimal_and_suffice(n):
    levels = tree([h(str(i)) for i in range(n)])
    for size in {1, min(2, n), n // 2, n} - {0}:
        positions = sorted(RNG.sample(range(n), size))
        asked = merkle.missing_coordinates(np.array(positions), n)
        got = merkle.derived({p: levels[0][p] for p in positions}, {(a, i): levels[a][i] for a, i in asked}, n)
        assert got[-1][0] == levels[-1][0] and len(asked) == len(set(asked))
        # Every node asked for is needed: it is on some proof and no leaf stands below it.
        for a, i in asked:
            assert any(p >> a == i ^ 1 for p in positions) and not any(p >> a == i for p in positions)
        assert all(merkle.folded(levels[0][p], merkle.expanded(p, got)) == levels[-1][0] for p in positions)


def test_proofs_of_some_rows(spark):
    rows = spark.range(100).selectExpr("id AS doc_id", "'en' AS lang", "unhex(sha2(CAST(id AS STRING), 256)) AS hash")
    manifest = merkle.Manifest(rows, run=2, keep_all=True)
    levels = tree([h(str(i)) for i in range(100)])
    some = manifest.proofs(manifest.leaves.where("doc_id % 9 = 4")).collect()
    assert len(some) == 11
    for r in some:
        assert r.root == levels[-1][0] and [(p["hash"], p["left"]) for p in r.proof if p["hash"]] == [s for s in siblings(levels, r.doc_id) if s[0]]
        assert merkle.folded(r.leaf, [(p["hash"], p["left"]) for p in r.proof]) == r.root


# -- 8 repeats: names and failures --------------------------------------------


def test_repeats_stage_and_columns_of_its_own_names(spark):
    from urbanframe.llm import repeats

    text = prose(60)
    rows = [(i, text if i % 2 else prose(40), f"c{i}", f"o{i}", f"s{i}", i) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _cut string, _own_spans string, Spans string, n_bytes int")
    got = {r.doc_id: r for r in repeats.stage_repeats(spark, df, "").collect()}
    assert sorted(got) == [0, 1, 2, 4] and all(tuple(r)[2:] == rows[i][2:] and tuple(r)[1] == rows[i][1] for i, r in got.items())


def test_repeats_leave_no_tables_after_a_failure(spark, monkeypatch):
    from urbanframe.llm import repeats

    def fail(*_):
        raise ValueError("scan failed")

    before = {d.name for d in spark.catalog.listDatabases()}
    monkeypatch.setattr(repeats.IndexFamily, "covered", fail)
    with pytest.raises(ValueError, match="scan failed"):
        repeats.covered(spark.createDataFrame([(1, prose(60)), (2, prose(60))], "_key long, text string"))
    assert {d.name for d in spark.catalog.listDatabases()} == before
