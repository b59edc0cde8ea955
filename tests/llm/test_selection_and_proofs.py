"""Importance resampling, the Merkle manifest and the quality classifier against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import merkle as K
from ledgerlens.llm import quality as Q
from ledgerlens.llm import resample as R
from ledgerlens.llm.common import CHUNK_BYTES

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def runs(text, max_n=1):
    w = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().translate(LOWER))
    return w, [b" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def plain_resample(rows, target, max_n=1, buckets=10_000, percent=10, min_words=20):
    """{position: (id, n_features, weight, score, rank)}; ties of score and id are ranked by position."""
    s, t = Counter(), Counter()
    feats = [runs(x, max_n) for _, x in rows]
    for _, f in feats:
        s.update(zlib.crc32(x) % buckets for x in f)
    for x in target:
        t.update(zlib.crc32(y) % buckets for y in runs(x, max_n)[1])
    n_s, n_t = sum(s.values()), sum(t.values())

    def gain(k):
        return math.floor(1000 * math.log((t[k] + 1) * (n_s + buckets) / ((s[k] + 1) * (n_t + buckets))))
    out = []
    for (i, _), (w, f) in zip(rows, feats):
        weight = sum(gain(zlib.crc32(x) % buckets) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    able = sorted((p for p, r in enumerate(out) if r[5] >= min_words),
                  key=lambda p: (-out[p][3], out[p][0] is None, out[p][0] or 0, p))
    for rank, p in enumerate(able[:len(able) * percent // 100]):
        out[p][4] = rank + 1
    return [tuple(r[:5]) for r in out]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.fixture(scope="module")
def texts(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    long = "tail of WORDS, with 12 numbers; é中文 " * (CHUNK_BYTES // 20)
    odd = [(None, None), (None, "x " * 30), (None, "x " * 30), (900_001, ""), (900_002, long), (900_003, "y" * (2 * CHUNK_BYTES)),
           (900_004, "\x00\x1f -- !!"), (900_005, "A" * 100 + " b" * 30)]
    return rows + odd + [(900_006, "the same words here " * 20)] * 60


@pytest.mark.parametrize("max_n", [1, 3])
def test_resample(spark, sf, texts, max_n):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in texts], "doc_id long, text string, score long, rank long").repartition(5)
    want = plain_resample(texts, [r.text for r in bench.collect()], max_n)
    for percent in (10, 50, 100, 0):
        want = plain_resample(texts, [r.text for r in bench.collect()], max_n, percent=percent)
        got = R.resample(df, bench, max_n=max_n, percent=percent)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert in_order(tuple(r) for r in got.collect()) == in_order(want)
        if max_n > 1:
            break


def test_resample_ties_and_empty(spark):
    kind = "doc_id long, text string"
    same = [(5, "a b c " * 10)] * 37 + [(None, "a b c " * 10)] * 13
    bench = spark.createDataFrame([("a b",), (None,)], "text string")
    got = R.resample(spark.createDataFrame(same, kind).repartition(4), bench, percent=50).collect()
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 26))
    assert in_order(tuple(r) for r in got) == in_order(plain_resample(same, ["a b"], percent=50))
    empty = spark.createDataFrame([], kind)
    assert R.resample(empty, bench).count() == 0
    none = R.resample(spark.createDataFrame([(1, "a " * 25)] * 10, kind), empty.select("text"), percent=10)
    assert [r.rank for r in none.collect()].count(1) == 1
    res = R.resample(spark.createDataFrame([(i, "w " * 25) for i in range(100)], kind), bench)
    assert R.drawn(spark.createDataFrame([(i, "w " * 25) for i in range(100)], kind), res).count() == 10


def test_cutoff_by_counts(spark):
    rng = np.random.default_rng(3)
    for values in ([5], [1, 1, 1], list(range(-50, 50)), rng.integers(-2 ** 62, 2 ** 62, 200).tolist(), rng.integers(0, 5, 300).tolist()):
        df = spark.createDataFrame([(int(v),) for v in values] + [(None,)], "v long")
        s = sorted(int(v) for v in values)
        for need in {1, len(s) // 2 or 1, len(s)}:
            assert R.first_covering(df, "v", need) == (s[need - 1], sum(x < s[need - 1] for x in s))
        assert R.first_covering(df, "v", len(s) + 1) is None and R.first_covering(df, "v", 0) is None


def test_crc_matches_zlib():
    data = np.frombuffer(bytes(range(256)) * 3, dtype=np.uint8)
    s = np.array([0, 5, 5, 100, 0, 7])
    e = np.array([0, 6, 50, 400, 768, 30])
    got = R.extend_crc(np.zeros(6, np.uint32), data, s, e)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(s, e)]
    more = R.extend_crc(got, data, s, e)
    assert more.tolist() == [zlib.crc32(data[a:b].tobytes() * 2) for a, b in zip(s, e)]


# ---------------------------------------------------------------------------------------- manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows, fan=8):
    """rows: (doc_id, source, lang, n_chars, text, shown text) -> rows of the result, in any order."""
    def leaf(r, text):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*r[:4], text)])

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i:i + fan]) for i in range(0, len(levels[-1]), fan)])
        return levels

    def path(levels, pos):
        out = []
        for nodes in levels[:-1]:
            run = pos - pos % fan
            out.append(("".join(nodes[run:pos]), "".join(nodes[pos + 1:run + fan])))
            pos //= fan
        return out
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r, r[4]), leaf(r, r[5]), r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[g])]) for g in names]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(names):
        for pos, (_, _, own, shown, i) in enumerate(sorted(groups[g])):
            steps = path(trees[k], pos) + path(top, k)
            folded = shown
            for a, b in steps:
                folded = sha(a, folded, b)
            out.append((i, own, trees[k][-1][0], top[-1][0], sha(*[a + b for a, b in steps]), folded, folded == top[-1][0]))
    return out


@pytest.mark.parametrize("fan", [8, 2])
def test_manifest(spark, fan):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(5)
    rows = [(int(i), "s", ["a", "a", "a", "b", None, "é"][int(rng.integers(6))], 3, f"Text {i % 7}") for i in rng.permutation(140)]
    rows += [(500, None, "one", None, None), (501, "s", "Ω", 1, ""), (None, "s", "a", 1, "x"), (None, "s", "a", 1, "x"), (7, "s", "a", 1, "Z")]
    rows += [(9, "q", "b", 2, "Twice")] * 3 + [(700 + i, "s", f"l{i:02d}", 1, "t" * 100_000) for i in range(11)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows],
                               "doc_id long, source string, lang string, n_chars int, text string, node string, g int").repartition(4)
    bad = F.pmod(F.coalesce("doc_id", F.lit(1)), F.lit(3)) == 0
    shown = F.when(bad, K.leaf_digest(changed={"text": F.lower("text")})).otherwise(K.leaf_digest())
    got = [tuple(r) for r in K.prove(K.build(df, presented=shown, fanout=fan)).collect()]
    lower = lambda r: r[4].lower() if r[0] is not None and r[0] % 3 == 0 and r[4] is not None else r[4]
    want = plain_manifest([(*r, lower(r)) for r in rows], fan)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 8, 9, 64, 65])
def test_manifest_sizes(spark, n):
    rows = [(i, "s", "x", 1, f"t{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    got = [tuple(r) for r in K.prove(K.build(df)).collect()]
    assert sorted(got) == sorted(plain_manifest([(*r, r[4]) for r in rows]))
    assert all(r[-1] for r in got)


def test_manifest_finds_changed_rows(spark):
    kind = "doc_id long, source string, lang string, n_chars int, text string"
    rows = [(i, "s", "xy"[i % 2], 1, f"t{i}") for i in range(50)]
    other = [r if r[0] != 13 else (13, "s", "y", 1, "changed") for r in rows if r[0] != 20]
    got = K.verify_against(spark.createDataFrame(rows, kind), spark.createDataFrame(other, kind))
    assert sorted(r.doc_id for r in got.collect() if not r.verified) == [13, 20]


# -------------------------------------------------------------------------------------- classifier

def plain_stats(text):
    b = (text or "").encode()
    w = re.findall(rb"[^\x20\x09-\x0D]+", b)
    lines = [x for x in b.split(b"\n") if x]
    letters = [x for x in b if x >= 128 or chr(x).isalpha()]
    signs = lambda x: [c for c in x if not (c >= 128 or chr(c).isalnum() or c in b" \t\n\v\f\r.,;:?'-")]
    share = lambda a, n: a / n if n else 0.0
    size = [len(x) for x in w]
    mean = share(sum(size), len(w))
    low = Counter(x.translate(LOWER) for x in w)
    low_lines = Counter(x.translate(LOWER) for x in lines)
    all_upper = sum(len(y) > 1 and all(65 <= c <= 90 for c in y) for y in ([c for c in x if c >= 128 or chr(c).isalpha()] for x in w))
    return [math.log1p(len(b)), math.log1p(len(w)), math.log1p(len(lines)), math.log1p(mean),
            math.log1p(math.sqrt(max(0.0, share(sum(x * x for x in size), len(w)) - mean ** 2))), math.log1p(share(len(w), len(lines))),
            share(len(letters), len(b)), share(sum(65 <= c <= 90 for c in b), len(letters)), share(sum(48 <= c <= 57 for c in b), len(b)),
            share(sum(c in b" \t\n\v\f\r" for c in b), len(b)), share(sum(c >= 128 for c in b), len(b)), share(len(signs(b)), len(b)),
            share(sum(c in b".,;:?'-" for c in b), len(b)), math.log1p(share(sum(len(signs(x)) for x in w), len(w))),
            share(sum(bool(signs(x)) for x in w), len(w)), share(sum(bool(signs(x[-1:])) for x in w), len(w)),
            share(sum(any(48 <= c <= 57 for c in x) for x in w), len(w)), share(all_upper, len(w)), share(sum(65 <= x[0] <= 90 for x in w), len(w)),
            share(sum(n > 20 for n in size), len(w)), share(len(low), len(w)), share(max(low.values(), default=0), len(w)),
            share(len(low_lines), len(lines)), share(max(low_lines.values(), default=0), len(lines))]


def test_document_stats(texts):
    some = [t for _, t in texts[:80]] + [t for _, t in texts[-68:-58]] + ["one", "A\nA\na\n\nB c!", "same line again\n" * (CHUNK_BYTES // 8), "", None]
    got = Q.stats_matrix(pa.array(some, pa.string()))
    np.testing.assert_allclose(got, np.array([plain_stats(t) for t in some]), rtol=1e-9, atol=1e-9)
    assert Q.stats_matrix(pa.array([], pa.string())).shape == (0, len(Q.STATS))


def test_normal_equations_and_kernel(spark):
    rng = np.random.default_rng(2)
    k = len(Q.STATS)
    rows = [(int(i), rng.normal(size=k).tolist(), int(rng.integers(0, 2)), 1) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, stats array<double>, ones long, n long")
    model = Q.Model(np.zeros(k), np.ones(k), rng.normal(size=(k, 4000)) / np.sqrt(k), rng.uniform(0, 2 * np.pi, 4000),
                    np.zeros(4001), np.zeros(1), np.zeros(1))
    x = np.array([r[1] for r in rows[:40]])
    z = model.features(x)[:, :-1]
    near = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * k))
    assert np.abs(z @ z.T - near).max() < 0.12                       # the features approximate the Gaussian kernel
    model.weights, model.phase = model.weights[:, :20], model.phase[:20]
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    z = model.features(x)
    for tasks in (1, 7):
        a, b, yy = Q.normal_equations(df, model, tasks)
        np.testing.assert_allclose(a.sum(0), z.T @ z, rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose(b.sum(0), z.T @ y, rtol=1e-9, atol=1e-9)
        assert yy.sum() == y.sum()
    beta = Q.ridge(z.T @ z, z.T @ y, 0.5)
    p = np.full(21, 0.5)
    p[-1] = 0
    np.testing.assert_allclose((z.T @ z + np.diag(p)) @ beta, z.T @ y, atol=1e-6)


def test_classifier(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    odd = spark.createDataFrame([(None, None, "en", "s", 0), (10 ** 7, "", "en", "s", 0), (10 ** 7, "", "en", "s", 0)], docs.schema)
    got = Q.classify(docs.unionByName(odd).withColumn("stats", docs.lang).withColumn("score", docs.lang), labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == docs.count() + 3
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (1 if r.score >= 0.3 else 0)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    kept = [(r.score, truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == q for _, q, p in kept) / len(kept) >= 0.97
    auc = np.mean([(a > b) + 0.5 * (a == b) for a, q, _ in kept if q for b, w, _ in kept if not w])
    assert auc >= 0.97
    # labels of held-out rows, lang and source have no influence
    flipped = labels.selectExpr("doc_id", f"CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    again = Q.classify(docs.selectExpr("doc_id", "text", "'x' AS lang"), flipped).collect()
    assert {(r.doc_id, r.score) for r in again} == {(r.doc_id, r.score) for r in rows if r.doc_id is not None and r.doc_id < 10 ** 7}


def test_classifier_without_two_kinds(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)] + [(None, None)], "doc_id long, text string")
    labels = "doc_id long, quality int"
    for marks, want in (([(i, 1) for i in range(20)], 1.0), ([(i, 0) for i in range(20)], 0.0), ([], 0.5), ([(None, 1), (3, None)], 0.5)):
        got = Q.classify(docs, spark.createDataFrame(marks, labels)).collect()
        assert len(got) == 21 and {r.score for r in got} == {want}
    assert Q.classify(docs.limit(0), spark.createDataFrame([(1, 1)], labels)).count() == 0
