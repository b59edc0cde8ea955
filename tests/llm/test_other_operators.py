"""Token counts, WARC bundles, mixing, Hamming search, licences, languages and decontamination."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from ledgerlens.llm import decontaminate as D  # noqa: E402
from ledgerlens.llm import hamming as H  # noqa: E402
from ledgerlens.llm import language as L  # noqa: E402
from ledgerlens.llm import licenses as LI  # noqa: E402
from ledgerlens.llm import mixing as M  # noqa: E402
from ledgerlens.llm import token_counts as T  # noqa: E402
from ledgerlens.llm import warc as A  # noqa: E402


def test_token_counts(spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rng = random.Random(1)
    signs = ["'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "a", "é", "1", "²", "!", "_", " ", "中", "😀", "''", "\r\n"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [None, "", "a<|endoftext|>b <|endoftext|>", "x" * 5000, "word " * 100_000, "it's we'll they've 'S"]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, id long")
    want = [len(e) for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for more in ({}, {"table_rows": 3, "cache_rows": 10}):
        got = {r.doc_id: r for r in T.count_tokens(df, path, **more).collect()}
        for i, t in enumerate(texts):
            assert (got[i].n_tokens, got[i].n_bytes) == (want[i], len((t or "").encode())), repr(t)[:80]
            assert got[i].over_limit == (want[i] > 512)
    assert T.count_tokens(spark.createDataFrame([], df.schema), path).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big = "y" * 300
    pages = [(1, "http://a/ü x\n", "<p>é</p>"), (5, "u5", big), (3, None, big), (3, "u3", big), (None, "n", big), (8, "u8", None),
             (9, "u9", ""), (10, "u10", "short"), (11, "u11", "short"), (12, "u12", "z" * 3_000_000), (13, "u13", "é" * 50),
             (14, "u14", "é" * 50), (None, "m", "w" * 200), (None, "m", "w" * 200), (15, "u", "WARC/1.1\r\n\r\n" * 30)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string").repartition(3)
    folder = f"file://{tmp_path}/bundles"
    index = A.write_bundles(df, folder, frame_bytes=1000)
    back = A.read_bundles(index, folder).collect()
    groups = {}
    for p, _, h in pages:
        if p is not None:
            groups[h or ""] = min(p, groups.get(h or "", p))
    want = []
    for p, _, h in pages:
        b = (h or "").encode()
        first = groups.get(h or "")
        later = len(b) >= 100 and first is not None and p != first
        want.append((p or -1, len(b), brute.sha(b), "revisit" if later else "response", first if later else None))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=key) \
        == sorted(want, key=key)
    for r in back:
        assert (r.payload is None) == (r.record_type == "revisit")
    ids = [r.record_id for r in index.collect()]
    assert len(set(ids)) == len(ids) == len(pages)                         # also of repeated rows and null ids
    heads = {}
    for e in index.collect():
        with open(tmp_path / "bundles" / e.bundle, "rb") as f:
            f.seek(e.frame_offset)
            data = __import__("zstandard").ZstdDecompressor().decompress(f.read(e.frame_bytes))
        _, head, _ = next(A.parse_records(data[e.record_offset:e.record_offset + e.record_bytes]))
        assert head["WARC-Record-ID"] == e.record_id
        heads[e.record_id] = head
    told = [h for h in heads.values() if "WARC-Refers-To" in h]
    assert {heads[h["WARC-Refers-To"]]["WARC-Type"] for h in told} == {"response"}
    assert all(heads[h["WARC-Refers-To"]]["Page-ID"] == h["Refers-To-Page-ID"] for h in told)
    # page 3 comes twice with one payload: its revisits name the page alone
    assert {h["Refers-To-Page-ID"] for h in heads.values() if h["WARC-Type"] == "revisit" and h not in told} == {"3"}
    entry = index.where("page_id = 12").first().asDict()
    assert A.read_record(folder, entry)["payload"] == b"z" * 3_000_000
    import zstandard
    raw = next((tmp_path / "bundles").glob("*.zst")).read_bytes()          # also readable front to back
    assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read().startswith(b"WARC/1.1")
    none = A.write_bundles(spark.createDataFrame([], df.schema), f"file://{tmp_path}/none")
    assert none.count() == 0 and A.read_bundles(none, f"file://{tmp_path}/none").count() == 0


def test_mix(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "b", "b", "b", "c", "é", None]), " ".join(["w"] * rng.randint(0, 30))) for i in range(300)]
    rows += [(301, "tiny", "one"), (302, "zero", ""), (303, "zero", None), (None, "a", "x y"), (7, "b", "again here"), (7, "b", "again here")]
    df = spark.createDataFrame([(*r, 5, 1) for r in rows], "doc_id long, source string, text string, size long, key int").repartition(4)
    got = sorted((r.doc_id or -1, r.size, r.source_size, round(r.target, 6), r.taken) for r in M.mix_sources(df).collect())
    want = sorted((i or -1, n, s, round(t, 6), k) for i, n, s, t, k in brute.mix(rows))
    assert got == want
    assert all(r[4] <= 3 * r[1] for r in got)
    again = sorted((r.doc_id or -1, r.size, r.source_size, round(r.target, 6), r.taken) for r in M.mix_sources(df.repartition(2)).collect())
    assert again == got
    assert M.mix_sources(spark.createDataFrame([], df.schema)).count() == 0
    blank = spark.createDataFrame([(1, None, None, 0, 0)], df.schema)
    assert [(r.taken, r.target) for r in M.mix_sources(blank).collect()] == [(0, 0.0)]


@pytest.mark.parametrize("dims", [24, 70])
def test_hamming(spark, dims):
    rng = np.random.default_rng(dims)
    v = rng.normal(size=(250, dims)).astype(np.float32)
    v[40:90] = v[3]                                               # copies
    v[90:100] = v[5] * np.where(rng.random((10, dims)) < 0.05, -1, 1)
    rows = [(i, [float(y) for y in x], 0) for i, x in enumerate(v)] + [(900, None, 0), (None, [1.0] * dims, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, distance int")
    q = df.where("vec_id % 25 = 0 or vec_id = 3")
    bit = v > 0
    want = set()
    for i in [*range(0, 250, 25), 3]:
        d = (bit != bit[i]).sum(axis=1)
        near = sorted((int(d[j]), j) for j in range(250) if j != i)[:7]
        want |= {(i, k + 1, j, x) for k, (x, j) in enumerate(near)}
    assert {tuple(r) for r in H.top_k(df, q, k=7).collect()} == want
    few = df.where("vec_id < 4")
    assert H.top_k(few, few, k=7).count() == 12
    assert H.top_k(df.limit(0), df.limit(0), k=7).count() == 0


def test_hamming_probes_stay_off_the_driver(spark):
    parts = H.segment_exprs(64, 16)
    asked = spark.createDataFrame([([7], 64), ([9], 9), ([11], 7)], "q array<long>, bound int")
    n = {(r.bound, r.seg): r["count"] for r in H.probes(asked, parts, 2).groupBy("bound", "seg").count().collect()}
    assert n == {(64, 0): 120, (64, 1): 120, (64, 2): 120, (64, 3): 120, (9, 0): 120, (9, 1): 120}   # 9 = 4 * 2 + 1
    index = spark.createDataFrame([(0, 7, [7])], "seg int, value long, code array<long>")
    plan = H.meet(H.probes(asked, parts, 2), index, parts, 1)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_licenses(spark):
    mit = LI.TEMPLATES["mit-text"]
    texts = [None, "", "word", "Released under the MIT License.", "x\nRELEASED under the MIT-licence... License\ny",
             "All rights reserved.", "some words\nAll Rights Reserved\nmore words all", mit, "head " + mit + " tail", mit.replace("Software", "Program"),
             "Licensed under CC BY-NC 4.0.\nAll rights reserved.", "licensed under nothing at all", "a b " * 5000, "All rights reserved.\nAll rights reserved."]
    import textwrap
    full = [LI.TEMPLATES[k] for k in ("mit-full", "bsd-2-clause-full", "bsd-3-clause-full", "isc-full")]
    n_plain = len(texts)
    texts += [f"#!/bin/sh\n\n{'# ' if k % 2 else ''}" + textwrap.fill(t, 50 + 20 * (k % 2)).replace("\n", "\n# " if k % 2 else "\n\n") + "\n\nint main(void) { return 0; }\n" * 9
              for k, t in enumerate(full)]
    rng = random.Random(6)
    texts += ["\n".join(" ".join(rng.choice(mit.split()[:40] + ["x", "y"]) for _ in range(rng.randint(0, 6))) for _ in range(30)),
              "\n".join(mit.split()), ("Released under\nthe MIT License\n" * 12), "\n \n", "the software " * 200 + "\n" + textwrap.fill(full[0], 30)]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    got = {r.doc_id: r for r in LI.scan_licenses(df).collect()}
    import re
    for i, t in enumerate(texts):
        flat = re.sub(r"(?:[^\w\n]|_)+", " ", (t or "").translate(str.maketrans(LI.UPPER, LI.LOWER)))
        lines = [u.strip() for u in flat.split("\n") if u.strip()]
        units = {" ".join(lines[a:b]) for a in range(len(lines)) for b in range(a + 1, len(lines) + 1)}
        best, n = [], 0
        for u in units:
            bag, scores = LI.template_bigrams(u), []
            for name, text in LI.TEMPLATES.items():
                b = LI.template_bigrams(text)
                k = sum(bag.values())
                if k:
                    shared = sum((bag & b).values())
                    scores.append((shared, 2 * shared / (k + sum(b.values())), name))
            ok = [s for s in scores if s[1] >= 0.8]
            n += bool(ok)
            best += ok
        top = max((s[:2] for s in best), default=None)
        assert got[i].n_units == n and (got[i].score is None if top is None else abs(got[i].score - top[1]) < 1e-12)
        assert got[i].license == (None if top is None else min(s[2] for s in best if s[:2] == top))
    assert got[3].license == "mit" and got[9].license == "mit-text" and got[12].license is None
    assert [got[n_plain + k].license for k in range(4)] == ["mit-full", "bsd-2-clause-full", "bsd-3-clause-full", "isc-full"]
    assert all(got[n_plain + k].score > 0.95 for k in (0, 2))
    assert LI.scan_licenses(df.limit(0)).count() == 0


def test_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("held", L.held_out("doc_id"))
    model = L.train(docs.where("not held"))
    found = L.identify(docs.where("held"), model).collect()
    assert np.mean([r.lang_pred == r.lang for r in found if r.lang]) >= 0.95
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "12 !? 4", "c"), (4, "q", "d"), (5, "the " * 50_000, "e"),
                                 (5, "the " * 50_000, "e")], "doc_id long, text string, lang_pred string")
    got = [(r.lang_pred, r.score) for r in L.identify(odd, model).orderBy("doc_id").collect()]
    assert got[:3] == [("und", 0.0)] * 3 and all(p in model.languages and 0 <= s <= 1 for p, s in got[3:]) and got[4] == got[5]
    assert L.identify(odd.limit(0), model).count() == 0
    nothing = L.train(docs.limit(0))
    assert {r.lang_pred for r in L.identify(odd, nothing).collect()} == {"und"}


def test_language_mixture(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = L.train(docs)
    text = {r.lang: r.text for r in docs.where("n_chars between 1500 and 4000").collect()}
    a, b = sorted(text)[:2]
    chosen, share = L.mixture(model, text[a][:1200] + "\n" + text[b][:1200])
    assert {model.languages[i] for i in chosen} == {a, b} and abs(share.sum() - 1) < 1e-6
    chosen, _ = L.mixture(model, text[a])
    assert [model.languages[i] for i in chosen] == [a]


def plain_em(p, counts, rounds):
    """Proportions by single draws: responsibilities of every trigram, averaged."""
    k = len(p)
    pi = [1 / k] * k
    for _ in range(rounds):
        new, n = [0.0] * k, 0
        for g, c in counts.items():
            whole = sum(pi[i] * p[i][g] for i in range(k))
            for i in range(k):
                new[i] += c * pi[i] * p[i][g] / whole
            n += c
        new = [x / n for x in new]
        if max(abs(a - b) for a, b in zip(pi, new)) < 1e-4:
            return new
        pi = new
    return pi


def test_selected_languages_decide(spark, sf):
    from collections import Counter
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = L.train(docs)
    text = {r.lang: r.text for r in docs.where("n_chars between 1500 and 4000").collect()}
    langs = sorted(text)
    for mixed in (text[langs[0]], text[langs[1]][:900] + "\n" + text[langs[2]][:300], text[langs[2]][:200] + text[langs[0]][:800]):
        chosen, share, fit, n = L.explain(model, mixed)
        counts = Counter(L.trigrams(mixed).tolist())
        p = np.exp(model.log_p)
        plain = plain_em([p[i] for i in chosen], counts, 30)
        assert np.allclose(share, plain, atol=2e-3) and list(share) == sorted(share, reverse=True) and abs(share.sum() - 1) < 1e-9
        ll = lambda some, pi: sum(c * np.log(sum(w * p[i][g] for w, i in zip(pi, some))) for g, c in counts.items())
        assert n == sum(counts.values()) and abs(fit - (ll(chosen, share) / n + np.log(p.shape[1]))) < 1e-6
        # no further language gains what it costs, and the chosen ones do
        cost = 8 * np.log(n + 1) / 2
        full = plain_em(list(p), counts, 30)
        rest = [i for i in np.lexsort((np.arange(len(p)), -np.array(full))) if i not in chosen][:1]
        for i in rest:
            more = plain_em([p[j] for j in [*chosen, i]], counts, 30)
            assert ll([*chosen, i], more) - ll(chosen, plain) <= cost + 1e-3
        if len(chosen) > 1:
            assert ll(chosen, plain) - ll(chosen[:1], [1.0]) > cost - 1e-3
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice("qxzwvkjbpg") for _ in range(7)) for _ in range(60))
    assert L.explain(model, noise)[2] < 0 < L.explain(model, text[langs[0]])[2]
    assert all(r.fit > 0 for r in L.identify(docs.where("n_chars > 200").select("text"), model).collect())


def test_decontamination(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [prose(rng.randint(12, 60)) for _ in range(20)] + ["one two three", None, "", "a a a a a a a a a a a a"]
    docs = [None, "", "x one TWO three", "one two three", prose(20_000), "a " * 40]
    for k in range(20):
        w = items[k].upper().split(" ") if k % 3 else items[k].split(" ")
        if k % 4 == 1:
            w[len(w) // 2] = "changed"
        if k % 4 == 2:
            w = w[:len(w) * 2 // 3]
        docs.append(prose(rng.randint(0, 200)) + "\n" + " ".join(w) + "\t" + prose(rng.randint(0, 80)))
        docs.append(prose(90))
    docs.append(docs[6])
    want = brute.contaminated(docs, items)
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(docs)], "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for block in (4 << 20, 300):
        got = D.find_contamination(df, bench, block_bytes=block).collect()
        assert len(got) == len(want)
        assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    clean = D.remove_contaminated(df, bench, block_bytes=300)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(docs))) - {d for d, _ in want}
    assert D.find_contamination(df.limit(0), bench).count() == 0 and D.find_contamination(df, bench.limit(0)).count() == 0
    assert D.remove_contaminated(df, bench.limit(0)).count() == len(docs)
