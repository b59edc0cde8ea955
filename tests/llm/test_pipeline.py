"""The pipeline's stages against brute force, each on what the stage before it kept."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402


def test_stages(spark, sf):
    import corpus_pipeline as P
    from ledgerlens.llm.common import save
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(10 ** 6, None, "en", "s", 0), (10 ** 6 + 1, "12 34", "en", "s", 5), (None, "no id here", "en", None, 10)],
                                docs.schema)
    docs = docs.unionByName(odd)
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").collect()]
    columns = docs.columns
    for name, stage in P.STAGES:
        rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        out = save(stage(spark, docs, sf), name)
        if name == "source_mix":
            got = sorted((r.doc_id or -1, r.size, r.taken) for r in out.collect())
            want = sorted((i or -1, n, k) for i, n, _, _, k in brute.mix([(i, s, t) for i, t, s in rows]) if k)
            assert got == want
            break
        assert out.columns == columns
        got = sorted((r.doc_id or -1, r.text or "") for r in out.collect())
        if name == "language_id":
            want = [(i, t) for i, t, _ in rows if any(c.isalpha() for c in t or "")]
        elif name == "ngram_jaccard":
            comp = brute.jaccard([(i, t) for i, t, _ in rows])
            want = [(i, t) for i, t, _ in rows if i is None or comp[i] == i]
        elif name == "suffix_dedup":
            cut = brute.repeats([t for _, t, _ in rows])
            want = [(i, k.decode("utf-8", "ignore")) for (i, _, _), (_, _, k) in zip(rows, cut)]
            assert all(r.n_chars == len(r.text) for r in out.collect())
        else:
            bad = {d for d, _ in brute.contaminated([t for _, t, _ in rows], bench)}
            want = [(i, t) for d, (i, t, _) in enumerate(rows) if d not in bad]
        assert got == sorted((i or -1, t) for i, t in want), name
        docs = out


def test_language_stage_rejects_what_no_language_explains(spark, sf):
    import random

    import corpus_pipeline as P
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("qxzwvkjbpg") for _ in range(7))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(10 ** 6, " ".join(word() for _ in range(60)), None, "s", 0), (10 ** 6 + 1, "xq zw", None, "s", 5)], docs.schema)
    kept = {r.doc_id for r in P.language_id(spark, docs.unionByName(odd), sf).collect()}
    assert 10 ** 6 not in kept and 10 ** 6 + 1 in kept
    assert kept >= {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
