"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import bounded_batches, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
WORDS_SQL = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CRC_TABLE_SQL = """
tab AS (SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
                          CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i)))"""


def crc_sql(text: str) -> str:
    """CRC-32 of a string's UTF-8 bytes, over the column ``tab`` of CRC_TABLE_SQL."""
    data = (f"list_transform(range(octet_length(encode({text}))), lambda i: "
            f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))")
    return (f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {data}), "
            f"lambda c, b: xor(tab[xor(c & 255, b) + 1], c >> 8)))")


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bounded_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ledgerlens.llm.token_counts import count_tokens
    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_warc_bundles", """
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
       CASE WHEN later THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN later THEN first END AS refers_to
FROM (SELECT *, octet_length(encode(coalesce(html, ''))) >= 100 AND first IS NOT NULL
                AND (page_id IS NULL OR page_id <> first) AS later
      FROM (SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages))
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm import warc
    folder = warc.new_folder(spark)
    index = warc.write_bundles(read(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return warc.read_bundles(index, folder).drop("payload")


@query("op9_source_mix", rf"""
WITH d AS (SELECT doc_id, source, {WORDS_SQL} AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS cap, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
r AS (SELECT *, cap / weight AS ratio FROM w),
p AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS caps, coalesce(sum(weight) OVER before, 0) AS used,
             sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
      FROM r WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (CAST(total AS DOUBLE) - CAST(caps AS DOUBLE)) / (CAST(weights AS DOUBLE) - CAST(used AS DOUBLE)) AS level FROM p),
t AS (SELECT source, source_size,
             least(CAST(cap AS DOUBLE), (SELECT max(level) FROM l WHERE level <= ratio) * weight) AS target FROM l),
o AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
             CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM o)
SELECT doc_id, size, source_size, target,
       epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS taken FROM e
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.mixing import mix_sources
    return mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm import language as L
    docs = read(spark, sf_dir, "documents").withColumn("held_out", L.held_out("doc_id"))
    model = L.train(docs.where(F.col("doc_id").isNotNull() & ~F.col("held_out")))
    found = L.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "langs")


@query("op10_decontaminate")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.decontaminate import find_contamination
    return find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _op3_sql(dims: int = 64) -> str:
    bits = lambda a, b: " + ".join(f"CASE WHEN embedding[{i + 1}] > 0 THEN {1 << (i - a)} ELSE 0 END"
                                   for i in range(a, b))
    return f"""
WITH c AS (SELECT vec_id, CAST({bits(0, 32)} AS BIGINT) AS lo, CAST({bits(32, dims)} AS BIGINT) AS hi
           FROM embeddings WHERE embedding IS NOT NULL),
p AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id,
             CAST(bit_count(xor(a.lo, b.lo)) + bit_count(xor(a.hi, b.hi)) AS BIGINT) AS distance
      FROM c a JOIN c b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank,
                      neighbour_id, distance FROM p) WHERE rank <= 10
"""


@query("op3_topk_hamming", _op3_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.hamming import top_k
    rows = read(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


def _op4_sql() -> str:
    from ledgerlens.llm.licenses import LOWER, TEMPLATES, THRESHOLD, UPPER
    texts = ", ".join("('{}', '{}')".format(name, t.replace("'", "''")) for name, t in sorted(TEMPLATES.items()))
    return rf"""
WITH tt(license, txt) AS (VALUES {texts}),
tw AS (SELECT license, string_split(trim(regexp_replace(lower(txt), '[^a-z0-9]+', ' ', 'g')), ' ') AS words FROM tt),
tg AS (SELECT license, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS gram FROM tw),
t AS (SELECT license, gram, count(*) AS c FROM tg GROUP BY ALL),
tk AS (SELECT license, sum(c) AS k FROM t GROUP BY license),
d AS (SELECT row_number() OVER () AS r, doc_id, string_split(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
             '[^\p{{L}}\p{{N}}
]+', ' ', 'g'), chr(10)) AS rows FROM documents),
x AS (SELECT r, trim(unnest(rows)) AS line, unnest(range(len(rows))) AS i FROM d),
y AS (SELECT r, i, line, len(string_split(line, ' ')) AS n FROM x WHERE line <> ''),
l AS (SELECT r, i, n, sum(n) OVER (PARTITION BY r ORDER BY i) AS b FROM y),
w AS (SELECT r, string_split(string_agg(line, ' ' ORDER BY i), ' ') AS words FROM y GROUP BY r),
g AS (SELECT r, unnest(range(len(words) - 1)) AS p, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS gram FROM w),
h AS (SELECT r, license, gram, p, c FROM g JOIN t USING (gram)),
e AS (SELECT r, license, k FROM h JOIN tk USING (license) GROUP BY r, license, k HAVING count(*) >= {THRESHOLD / (2 - THRESHOLD) - 1e-6} * k),
u AS (SELECT e.r, license, k, s.b - s.n AS a, f.b, f.b - s.b + s.n - 1 AS n FROM e JOIN l s ON s.r = e.r JOIN l f ON f.r = e.r AND f.i >= s.i
      AND f.b - s.b + s.n - 1 BETWEEN {THRESHOLD / (2 - THRESHOLD) - 1e-6} * k AND {(2 - THRESHOLD) / THRESHOLD + 1e-6} * k),
c AS (SELECT u.r, u.license, k, a, b, n, least(count(*), max(c)) AS c FROM u JOIN h ON h.r = u.r AND h.license = u.license
      AND p >= a AND p < b - 1 GROUP BY u.r, u.license, k, a, b, n, gram),
m AS (SELECT r, license, a, b, sum(c) AS shared, 2.0::DOUBLE * sum(c) / (n + k) AS score FROM c GROUP BY r, license, k, a, b, n),
o AS (SELECT m.*, array_to_string(words[a + 1:b], ' ') AS unit FROM m JOIN w USING (r) WHERE score >= {THRESHOLD}),
f AS (SELECT r, count(DISTINCT unit) AS n_units FROM o GROUP BY r),
v AS (SELECT r, license, score FROM o QUALIFY row_number() OVER (PARTITION BY r ORDER BY shared DESC, score DESC, license) = 1)
SELECT doc_id, license, score, coalesce(n_units, 0) AS n_units FROM d LEFT JOIN f USING (r) LEFT JOIN v USING (r)
"""


@query("op4_license_scan", _op4_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.licenses import scan_licenses
    return scan_licenses(read(spark, sf_dir, "documents"))


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.ngram_join import jaccard_components
    return jaccard_components(read(spark, sf_dir, "documents"))


@query("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.suffix_dedup import repeat_report
    return repeat_report(read(spark, sf_dir, "documents"))


@query("op5_compact_windows")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.compact_windows import near_passages
    return near_passages(read(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run
    return run(spark, sf_dir)


@query("op11_importance_resample", rf"""
WITH {CRC_TABLE_SQL.strip()},
d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
dw AS (SELECT r, w, count(*) AS c FROM (SELECT r, unnest(words) AS w FROM d) GROUP BY r, w),
bw AS (SELECT w, count(*) AS c FROM (SELECT unnest(words) AS w FROM b) GROUP BY w),
v AS (SELECT w, {crc_sql('w')} % 10000 AS k FROM (SELECT DISTINCT w FROM dw UNION SELECT w FROM bw), tab),
s AS (SELECT k, sum(c) AS s FROM dw JOIN v USING (w) GROUP BY k),
t AS (SELECT k, sum(c) AS t FROM bw JOIN v USING (w) GROUP BY k),
n AS (SELECT CAST(coalesce((SELECT sum(s) FROM s), 0) AS DOUBLE) AS all_s, CAST(coalesce((SELECT sum(t) FROM t), 0) AS DOUBLE) AS all_t),
g AS (SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)
                                     / ((s + 1)::DOUBLE * (all_t + 10000)))) AS BIGINT) AS gain
      FROM s LEFT JOIN t USING (k), n),
f AS (SELECT r, sum(c * gain) AS total FROM dw JOIN v USING (w) JOIN g USING (k) GROUP BY r),
x AS (SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n_features,
             CAST(CASE WHEN len(words) > 0 THEN (total - ((total % len(words)) + len(words)) % len(words)) // len(words)
                  ELSE 0 END AS BIGINT) AS weight,
             CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
      FROM d LEFT JOIN f USING (r)),
y AS (SELECT r, doc_id, n_features, weight,
             weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
z AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, count(*) OVER () AS n
      FROM y WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * 10 // 100 THEN rank END AS rank FROM y LEFT JOIN z USING (r)
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.resample import resample
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op12_merkle_manifest", rf"""
WITH RECURSIVE {CRC_TABLE_SQL.strip()},
d AS (SELECT row_number() OVER () AS r, *, doc_id IS NOT NULL AND {crc_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0 AS bad,
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
      FROM documents, tab),
e AS (SELECT r, doc_id, lang, bad, concat({', '.join("coalesce(octet_length(encode(CAST(%s AS VARCHAR))) || ':' || CAST(%s AS VARCHAR), '-')" % (c, c) for c in ('doc_id', 'source', 'lang', 'n_chars'))}) AS head,
             coalesce(octet_length(encode(text)) || ':' || text, '-') AS body,
             coalesce(octet_length(encode(low)) || ':' || low, '-') AS other FROM d),
l AS (SELECT r, doc_id, lang, sha256(head || body) AS leaf, sha256(head || CASE WHEN bad THEN other ELSE body END) AS shown FROM e),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, shown, r) - 1 AS pos FROM l),
low_tree(lang, level, nodes) AS (
    SELECT lang, 0, list(leaf ORDER BY pos) FROM p GROUP BY lang
    UNION ALL
    SELECT lang, level + 1, list_transform(range((len(nodes) + 7) // 8),
                                           lambda i: sha256(array_to_string(nodes[8 * i + 1:8 * i + 8], '')))
    FROM low_tree WHERE len(nodes) > 1),
subs AS (SELECT lang, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
         FROM low_tree WHERE len(nodes) = 1),
top_tree(level, nodes) AS (
    SELECT 0, list(subroot ORDER BY place) FROM subs HAVING count(*) > 0
    UNION ALL
    SELECT level + 1, list_transform(range((len(nodes) + 7) // 8),
                                     lambda i: sha256(array_to_string(nodes[8 * i + 1:8 * i + 8], '')))
    FROM top_tree WHERE len(nodes) > 1),
steps AS (
    SELECT p.r, t.level AS step, t.nodes[8 * (pos // 8 ** t.level // 8) + 1:pos // 8 ** t.level] AS before,
           t.nodes[pos // 8 ** t.level + 2:8 * (pos // 8 ** t.level // 8) + 8] AS after
    FROM (SELECT r, lang, CAST(pos AS BIGINT) AS pos FROM p) p JOIN (SELECT lang, level, nodes FROM low_tree WHERE len(nodes) > 1) t
      ON p.lang IS NOT DISTINCT FROM t.lang
    UNION ALL
    SELECT p.r, 1000 + t.level, t.nodes[8 * (place // 8 ** t.level // 8) + 1:place // 8 ** t.level],
           t.nodes[place // 8 ** t.level + 2:8 * (place // 8 ** t.level // 8) + 8]
    FROM p JOIN subs ON p.lang IS NOT DISTINCT FROM subs.lang, (SELECT level, nodes FROM top_tree WHERE len(nodes) > 1) t),
paths AS (SELECT r, list(array_to_string(before, '') || '|' || array_to_string(after, '') ORDER BY step) AS path FROM steps GROUP BY r),
f AS (SELECT p.r, p.doc_id, p.lang, p.leaf, coalesce(path, []::VARCHAR[]) AS path,
             list_reduce(list_prepend(shown, coalesce(path, []::VARCHAR[])), lambda a, x:
                         sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root
      FROM p LEFT JOIN paths USING (r))
SELECT f.doc_id, f.leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM f JOIN subs ON f.lang IS NOT DISTINCT FROM subs.lang, (SELECT nodes[1] AS root FROM top_tree WHERE len(nodes) = 1)
""".replace("8 ** t.level", "CAST(8 ** t.level AS BIGINT)"))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.merkle import build, leaf_digest, prove
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    shown = F.when(tampered, leaf_digest(changed={"text": text})).otherwise(leaf_digest())
    return prove(build(read(spark, sf_dir, "documents"), presented=shown))


@query("op13_quality_classifier")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.quality import classify
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
