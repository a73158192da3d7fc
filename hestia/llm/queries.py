"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hestia.llm import bpe, centroids, contamination, divergence, htmltree, language, ledger, licences, merkle, quality, simhash, toxicity, warc
from hestia.llm.common import crc_of_id, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ledger.scan(table(spark, sf_dir, "documents"), content="text", keep=["doc_id"])
    base = F.filter("spans", lambda x: x["rank"] < len(ledger.BASE_RULES))
    counts = [ledger.count_of(F.col("spans"), r.kind).alias(f"n_{r.kind}") for r in ledger.BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(ledger.joined(base), 256).alias("base_sha256"), ledger.joined(F.col("spans")).alias("spans"))


def _op1_rule(rank: int, rule: ledger.Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, {rule.at_least} AS at_least,
      string_split_regex(x, '{pattern}') AS parts, regexp_extract_all(x, '{pattern}', 0) AS found,
      regexp_extract_all(x, '{pattern}', {rule.group}) AS vals FROM t"""


ORACLES["op1_secrets"] = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
r AS ({' UNION ALL '.join(_op1_rule(i, r) for i, r in enumerate(ledger.RULES))}),
i AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM r),
s AS (SELECT doc_id, rank, kind, length(found[i]) AS size,
    list_sum(list_transform(parts[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(found[1:i-1], lambda p: length(p))), 0) AS b
  FROM i WHERE length(vals[i]) >= at_least),
j AS (SELECT doc_id, rank, kind, b, kind || ':' || CAST(b AS BIGINT) || ':' || CAST(b + size AS BIGINT) AS span FROM s),
g AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(span, ',' ORDER BY b, rank) FILTER (rank < {len(ledger.BASE_RULES)}) AS base, string_agg(span, ',' ORDER BY b, rank) AS spans FROM j GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g ON t.doc_id = g.doc_id"""


@query
def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltree.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", language.held_out(crc_of_id()).alias("held_out"))
    learned = language.learn(docs.where("not held_out"))
    return language.classify(docs, learned, keep=["doc_id", "held_out"])


@query
def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.compare_with_edits(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edit.*")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


_OP5_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLES["op5_decontamination"] = f"""
WITH b AS (SELECT item_id, {_OP5_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
bi AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM bw),
win AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i+size-1], ' ') AS g FROM bi),
d AS (SELECT doc_id, {_OP5_WORDS} AS w FROM documents),
k AS (SELECT DISTINCT size FROM win),
di AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, k),
dg AS (SELECT doc_id, i, size, array_to_string(w[i:i+size-1], ' ') AS g FROM di),
h AS (SELECT doc_id, i, dg.size, item_id FROM dg JOIN win ON dg.g = win.g AND dg.size = win.size),
p AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS pos FROM h),
n AS (SELECT doc_id, count(*) AS n_hit FROM p GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN m ON d.doc_id = m.doc_id"""


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem")


_OP6_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (CAST('0x' || substr(h, {5 * i + 1}, 5) AS INTEGER) >> {s}) % 32 + 1, 1)" for i in range(8) for s in (15, 10, 5, 0)
)
ORACLES["op6_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT x, max(page_id) AS last FROM p GROUP BY x)
SELECT page_id, CAST(octet_length(encode(p.x)) AS BIGINT) AS payload_bytes, {_OP6_DIGITS} AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM p JOIN g ON p.x = g.x"""


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"), templates=licences.ALL_TEMPLATES, wrapped=True)


_OP8_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP8_PHRASES = ", ".join(f"('{a}', {b.split()!r})" for a, b in licences.PHRASES)
_OP8_TEMPLATES = ", ".join(f"({i}, '{a}', {b.split()!r})" for i, (a, b) in enumerate(licences.ALL_TEMPLATES))
ORACLES["op8_licences"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, {_OP8_WORDS.format("coalesce(text, '')")} AS w FROM documents),
ph(label, p) AS (VALUES {_OP8_PHRASES}),
i AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d WHERE list_contains(w, 'license')),
base AS (SELECT doc_id, i - 1 AS pos, label FROM i, ph WHERE w[i:i+len(p)-1] = p),
tp(t, label, w) AS (VALUES {_OP8_TEMPLATES}),
ti AS (SELECT t, label, w, unnest(range(1, len(w))) AS i FROM tp),
tpair AS (SELECT DISTINCT t, label, w[i] || ' ' || w[i+1] AS pair FROM ti),
tn AS (SELECT t, label, count(*) AS n FROM tpair GROUP BY t, label),
ln AS (SELECT doc_id, unnest(string_split(x, chr(10))) AS line FROM d),
lw AS (SELECT doc_id, row_number() OVER () AS b, {_OP8_WORDS.format("line")} AS w FROM ln),
li AS (SELECT doc_id, b, w, unnest(range(1, len(w))) AS i FROM lw),
lp AS (SELECT DISTINCT doc_id, b, w[i] || ' ' || w[i+1] AS pair FROM li),
o AS (SELECT doc_id, b, t, count(*) AS hit FROM lp JOIN tpair ON lp.pair = tpair.pair GROUP BY doc_id, b, t),
need AS (SELECT tn.t, tn.label, n, CAST(ceil({licences.THRESHOLD} * n - 1e-9) AS BIGINT) AS need,
  greatest(CAST(ceil({licences.THRESHOLD} * n - 1e-9) AS BIGINT), CAST(ceil(len(tp.w) / {licences.THRESHOLD} - 1e-9) AS BIGINT) - 1) AS width FROM tn JOIN tp ON tn.t = tp.t),
wi AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d),
h AS (SELECT doc_id, i, t, pair FROM (SELECT doc_id, i, w[i] || ' ' || w[i+1] AS p FROM wi) JOIN tpair ON p = pair),
enough AS (SELECT doc_id, t, need, width FROM (SELECT doc_id, t, count(DISTINCT pair) AS k FROM h GROUP BY doc_id, t) JOIN need USING (t) WHERE k >= need),
st AS (SELECT doc_id, t, len(list_distinct(list(pair) OVER (PARTITION BY doc_id, t ORDER BY i RANGE BETWEEN CURRENT ROW AND width - 1 FOLLOWING))) AS hit FROM h JOIN enough USING (doc_id, t)),
more AS (SELECT doc_id, label, hit / n AS c FROM (SELECT doc_id, t, hit FROM o UNION ALL SELECT doc_id, t, hit FROM st) x JOIN need ON x.t = need.t WHERE hit >= need),
bs AS (SELECT doc_id, count(*) AS n_base, min(pos) AS f, max(pos) AS l, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY doc_id),
ms AS (SELECT doc_id, max(c) AS c FROM more GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM more) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, f AS first_word, l AS last_word, coalesce(bs.labels, '') AS base_labels,
  coalesce(al.labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN bs ON d.doc_id = bs.doc_id LEFT JOIN ms ON d.doc_id = ms.doc_id LEFT JOIN al ON d.doc_id = al.doc_id"""


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", toxicity.held_out(crc_of_id()).alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(crc_of_id()))
    found = toxicity.score(docs, toxicity.learn(docs, labels), keep=["doc_id", "held_out"])
    return found.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return bpe.encode(table(spark, sf_dir, "documents"), path("byte_bpe_50k.tiktoken"), keep=["doc_id"], outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"), clusters=8, rounds=10, scale=1024, salt="3:")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op11_round(i: int) -> str:
    near = "min({'d': list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'c': c.c})"
    return f"""a{i} AS MATERIALIZED (SELECT rid, {near} AS m FROM k, c{i} AS c GROUP BY rid),
p{i} AS MATERIALIZED (SELECT m.c AS c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM a{i} JOIN k USING (rid)),
s{i} AS (SELECT c, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM p{i} GROUP BY c, i),
l{i} AS (SELECT c, list(CAST((s - (((s % n) + n) % n)) // n AS BIGINT) ORDER BY i) AS v FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(l.v, c.v) AS v FROM c{i} AS c LEFT JOIN l{i} AS l ON c.c = l.c)"""


ORACLES["op11_centroids"] = f"""
WITH k AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT sha256('3:' || vec_id) AS h, v FROM k ORDER BY h LIMIT 8)),
{", ".join(_op11_round(i) for i in range(10))},
f AS MATERIALIZED (SELECT rid, min({{'d': list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'c': c.c}}) AS m FROM k, c10 AS c GROUP BY rid)
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance, CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM f JOIN k ON f.rid = k.rid JOIN c10 AS c ON c.c = m.c"""


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=30, top=50)


_OP12_SHARE = "1 + (1000000000::HUGEINT * ({n} + 5)) // ({total} + 5 * v)"
ORACLES["op12_divergence"] = rf"""
WITH d AS MATERIALIZED (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS rid,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS MATERIALIZED (SELECT lang, source, rid, term, count(*) AS n FROM (SELECT lang, source, rid, unnest(w) AS term FROM d) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM t GROUP BY lang, term HAVING count(*) >= 30),
l AS MATERIALIZED (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT g.lang, g.source, k.term, k.n AS of_lang, coalesce(x.n, 0) AS n FROM g JOIN k ON g.lang = k.lang
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM t GROUP BY ALL) x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term),
s AS (SELECT lang, source, sum(n) AS own FROM c GROUP BY lang, source),
p AS MATERIALIZED (SELECT c.lang, c.source, c.term, c.n, {_OP12_SHARE.format(n="c.n", total="own")} AS p, {_OP12_SHARE.format(n="of_lang", total="l.total")} AS q
  FROM c JOIN s ON c.lang = s.lang AND c.source = s.source JOIN l ON l.lang = c.lang),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50"""


@query
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", quality.held_out(crc_of_id()).alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(~quality.held_out(crc_of_id()))
    found = quality.score(docs, quality.learn(docs, labels), keep=["doc_id", "held_out"])
    return found.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
