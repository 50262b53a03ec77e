"""The registered queries of the training-data operators: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import centroids, chat, cotraining, decontaminate, hard_negatives, jaccard, language, packing, simhash, substrings, token_files, url_filter, wrappers
from quarry.llm.shared import table, written
from quarry.llm.tokens import tokenizer_path


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chat.read_back(chat.examples(turns.unionByName(probe))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    dictionaries = language.fit(docs.where(~language.held_out(F.col("doc_id"))).select("text", "lang"))
    return language.classify(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), dictionaries
    ).select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return substrings.substring_dedup(docs).select(
        "row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(docs, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_token_files(spark, manifest).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").cast("long").alias("ids_crc32"),
    )


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    near = written(simhash.neighbours(docs), "neighbours")
    both = F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))))
    texts = simhash.edited(docs, near).select(
        "doc_id", "h", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), both.alias("t")
    )
    keys = ["doc_id", "h", "n_chars", "edited_sha256"]
    prints = simhash.fingerprints(texts.select(*keys, "t.kind", "t.text"), [*keys, "kind"])
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("fingerprint")))
    rows = written(
        prints.groupBy(*keys).agg(F.max("copies").alias("copies"), of(0).alias("own"), of(1).alias("other")), "fingerprints"
    )
    # the fingerprint of the next document
    standing = rows.groupBy("doc_id").agg(F.min_by("own", "h").alias("next_own")).withColumnRenamed("doc_id", "next_id")
    beside = near.join(standing, near["next_id"].eqNullSafe(standing["next_id"])).select(F.col("doc_id").alias("of_id"), "next_own")
    # all documents near those whose id is divisible by 100
    pairs = simhash.within_radius(rows.where("doc_id % 100 = 0").select(F.col("own").alias("fingerprint")), rows.select(F.col("own").alias("fingerprint")))
    held = rows.groupBy(F.col("own").alias("fingerprint")).agg(F.sum("copies").alias("held"))
    found = pairs.join(held, "fingerprint").groupBy("query").agg((F.sum("held") - 1).alias("n_within"))
    asked = F.when(F.col("doc_id") % 100 == 0, F.col("own"))
    out = rows.join(beside, rows["doc_id"].eqNullSafe(F.col("of_id"))).withColumn("asked", asked)
    text = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    return out.join(found, F.col("asked") == F.col("query"), "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text("own").alias("fingerprint"),
        text("other").alias("edited_fingerprint"),
        simhash.likeness(F.col("own"), F.col("other")).alias("near_edited"),
        simhash.likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        "n_within",
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    ).drop("copy")


#: (host, path, action)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return url_filter.judge(pages, RULES)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepared(table(spark, sf_dir, "embeddings"), changed)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0).drop("anchor_row", "positive_row")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(centroids.prepared(table(spark, sf_dir, "embeddings")))
    numbers = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.withColumn("centroid_sha256", F.sha2(numbers.cast("binary"), 256)).drop("centroid")


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = wrappers.extracted(pages, F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_language_id": op4_language_id,
    "op5_url_filters": op5_url_filters,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_token_files": op8_token_files,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_html_extraction": op13_html_extraction,
}



def _op5_sql() -> str:
    """Rules as a table; the rounds written out one after another."""
    d, rounds = url_filter.DAMPING, []
    for i in range(1, url_filter.ROUNDS + 1):
        rounds.append(f"""r{i} AS (
  SELECT kind, host, sum(rank) AS rank FROM (
    SELECT f.kind, f.dst AS host, {d} * r.rank * f.weight / o.w AS rank
    FROM r{i - 1} r JOIN flows f ON f.kind = r.kind AND f.src = r.host JOIN outs o ON o.kind = f.kind AND o.src = f.src
    UNION ALL SELECT kind, host, (1 - {d}) * rank FROM r0) GROUP BY ALL)""")
    rules = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in RULES)
    link = url_filter.LINK.replace("'", "''")
    return f"""
WITH rules(h, p, action) AS (VALUES {rules}),
cut AS (SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM (SELECT DISTINCT host, path FROM named) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path),
ruled AS (SELECT n.*, f.rule, f.action FROM named n LEFT JOIN fits f ON f.host = n.host AND f.path = n.path),
links AS (
  SELECT src, dst, count(*) AS weight FROM (
    SELECT page_id, host AS src, unnest(list_distinct(list_transform(regexp_extract_all(html, '{link}', 1),
      lambda x: translate(x, '{url_filter.UPPER}', '{url_filter.LOWER}')))) AS dst FROM named)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
sites AS (SELECT host, regexp_extract(host, '^[^.]+\\.([^.]+\\..+)$', 1) AS site FROM (SELECT DISTINCT host FROM named)),
edges AS (
  SELECT src, dst, CAST(sum(weight) AS DOUBLE) AS weight FROM (
    SELECT * FROM links UNION ALL SELECT host, site, {url_filter.SITE_WEIGHT} FROM sites WHERE site <> ''
    UNION ALL SELECT site, host, {url_filter.SITE_WEIGHT} FROM sites WHERE site <> '') GROUP BY ALL),
flows AS (SELECT 'trust' AS kind, src, dst, weight FROM edges UNION ALL SELECT 'distrust', dst, src, weight FROM edges),
outs AS (SELECT kind, src, sum(weight) AS w FROM flows GROUP BY ALL),
marks AS (
  SELECT CASE action WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM ruled WHERE action IS NOT NULL GROUP BY ALL),
r0 AS (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS rank FROM marks),
{", ".join(rounds)},
verdicts AS (
  SELECT host, coalesce(sum(rank) FILTER (kind = 'trust'), 0) AS t, coalesce(sum(rank) FILTER (kind = 'distrust'), 0) AS b
  FROM r{url_filter.ROUNDS} GROUP BY host)
SELECT page_id, r.host, path, rule,
  coalesce(action, CASE WHEN round(b, 9) > round({url_filter.THRESHOLD} * (t + b), 9) THEN 'block' ELSE 'allow' END, 'allow') AS verdict
FROM ruled r LEFT JOIN verdicts v ON v.host = r.host
"""


def _op12_sql() -> str:
    """The rounds written out; vectors and centroids have a row a component."""
    rounds = []
    for i in range(1, centroids.ROUNDS + 2):
        rounds.append(f"""n{i} AS MATERIALIZED (
  SELECT r, arg_min(c, d * {centroids.K} + c) AS c, min(d) AS d FROM (
    SELECT v.r, m.c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN m{i - 1} m ON m.i = v.i GROUP BY v.r, m.c) GROUP BY r),
m{i} AS MATERIALIZED (
  SELECT o.c, o.i, coalesce(x.x, o.x) AS x FROM m{i - 1} o LEFT JOIN (
    SELECT n.c, v.i, CAST((sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
    FROM n{i} n JOIN v ON v.r = n.r GROUP BY n.c, v.i) x ON x.c = o.c AND x.i = o.i)""")
    last = centroids.ROUNDS
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {centroids.DIMS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {centroids.DIMS}),
v AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
m0 AS MATERIALIZED (
  SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM (
    SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id), v) - 1 AS c, v FROM e WHERE vec_id IS NOT NULL) WHERE c < {centroids.K}),
{", ".join(rounds)}
SELECT vec_id, CAST(n.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY n.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, h.h AS centroid_sha256
FROM n{last + 1} n JOIN e ON e.r = n.r
JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM m{last} GROUP BY c) h ON h.c = n.c
"""


ORACLE_SQL = {
    "op11_hard_negatives": f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS MATERIALIZED (
  SELECT a.r AS a, a.vec_id AS anchor_id, e.r AS r, e.vec_id, e.label = a.label AS same, CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
  FROM e a JOIN e ON e.r <> a.r WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, r) <= {hard_negatives.POSITIVES}),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.a, p.r ORDER BY s.score DESC, s.vec_id, s.r) AS INTEGER) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND {hard_negatives.LEAST} * p.score <= 100 * s.score AND 100 * s.score <= {hard_negatives.MOST} * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {hard_negatives.NEGATIVES}
""",
    "op12_centroid_clustering": _op12_sql(),
    # the pages of these tables have one article element each: here it is taken literally
    "op13_html_extraction": r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)(?:</article>|<footer|$)', 1) AS h FROM pages
), t AS (
  SELECT page_id, url, regexp_replace(regexp_replace(h, '</?(?:h[1-6]|p|br)[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g') AS h FROM a
), u AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(h, '&lt;?', '<', 'g'),
    '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#39;?', chr(39), 'g'), '&nbsp;?', ' ', 'g'), '&amp;?', '&', 'g') AS h FROM t
)
SELECT page_id, url, trim(regexp_replace(h, '[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{3000}]+', ' ', 'g')) AS text,
  length(text) AS n_chars FROM u
""",
    "op10_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), few AS (
  SELECT sh FROM s GROUP BY sh HAVING count(*) > 1
), i AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS met FROM s a JOIN few USING (sh) JOIN s b USING (sh)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * met >= 75 * (p.n + q.n - met)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d
LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
""",
    "op6_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)
), v AS (
  SELECT doc_id, i, string_agg(word, ' ') OVER later AS words, count(*) OVER later AS n
  FROM w WINDOW later AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), late AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) > 1 AS late FROM v WHERE n = 20
), marked AS (
  SELECT w.doc_id, w.i, w.word,
    coalesce(bool_or(l.late) OVER (PARTITION BY w.doc_id ORDER BY w.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
  FROM w LEFT JOIN late l ON l.doc_id = w.doc_id AND l.i = w.i
), kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
""",
    "op5_url_filters": _op5_sql(),
    "op9_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), n AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\<\[]', '', 'g'))
      + length(role) + length(regexp_replace(role, '[^\\<\[\n]', '', 'g')) + 9 AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS r,
    count(*) OVER (PARTITION BY conv_id) AS c
  FROM t
), p AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY r) AS upto FROM n
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY r)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY r) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR r = c) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
""",
}
