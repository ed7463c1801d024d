"""One query for each operator over its whole table, and the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm import bpe, chat, clusters, decontam, licenses, lines, packing, quality, simhash, suffix, topk, trie, warc
from snapflow.session import cut, work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def query(sql: str | None = None):
    """Register a function under its own name; without ``sql`` it is tested against brute force."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
WITH whole AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
WHERE r <= 5
""")
def op1_exact_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), 5, lambda i: i % 50 == 0)


@query()
def op2_warc_bundles(spark, sf_dir):
    root = warc.as_uri(work_dir(spark, "warc"))
    index = warc.write_archives(table(spark, sf_dir, "pages"), root)
    read = warc.read_archives(index, root)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op3_byte_bpe(spark, sf_dir):
    encoded = bpe.tokenize(table(spark, sf_dir, "documents"), MULTI, public_tokenizers.PATTERN)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query()
def op5_quality_classifier(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op6_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


@query()
def op7_chat_formatting(spark, sf_dir):
    own = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    formatted = chat.format_conversations(turns, MULTI, public_tokenizers.PATTERN)
    return chat.conversation_digests(formatted)


@query()
def op8_suffix_dedup(spark, sf_dir):
    found = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(r"""
WITH w AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') IF x <> ''] AS w FROM documents),
held AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
b AS (SELECT item_id, [x FOR x IN regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') IF x <> ''] AS w FROM benchmark),
asked AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
                                       WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM b),
sizes AS (SELECT item_id, count(*) AS n FROM asked GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS k FROM held JOIN asked USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, k AS n_shared, n AS n_shingles, round(k / n, 6) AS containment
FROM shared JOIN sizes USING (item_id) WHERE k >= ceil(n * 0.8 - 1e-9)
""")
def op9_benchmark_decontamination(spark, sf_dir):
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(r"""
WITH raw AS (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
counted AS (SELECT *, len(regexp_extract_all(line, '\S+')) AS words FROM raw),
numbered AS (SELECT *, CAST(sum(CASE WHEN words > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS k,
                    sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM counted),
ls AS (SELECT doc_id, k, line, upto, upto - words AS before FROM numbered WHERE words > 0),
lists AS (SELECT doc_id, list(line ORDER BY k) AS all_lines FROM ls GROUP BY doc_id),
runs AS (
  SELECT a.doc_id, a.k AS s, min(b.k) AS e FROM ls a JOIN ls b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.upto - a.before >= 50 GROUP BY a.doc_id, a.k
  UNION
  SELECT b.doc_id, max(a.k) AS s, b.k AS e FROM ls a JOIN ls b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.upto - a.before >= 50 GROUP BY b.doc_id, b.k),
texts AS (SELECT doc_id, s, e, array_to_string(all_lines[s:e], chr(10)) AS t FROM runs JOIN lists USING (doc_id)),
later AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS r FROM texts),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS k FROM later WHERE r > 1)
SELECT n.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE g.k IS NOT NULL AND n.words > 0) AS n_removed,
       sha256(coalesce(string_agg(n.line, chr(10) ORDER BY n.i) FILTER (WHERE g.k IS NULL), '')) AS kept_sha256
FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.k = g.k GROUP BY n.doc_id
""")
def op10_line_dedup(spark, sf_dir):
    done = lines.remove_repeated_lines(table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_WORDS = r"[x FOR x IN regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+') IF x <> '']"
_TEMPLATES = ", ".join(f"({i}, '{spdx}', '{text}')" for i, (spdx, text) in enumerate(licenses.TEMPLATES))


@query(rf"""
WITH t(template, license, text) AS (VALUES {_TEMPLATES}),
tw AS (SELECT template, license, {_WORDS.format("text")} AS w FROM t),
files AS (
  SELECT doc_id, text, doc_id % 16 = 0 AS is_license,
         coalesce(source, 'none') || '/' || (doc_id - doc_id % 256) || CASE WHEN doc_id % 256 = 0 THEN '' ELSE '/' || (doc_id - doc_id % 16) END AS dir
  FROM documents WHERE doc_id IS NOT NULL),
bodies AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS body FROM files),
found AS (SELECT doc_id, {_WORDS.format("body")} AS w FROM bodies WHERE regexp_matches(body, '(?i)licen[cs]e|copyright|permission|permitted|public domain')),
alike AS (SELECT DISTINCT w FROM found),
both_of AS (SELECT w FROM alike UNION ALL SELECT w FROM tw),
n AS (SELECT count(*) AS n FROM both_of),
vocabulary AS (SELECT DISTINCT unnest(w) AS term FROM tw),
seen AS (SELECT unnest(list_distinct(w)) AS term FROM both_of),
idf AS (SELECT term, ln((n + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)) + 1 AS idf FROM seen JOIN vocabulary USING (term), n GROUP BY term, n),
tf AS (SELECT w, term, count(*) AS tf FROM (SELECT w, unnest(w) AS term FROM alike) GROUP BY w, term),
weighed AS (SELECT w, term, idf, tf * coalesce(idf, ln((n + 1.0::DOUBLE) / 2) + 1) AS x FROM tf LEFT JOIN idf USING (term), n),
lengths AS (SELECT w, sqrt(sum(x * x)) AS l FROM weighed GROUP BY w),
ttf AS (SELECT template, license, term, count(*) AS tf FROM (SELECT template, license, unnest(w) AS term FROM tw) GROUP BY ALL),
tweighed AS (SELECT *, tf * idf AS x, sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS l FROM ttf JOIN idf USING (term)),
cosine AS (
  SELECT a.w, template, license, round(sum(a.x / l1.l * b.x / b.l), 6) AS score
  FROM weighed a JOIN lengths l1 USING (w) JOIN tweighed b USING (term) GROUP BY a.w, template, license),
best AS (SELECT w, first(license ORDER BY score DESC, template) AS license, max(score) AS score, first(template ORDER BY score DESC, template) AS template FROM cosine WHERE score >= 0.7 GROUP BY w),
own AS (SELECT doc_id, first(license ORDER BY score DESC, template) AS license, max(score) AS score FROM found JOIN best USING (w) GROUP BY doc_id),
given AS (SELECT dir, first(doc_id ORDER BY 'LICENSE.' || doc_id) AS by_doc FROM files JOIN own USING (doc_id) WHERE is_license GROUP BY dir),
ups AS (SELECT doc_id, 0 AS far, dir FROM files UNION ALL SELECT doc_id, 1, regexp_replace(dir, '/?[^/]*$', '') FROM files
        UNION ALL SELECT doc_id, 2, regexp_replace(regexp_replace(dir, '/?[^/]*$', ''), '/?[^/]*$', '') FROM files),
nearest AS (SELECT doc_id, arg_min(by_doc, far) AS by_doc FROM ups JOIN given USING (dir) GROUP BY doc_id)
SELECT f.doc_id, coalesce(o.license, g.license) AS license, coalesce(o.score, g.score) AS score,
       CASE WHEN o.doc_id IS NOT NULL THEN 'own' WHEN x.by_doc IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       coalesce(o.doc_id, x.by_doc) AS licensed_by
FROM (SELECT DISTINCT doc_id FROM files) f LEFT JOIN own o USING (doc_id) LEFT JOIN nearest x USING (doc_id) LEFT JOIN own g ON g.doc_id = x.by_doc
""")
def op4_license_scan(spark, sf_dir):
    """Documents as the files of a tree: source / block of 256 / block of 16, a licence file first in each block."""
    i = F.col("doc_id")
    top = F.concat_ws("/", F.coalesce("source", F.lit("none")), i - i % 256)
    inner = F.when(i % 256 == 0, top).otherwise(F.concat_ws("/", top, i - i % 16))
    name = F.concat(F.when(i % 16 == 0, "LICENSE.").otherwise("doc."), i.cast("string"))
    files = table(spark, sf_dir, "documents").select(F.when(i.isNotNull(), F.concat_ws("/", inner, name)).alias("path"), "text")
    number = lambda c: F.regexp_extract(c, r"(-?[0-9]+)$", 1).cast("long")
    return licenses.scan(files).select(number("path").alias("doc_id"), "license", "score", "origin", number("licensed_by").alias("licensed_by"))


def _clustering(rounds: int = 5) -> str:
    """One pair of expressions a round: distances to all centroids, and the means of those nearest."""
    parts = []
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS (
  SELECT n, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT v.n, k.c, CAST(v.sq - 2 * list_inner_product(v.v, k.v) + list_inner_product(k.v, k.v) AS BIGINT) AS d FROM vs v CROSS JOIN k{r} k) GROUP BY n)""")
        if r < rounds:
            parts.append(f"""
m{r} AS (
  SELECT c, list(x ORDER BY i) AS v
  FROM (SELECT c, i, floor(sum(x) / count(*)) AS x FROM (SELECT a.c, unnest(v.v) AS x, generate_subscripts(v.v, 1) AS i FROM a{r} a JOIN vs v USING (n)) GROUP BY c, i) GROUP BY c),
k{r + 1} AS (SELECT k.c, coalesce(m.v, k.v) AS v FROM k{r} k LEFT JOIN m{r} m USING (c))""")
    return ",".join(parts)


@query(f"""
WITH whole AS (
  SELECT vec_id, embedding, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
vs AS (SELECT row_number() OVER () AS n, vec_id, embedding, v, list_inner_product(v, v) AS sq FROM whole),
k0 AS (SELECT row_number() OVER (ORDER BY s, embedding) - 1 AS c, v FROM (SELECT *, sha256('2:' || vec_id) AS s FROM vs ORDER BY s NULLS LAST, embedding LIMIT 40)),
{_clustering().strip()},
per AS (SELECT c, sum(d) AS s FROM a5 GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(per.s AS BIGINT) AS cluster_inertia, CAST((SELECT sum(s) FROM per) AS BIGINT) AS inertia,
       sha256(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN k5.v], ',')) AS centroid_sha256
FROM a5 JOIN vs USING (n) JOIN per USING (c) JOIN k5 USING (c)
""")
def op11_centroid_clustering(spark, sf_dir):
    return clusters.with_inertia(*clusters.cluster(table(spark, sf_dir, "embeddings")))


@query()
def op12_sequence_packing(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), BYTES)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS p FROM turns),
convs AS (
  SELECT conv_id, count(*) AS own,
         list_reduce([4294967295::BIGINT] || [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')],
           lambda acc, b: list_reduce([xor(acc, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS inverted
  FROM turns GROUP BY conv_id),
heads AS (SELECT conv_id, own, xor(inverted, 4294967295::BIGINT) % 6 AS h, conv_id - conv_id % 100 AS base FROM convs),
sized AS (SELECT a.*, least(a.h, coalesce(b.own, 0)) AS taken FROM heads a LEFT JOIN heads b ON a.base = b.conv_id),
rebuilt AS (
  SELECT s.conv_id, p.p AS depth, role, text FROM sized s JOIN placed p ON p.conv_id = s.base AND p.p <= s.taken
  UNION ALL
  SELECT s.conv_id, p.p - s.h + s.taken, role, text FROM sized s JOIN placed p ON p.conv_id = s.conv_id AND p.p > s.h),
paths AS (SELECT s.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY depth) FILTER (WHERE depth IS NOT NULL), []) AS path FROM sized s LEFT JOIN rebuilt USING (conv_id) GROUP BY s.conv_id),
members AS (SELECT conv_id, len(path) AS n, d, path[1:d] AS node FROM paths, unnest(range(0, len(path) + 1)) AS t(d)),
nodes AS (
  SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM members GROUP BY node),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(node[depth].text) END AS saved FROM nodes LEFT JOIN children USING (node)),
below AS (
  SELECT v.node[1:d] AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM valued v, unnest(range(0, v.depth + 1)) AS t(d) GROUP BY 1)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM valued v JOIN below b USING (node) LEFT JOIN valued p ON v.depth > 0 AND p.node = v.node[1:v.depth - 1]
""")
def op13_prefix_trie(spark, sf_dir):
    turns = cut(trie.numbered_turns(table(spark, sf_dir, "conversations")))
    rows, lengths = trie.shared_heads(turns)
    return trie.prefix_trie(rows, lengths)
