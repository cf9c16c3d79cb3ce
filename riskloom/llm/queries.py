"""Named queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.llm import (
    audit, bitplanes, bpe, chat, e8, lattice, minhash, occurrences, packing, quality, secrets, toxicity, urls,
)
from riskloom.registry import query
from riskloom.sources.tables import table


@query("op1_sum_of_squares_packing")
def op1_sum_of_squares_packing(spark, sf):
    pieces = packing.pack(table(spark, sf, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op7_byte_bpe")
def op7_byte_bpe(spark, sf):
    coded = bpe.decode(bpe.encode(table(spark, sf, "documents")))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: Sites whose pages make up the list of unwanted URLs.
UNWANTED = r"(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\."

URL_SQL = r"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM cut),
keyed AS (SELECT page_id, host, path, CASE WHEN host = '' THEN '' ELSE
  regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
  || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS key
  FROM (SELECT *, array_to_string(list_filter(string_split(query, '&'),
    lambda p: NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)')), '&') AS kept FROM parts)),
listed AS (SELECT DISTINCT key FROM keyed WHERE regexp_matches(host, '(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.')),
rules(rule, own, start, decision) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
fits AS (SELECT k.*, r.rule, r.decision, row_number() OVER (PARTITION BY k.page_id ORDER BY length(r.rule) DESC) AS place
  FROM keyed k LEFT JOIN rules r ON (k.host = r.own OR suffix(k.host, '.' || r.own)) AND starts_with(k.path, r.start))
SELECT page_id, host, path, rule, coalesce(decision, CASE WHEN key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict,
  key IN (SELECT key FROM listed) AS listed FROM fits WHERE place = 1"""


@query("op8_bloom_url_filter", URL_SQL)
def op8_bloom_url_filter(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return urls.judge(pages, pages.filter(urls.host_of(F.col("url")).rlike(UNWANTED)))


CHAT_SQL = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id::bigint AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role || text) + length(regexp_replace(role || text, '[^\\<|]', '', 'g')) + 12)::bigint AS formatted_chars
FROM turns GROUP BY conv_id"""


@query("op9_event_sourced_chat", CHAT_SQL)
def op9_event_sourced_chat(spark, sf):
    marked = spark.sql("""
        SELECT conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
        FROM VALUES (-7L, 0L, 'user'), (-7L, 1L, 'assistant') AS t(conv_id, turn, role)""")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(marked)
    chats = chat.format_chats(chat.events_of(turns))
    read = chats.withColumns({
        "turns": chat.parsed(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans")),
    })
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query("op2_ngram_ratio_quality")
def op2_ngram_ratio_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.assess(docs, table(spark, sf, "labels"), with_text=False).withColumn("ratio", F.round("ratio", 6))


NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(words) >= 5 THEN list_distinct(list_transform(range(1, len(words) - 3),
    lambda i: array_to_string(words[i:i+4], ' '))) WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.size + y.size - common)),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a)
SELECT d.doc_id, coalesce(n.size, 0) AS n_shingles, (SELECT min(other) FROM r WHERE r.doc_id = d.doc_id) AS component_id,
  d.doc_id = (SELECT min(other) FROM r WHERE r.doc_id = d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id)"""


@query("op3_tensored_minhash", NEAR_SQL)
def op3_tensored_minhash(spark, sf):
    return minhash.deduplicate(table(spark, sf, "documents"))


@query("op5_toxicity_chain")
def op5_toxicity_chain(spark, sf):
    judged = toxicity.detect(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels"))
    return judged.drop("text")


@query("op6_secret_forest")
def op6_secret_forest(spark, sf):
    return secrets.scan(table(spark, sf, "documents")).select(
        "doc_id", "start", "length", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "probability",
        "is_secret",
    )


@query("op4_subword_lattice")
def op4_subword_lattice(spark, sf):
    return lattice.score(table(spark, sf, "documents"))


VECTOR_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT vec_id, min(other) AS component_id FROM r GROUP BY vec_id)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM c"""


@query("op10_e8_lattice", VECTOR_SQL)
def op10_e8_lattice(spark, sf):
    return e8.deduplicate(table(spark, sf, "embeddings"))


def centroid_sql(rounds: int) -> str:
    """Rounds of assignment and means, one after the other."""
    apart = "list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    parts = ["""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding,
    lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, e FROM v
    ORDER BY sha256('1:' || vec_id) LIMIT 16)"""]
    for k in range(rounds + 1):
        parts.append(f"""a{k} AS MATERIALIZED (SELECT v.row, v.vec_id, v.e, min(struct_pack(distance := {apart}, cluster := c.cluster)) AS near
    FROM v CROSS JOIN c{k} c GROUP BY ALL)""")
        if k < rounds:
            parts.append(f"""m{k} AS (SELECT near.cluster AS cluster, i, sum(e[i])::BIGINT AS s, count(*) AS n
    FROM a{k} CROSS JOIN range(1, 65) r(i) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT cluster, coalesce(moved, c.e) AS e FROM c{k} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS moved FROM m{k} GROUP BY cluster) USING (cluster))""")
    return ",\n".join(parts) + f"""
SELECT vec_id, cluster::INT AS cluster, near.distance AS distance,
  sum(near.distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(near.distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.cluster = near.cluster"""


@query("op11_bit_plane_centroids", centroid_sql(bitplanes.ROUNDS))
def op11_bit_plane_centroids(spark, sf):
    return bitplanes.cluster(table(spark, sf, "embeddings"))


@query("op12_pair_occurrence_bpe")
def op12_pair_occurrence_bpe(spark, sf):
    coded = occurrences.decode(occurrences.encode(table(spark, sf, "documents")))
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


AUDIT_SQL = r"""
WITH words AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
flags AS (SELECT doc_id, part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails FROM words),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
docs AS (SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
    FROM flags LEFT JOIN known USING (doc_id) GROUP BY ALL),
f AS (SELECT * FROM (VALUES (1, 'A'), (2, 'B'), (3, 'C'), (4, 'D'), (5, 'E')) AS f(k, name)),
orders AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS ks, a.name || b.name || c.name || d.name || e.name AS filter_order
    FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
steps AS (SELECT filter_order, step, ks[step] AS k, ks[1:step - 1] AS earlier FROM orders, range(1, 6) s(step)),
met AS (SELECT part, filter_order, step, k, good, toxic, n, fails, fails[k] AS own,
    len(list_filter(earlier, lambda j: fails[j])) > 0 AS gone, len(list_filter(fails, lambda x: x)) AS failed FROM docs, steps),
counts AS (SELECT part, filter_order, step, k, coalesce(sum(n) FILTER (NOT own AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (own AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (own AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (own AND failed = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (own AND NOT gone AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (own AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost FROM met GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, k)::BIGINT AS shapley FROM counts"""


@query("op13_filter_audit", AUDIT_SQL)
def op13_filter_audit(spark, sf):
    return audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))
