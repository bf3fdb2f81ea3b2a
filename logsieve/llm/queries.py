"""One query for each operator, with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.llm import audit, centroids, chunking, jaccard, language, mixing, phrases, pieces, quantised, quotes, records, voronoi, warc
from logsieve.llm.common import sha256, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
    md5('mix-1|' || coalesce(doc_id::VARCHAR, '-') || '|' || md5(coalesce(text, ''))) AS place FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source),
weighted AS (SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighted WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT *, CASE WHEN level * weight < cap THEN coalesce(max(CASE WHEN level * weight < cap THEN level END) OVER (), 0) * weight
      ELSE cap::DOUBLE END AS target FROM levels),
blocks AS (
  SELECT *, greatest(1, least(64, floor(min(CASE WHEN target > 0 THEN target END) OVER () / 64)))::BIGINT AS block,
    sum(target) OVER () AS total FROM goals),
seats AS (
  SELECT b.*, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, place, k) AS turn
  FROM blocks b, unnest(range(0, least(floor(cap / block), floor(target / block) + 2 * (SELECT count(*) FROM blocks) + 2)::BIGINT)) u(k)),
won AS (SELECT place, count(*) AS quota FROM seats WHERE turn <= floor(total / block) GROUP BY place),
deck AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, coalesce(w.quota, 0) * b.block AS dealt,
    sum(s.size) OVER (PARTITION BY b.place ORDER BY s.place, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size AS first
  FROM sized s JOIN blocks b ON s.source IS NOT DISTINCT FROM b.source LEFT JOIN won w ON w.place = b.place)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (CASE WHEN source_size = 0 THEN 0 ELSE dealt // source_size * size
    + greatest(0, least(size, dealt % source_size - first)) END)::BIGINT AS taken
FROM deck
"""


@query("op2_mix_sources", MIX_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op1_sentencepiece")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(table(spark, sf_dir, "documents"), model, output="digest")


JACCARD_SQL = """
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
  FROM cut WHERE len(w) > 0),
counts AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN counts x ON x.doc_id = a.doc_id JOIN counts y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM documents d LEFT JOIN counts c ON c.doc_id = d.doc_id JOIN reached r ON r.doc_id = d.doc_id
GROUP BY d.doc_id, c.n
"""


@query("op8_jaccard_join", JACCARD_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op7_substring_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunking.passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start_word", "n_words", "first_doc_id", "first_start_word")


@query("op6_phrase_fingerprint")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.edited_likeness(table(spark, sf_dir, "documents"))


@query("op3_token_records")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return records.token_records(table(spark, sf_dir, "documents"), tokenizer, end_id=1)


TOP_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole d ON q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op5_voronoi_top_k", TOP_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.top_k(table(spark, sf_dir, "embeddings"))


MAIL_SQL = """
WITH RECURSIVE said AS (
  SELECT conv_id, turn, p, len(string_split(p, ' ')) AS words FROM (
    SELECT conv_id, turn, trim(lower(regexp_replace(part, '\\s+', ' ', 'g'))) AS p FROM (
      SELECT conv_id, turn, unnest(regexp_split_to_array(text, '\\n[ \\t]*\\n')) AS part FROM conversations))
  WHERE p <> ''),
firsts AS (SELECT conv_id, p, min(turn) AS first FROM said GROUP BY ALL),
votes AS (
  SELECT s.conv_id, s.turn + 1 AS turn, f.first, sum(s.words) AS words
  FROM said s JOIN firsts f ON f.conv_id = s.conv_id AND f.p = s.p GROUP BY ALL),
parents AS (
  SELECT c.conv_id, c.turn, arg_max(v.first, v.words * 1000000 + v.first) AS parent
  FROM conversations c JOIN votes v ON v.conv_id = c.conv_id AND v.turn = c.turn GROUP BY ALL),
chain AS (
  SELECT conv_id, turn, turn AS "at", 0 AS depth FROM conversations
  UNION ALL SELECT c.conv_id, c.turn, p.parent, c.depth + 1 FROM chain c JOIN parents p ON p.conv_id = c.conv_id AND p.turn = c."at"),
roots AS (SELECT conv_id, turn, max(depth) AS depth, min("at") AS root FROM chain GROUP BY ALL),
counts AS (SELECT conv_id, turn, count(*) AS n FROM said GROUP BY ALL)
SELECT c.conv_id, c.turn, p.parent AS parent_turn, r.root AS root_turn, r.depth::INTEGER AS depth,
  (coalesce(a.n, 0) + CASE WHEN a.n > 0 THEN coalesce(b.n, 0) ELSE 0 END)::INTEGER AS n_quoted,
  sha256(trim(c.text, chr(32) || chr(9) || chr(10) || chr(13))) AS text_sha256
FROM conversations c JOIN roots r ON r.conv_id = c.conv_id AND r.turn = c.turn
LEFT JOIN parents p ON p.conv_id = c.conv_id AND p.turn = c.turn
LEFT JOIN counts a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1
LEFT JOIN counts b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2
"""


@query("op10_quotation_linking", MAIL_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = quotes.as_mail(table(spark, sf_dir, "conversations"))
    linked = quotes.each_copy(quotes.link(mail, key="row_id", order="turn", body="body", scope="conv_id"))
    return linked.select(
        F.col("scope").alias("conv_id"), F.col("ord").alias("turn"), quotes.turn_of(F.col("parent")).alias("parent_turn"),
        quotes.turn_of(F.col("root")).alias("root_turn"), "depth", "n_quoted", sha256(F.col("own")).alias("text_sha256"),
    )


@query("op4_warc_derivatives")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = warc.derive(warc.responses(table(spark, sf_dir, "pages")))
    length = F.octet_length("record").cast("long").alias("record_bytes")
    return made.select(F.col("key").alias("page_id"), *(c for c in made.columns if c not in ("key", "record")), length, F.sha2("record", 256).alias("record_sha256"))


@query("op9_language_fusion")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    rows = language.of_documents(docs).unionByName(language.of_pages(pages))
    return language.identify(rows, language.fit(docs))


AUDIT_SQL = """
WITH marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
read AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
masked AS (
  SELECT r.part, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN r.doc_id > min(r.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM read r LEFT JOIN marks m ON m.doc_id = r.doc_id),
letters AS (SELECT unnest(string_split('A,B,C,D,E', ',')) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS own,
    coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))), 0)::INTEGER AS before
  FROM orders, unnest(range(1, 6)) u(step)),
cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM masked GROUP BY part, mask),
figures AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (mask & (own | before) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM figures
"""


@query("op13_filter_audit", AUDIT_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def cluster_sql(rounds: int = 10, k: int = 8) -> str:
    """The rounds one after the other; squared distances are whole numbers below 2^53 here, and exact as doubles."""
    parts = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT n, v FROM (SELECT v, row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS n FROM kept) WHERE n < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, min(((list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, c.v) + list_inner_product(c.v, c.v))::BIGINT) * {k} + n) AS best
  FROM kept k, c{i} c GROUP BY r)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.n, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT n, list(((s - ((s % h) + h) % h) // h)::DOUBLE ORDER BY pos) AS v FROM (
      SELECT best % {k} AS n, pos, sum(v[pos]::BIGINT)::BIGINT AS s, count(*) AS h
      FROM a{i} JOIN kept USING (r), unnest(range(1, 65)) u(pos) GROUP BY ALL) GROUP BY n) m ON m.n = c.n)""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, (best % {k})::INTEGER AS cluster, best // {k} AS distance, (sum(best // {k}) OVER (PARTITION BY best % {k}))::BIGINT AS cluster_inertia,
  (sum(best // {k}) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(c.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} c ON c.n = best % {k}"""


@query("op11_threshold_clusters", cluster_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return centroids.with_inertia(assigned, found).drop("n_tried")


NEAR_SQL = """
WITH RECURSIVE fit AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other),
named AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT n.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, component_id, n.vec_id = component_id AS kept FROM named n LEFT JOIN counts c USING (vec_id)
"""


@query("op12_embedding_near_dedup", NEAR_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised.near_duplicates(table(spark, sf_dir, "embeddings"))
