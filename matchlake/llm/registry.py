"""Queries of the training-data operators, one opN_ for each, and the SQL they agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import mixing, neardup, negatives, packing, phrases, pieces, quality, repeats, secrets, sharding, tokens, urls, vectors
from matchlake.llm.scratch import with_workers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = secrets.of_kinds(F.col("spans"), *secrets.BASE)
    counts = [F.size(secrets.of_kinds(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def vocabulary(name: str) -> str:
    """The JSON of a public tokenizer, read on the driver; tasks get it by broadcast."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def model_file(name: str) -> bytes:
    """A public model, read on the driver; tasks get it by broadcast."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.ledger(table(spark, sf_dir, "documents"))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~quality.passes(quality.BASE)).alias("base_failed"), quality.passes(quality.POLICIES["v1"]).alias("kept"), "failures")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of policy v2 does to the whole corpus."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents")), quality.POLICIES["v2"])


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = tokens.counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return n.withColumn("over_limit", F.col("n_tokens") > 512)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return left.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sharding.assign(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", shifted), F.col("vec_id") % 100 == 0)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pieces.round_trip(table(spark, sf_dir, "documents"), model_file("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


#: The measurements and failures of every document as common table expressions; words, lines and windows as in `quality`.
BOOK_SQL = r"""
d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 7], ' ')) AS n FROM starts
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM windows, range(8) AS r(k) WHERE n > 1 GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (regexp_matches(line, '^[\x20\x09]*[-*\x{2022}]')) AS n_bullet_lines,
         count(*) FILTER (regexp_matches(line, '(\.\.\.|\x{2026})[\x20\x09-\x0D]*$')) AS n_cut_off_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT d.doc_id, d.source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(length(regexp_replace(t, '[^0-9]', '', 'g')) AS BIGINT) AS n_digits,
         CAST(len(list_filter(words, lambda w: w IN (STOP))) AS BIGINT) AS n_stop_words, md5(t) AS text_md5,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_bullet_lines, 0) AS n_bullet_lines, coalesce(n_cut_off_lines, 0) AS n_cut_off_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN repeated ON repeated.doc_id = d.doc_id LEFT JOIN lines ON lines.doc_id = d.doc_id
), book AS (
  SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT
    + 8 * (n_lines >= 4 AND 10 * n_dup_lines > 6 * n_lines)::INT + 16 * (n_words > 0 AND word_chars < 2 * n_words)::INT
    + 32 * (n_words > 0 AND word_chars > 20 * n_words)::INT + 64 * (10 * n_digits > 3 * word_chars)::INT
    + 128 * (n_lines >= 4 AND 10 * n_bullet_lines > 9 * n_lines)::INT + 256 * (n_lines >= 4 AND 10 * n_cut_off_lines > 3 * n_lines)::INT
    + 512 * (n_words >= 50 AND n_stop_words < 2)::INT + 1024 * (n_lines >= 10 AND 2 * n_lines > n_words)::INT
    + 2048 * (n_lines >= 4 AND 4 * n_dup_lines >= 3 * n_lines)::INT AS BIGINT) AS failures FROM m
)
""".replace("STOP", ", ".join(f"'{w}'" for w in quality.STOP_WORDS))

OP6_SQL = f"""WITH {BOOK_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failures & 3) <> 0 AS base_failed, (failures & 63) = 0 AS kept, failures FROM book
"""

QUALITY_ABLATIONS_SQL = f"""WITH {BOOK_SQL}, rules(rule, b) AS (VALUES {", ".join(f"('{r}', {1 << n})" for n, r in enumerate(quality.RULES))})
SELECT rule, count(*) FILTER (failures & b <> 0) AS n_failed, count(*) FILTER (failures = b) AS n_failed_alone, count(*) FILTER (failures = 0) AS n_kept,
       count(*) FILTER (failures = 0 OR failures = b) AS n_kept_without
FROM book, rules GROUP BY rule
"""

OP3_SQL = r"""
WITH BOOK, keyed AS (
  SELECT doc_id, source, n_words AS size, -ln((CAST('0x' || substr(md5(concat(doc_id, ':', text_md5)), 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE))
    / (CASE WHEN n_words > 0 THEN greatest(CAST(0.05 AS DOUBLE), CAST(1 AS DOUBLE) - n_repeat_words / n_words) ELSE CAST(0.05 AS DOUBLE) END / (CAST(1 AS DOUBLE) + bit_count(failures & 63))) AS key FROM book
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS w FROM keyed GROUP BY source
), c AS (
  SELECT *, 3 * source_size::DOUBLE AS cap, row_number() OVER o AS r, sum(source_size) OVER ()::DOUBLE - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS left_words,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w FROM s WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST)
), level AS (
  SELECT min(struct_pack(r := r, lw := left_words, w := left_w)) AS f FROM c WHERE w * left_words / left_w <= cap
), targets AS (
  SELECT source, source_size, CASE WHEN r >= f.r THEN w * f.lw / f.w ELSE cap END AS target FROM c, level
), x AS (
  SELECT k.*, t.source_size, t.target, CAST(CASE WHEN source_size > 0 THEN least(3, floor(target / source_size + 1e-9)) ELSE 0 END AS BIGINT) AS epochs,
         CAST(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, epochs * size + greatest(0, least(size, CAST(round(greatest(target - epochs * source_size, 0)) AS BIGINT) - (upto - size))) AS taken FROM x
""".replace("BOOK", BOOK_SQL)

OP4_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL
), good AS (
  SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(e, lambda x: abs(x))) > 0
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, p.b FROM reach r JOIN pairs p ON r.other = p.a
), component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, component_id = e.vec_id AS kept
FROM embeddings e JOIN component ON id = e.vec_id LEFT JOIN (SELECT a, count(*) AS n FROM pairs GROUP BY a) p ON p.a = e.vec_id
"""

OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM d WHERE len(words) > 0
), s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle FROM starts),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept FROM d JOIN component ON id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

OP5_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM parts
), hosts AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split
), rules(action, rule_host, rule_path) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
), fits AS (
  SELECT page_id, rule_host || rule_path AS rule, action,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS r
  FROM hosts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT h.page_id, h.host, h.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM hosts h LEFT JOIN (SELECT * FROM fits WHERE r = 1) f ON h.page_id = f.page_id
"""

OP11_SQL = r"""
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS r FROM scores WHERE same) WHERE r <= 5
), ranked AS (
  SELECT p.anchor_id, p.other AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same AND 100 * n.score BETWEEN 30 * p.score AND 90 * p.score
)
SELECT * FROM ranked WHERE rank <= 10
"""

OP13_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), places AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), grams AS (
  SELECT lang, words[i] AS x, words[i + 1] AS y, words[i + 2] AS z FROM places
), f1 AS (SELECT lang, x, count(*) AS f FROM grams GROUP BY ALL),
f2 AS (SELECT lang, x, y, count(*) AS f FROM grams WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, x, y, z, count(*) AS f FROM grams WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
two AS (
  SELECT p.lang, p.x || ' ' || p.y AS phrase, p.f AS a, u.f AS l, v.f AS r, CAST(1000000::HUGEINT * p.f * p.f // (u.f::HUGEINT * v.f) AS BIGINT) AS score
  FROM f2 p JOIN f1 u ON u.lang = p.lang AND u.x = p.x JOIN f1 v ON v.lang = p.lang AND v.x = p.y
  WHERE NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = p.lang AND t.x = p.x AND t.y = p.y AND 100 * t.f >= 50 * p.f)
    AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = p.lang AND t.y = p.x AND t.z = p.y AND 100 * t.f >= 50 * p.f)
), cuts AS (
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.f AS a, u.f AS l1, back.f AS r1, front.f AS l2, v.f AS r2,
         1000000::HUGEINT * t.f * t.f // (u.f::HUGEINT * back.f) AS s1, 1000000::HUGEINT * t.f * t.f // (front.f::HUGEINT * v.f) AS s2
  FROM f3 t JOIN f1 u ON u.lang = t.lang AND u.x = t.x JOIN f1 v ON v.lang = t.lang AND v.x = t.z
  JOIN f2 front ON front.lang = t.lang AND front.x = t.x AND front.y = t.y JOIN f2 back ON back.lang = t.lang AND back.x = t.y AND back.y = t.z
), every AS (
  SELECT * FROM two UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, CAST(least(s1, s2) AS BIGINT) FROM cuts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM every
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secret_scan, op2_packing, op3_mixing, op4_near_vectors, op5_url_filter, op6_quality_rules, op7_minhash, op8_token_counts, op9_repeats, op10_sharding, op11_hard_negatives, op12_pieces, op13_collocations, quality_ablations, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": OP3_SQL, "op4_near_vectors": OP4_SQL, "op7_minhash": OP7_SQL, "op11_hard_negatives": OP11_SQL, "op13_collocations": OP13_SQL, "op5_url_filter": OP5_SQL, "op6_quality_rules": OP6_SQL, "quality_ablations": QUALITY_ABLATIONS_SQL}
