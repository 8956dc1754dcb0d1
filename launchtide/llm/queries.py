"""The queries of this subpackage, ``(spark, sf_dir) -> DataFrame``, and SQL to check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from launchtide.llm.caps import near_vectors
from launchtide.llm.conversations import format_chats
from launchtide.llm.fingerprints import fingerprint_documents
from launchtide.llm.licenses import scan_licenses
from launchtide.llm.main_text import extract_main_text
from launchtide.llm.mixing import mix
from launchtide.llm.near_duplicates import near_duplicates
from launchtide.llm.packing import pack
from launchtide.llm.phrases import mine_phrases
from launchtide.llm.quality import score_quality
from launchtide.llm.search import search_documents
from launchtide.llm.shared import table
from launchtide.llm.toxicity import score_toxicity
from launchtide.llm.urls import judge_urls, labelled_pages, mine_url_rules


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = F.col("mix_size") * F.col("mix_copies")
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        taken.alias("taken"),
    )


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op6_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents"), most=2000, least=30, covered=80)


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    mined = mine_url_rules(labelled_pages(pages, table(spark, sf_dir, "labels")))
    return judge_urls(pages, mined).select("page_id", "host", "path", "rule", "verdict")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_fingerprints": op2_fingerprints,
    "op3_licenses": op3_licenses,
    "op4_mixing": op4_mixing,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_chats": op6_chats,
    "op7_main_text": op7_main_text,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_near_vectors": op10_near_vectors,
    "op11_phrases": op11_phrases,
    "op12_urls": op12_urls,
    "op13_search": op13_search,
}

ORACLE_SQL: dict[str, str] = {
    # The ranking by one window per source, which Spark's form reaches in bins.
    "op4_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST(CAST('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')), '4')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
           / 4503599627370496.0 AS drawn
  FROM documents
), pulled AS (
  SELECT *, CAST(floor(sqrt(size + 1) * 1024) AS BIGINT) AS pull FROM sized
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE WHEN sum(size) > 0 THEN CAST(sum(CAST(size * pull AS HUGEINT)) AS DOUBLE) / CAST(sum(size) AS DOUBLE) ELSE 1 END AS mean_pull, CAST(2 * sum(size) AS DOUBLE) AS cap,
         CAST(list_value(5, 2, 1)[1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS DOUBLE) AS weight
  FROM pulled GROUP BY source
), filling AS (
  SELECT *, (sum(source_size) OVER () * 1.5 - coalesce(sum(cap) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), plan AS (
  SELECT source, source_size, mean_pull,
         coalesce(least(cap, weight * (SELECT arg_min(level, cap / weight) FROM filling WHERE level < cap / weight)), cap) AS target
  FROM filling
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM plan
), rest AS (
  SELECT *, target - whole * source_size AS rest,
         CASE WHEN source_size > 0 THEN (target - whole * source_size) / source_size ELSE 0 END AS chance
  FROM rates
), ranked AS (
  SELECT s.*, r.source_size, target, whole, rest, chance,
         coalesce(sum(size) OVER (PARTITION BY s.source
           ORDER BY drawn / (1 - drawn) / (chance / (1 - chance) * (pull / mean_pull)), doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM pulled s JOIN rest r ON s.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN chance > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ranked
""",
    # Conversations as lists of turns; one goes if a longer one begins with its list.
    "op6_chats": r"""
WITH ordered AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS LAST, role, text) AS turns
  FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone FROM conversations)
  GROUP BY conv_id, lone
), distinct_ones AS (
  SELECT min(conv_id) AS conv_id, turns, len(turns) AS n, count(*) AS n_copies FROM ordered GROUP BY turns
), kept AS (
  SELECT * FROM distinct_ones a
  WHERE NOT EXISTS (
    SELECT 1 FROM distinct_ones b WHERE b.turns[1] = a.turns[1] AND b.n > a.n AND b.turns[1:a.n] = a.turns)
), rendered AS (
  SELECT conv_id, n, n_copies,
         array_to_string(list_transform(turns, lambda t: concat('<|im_start|>', t.role, chr(10), t.text, '<|im_end|>', chr(10))), '') AS text
  FROM kept
)
SELECT conv_id, CAST(n AS BIGINT) AS n_turns, CAST(n_copies AS BIGINT) AS n_copies,
       CAST(length(text) AS BIGINT) AS n_chars, text
FROM rendered
""",
    # All phrases counted, then the covered ones dropped and the rest ranked.
    "op11_phrases": r"""
WITH words AS (
  SELECT lang, doc, piece, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM (
    SELECT lang, doc, generate_subscripts(pieces, 1) AS piece, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS ws FROM (
      SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
             regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
      FROM documents))
), runs AS (
  SELECT lang, word AS w1, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3, lead(word, 3) OVER p AS w4
  FROM words WINDOW p AS (PARTITION BY doc, piece ORDER BY place)
), counted AS (
  SELECT lang, [w1] AS ws, count(*) AS a FROM runs GROUP BY ALL
  UNION ALL SELECT lang, [w1, w2], count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM runs WHERE w4 IS NOT NULL GROUP BY ALL
), frequent AS (
  SELECT * FROM counted WHERE a >= 30
), cuts AS (
  SELECT c.lang, c.ws, c.a, k, x.a AS l, y.a AS r, CAST(2000000 * CAST(c.a AS HUGEINT) // (x.a + y.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(generate_series(1, len(ws) - 1)) AS k FROM frequent WHERE len(ws) > 1) c
  JOIN frequent x ON x.lang = c.lang AND x.ws = c.ws[1:k]
  JOIN frequent y ON y.lang = c.lang AND y.ws = c.ws[k + 1:]
), candidates AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1
), inner_ones AS (
  SELECT DISTINCT lang, ws[i:j] AS ws, a FROM (
    SELECT *, unnest(generate_series(i + 1, len(ws))) AS j FROM (
      SELECT *, unnest(generate_series(1, len(ws) - 1)) AS i FROM frequent WHERE len(ws) > 2))
  WHERE j - i + 1 < len(ws)
), ranked AS (
  SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, score FROM candidates c
  WHERE NOT EXISTS (SELECT 1 FROM inner_ones o WHERE o.lang = c.lang AND o.ws = c.ws AND 100 * o.a >= 80 * c.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST((SELECT sum(a) FROM counted t WHERE t.lang = ranked.lang AND len(ws) = 1) AS BIGINT) AS n, score
FROM ranked
QUALIFY rank <= 2000
""",
    # Every document scored for every item.
    "op13_search": r"""
WITH lowered AS (
  SELECT doc_id, row_number() OVER () AS row,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), asked AS (
  SELECT DISTINCT item, item_id, unnest(terms) AS term FROM (
    SELECT item_id, row_number() OVER () AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM benchmark)
), whole AS (
  SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS HUGEINT) AS n_words FROM lowered WHERE len(terms) > 0
), postings AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM (
    SELECT row, doc_id, CAST(len(terms) AS HUGEINT) AS n, unnest(terms) AS term FROM lowered)
  GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, whole GROUP BY term, n_docs
), scored AS (
  SELECT item, item_id, row, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), whole
  GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
