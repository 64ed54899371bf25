"""The registered queries of the corpus operators, and the SQL that DuckDB can check them by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tributary.llm.context_mixing import context_mixing
from tributary.llm.decontaminate import contamination
from tributary.llm.exact_dedup import exact_groups
from tributary.llm.filter_audit import filter_audit
from tributary.llm.jaccard_join import jaccard_join
from tributary.llm.line_dedup import line_dedup
from tributary.llm.pieces import piece_encoding
from tributary.llm.pii import personal_data
from tributary.llm.resample import resampled
from tributary.llm.secrets import secret_scan
from tributary.llm.store import documents, prepare
from tributary.llm.suffix_dedup import suffix_dedup
from tributary.llm.toxicity import toxicity_scores
from tributary.llm.warc import page_archives
from tributary.session import table_path
from tributary.sources.tables import load


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))


def op2_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing(documents(spark, sf_dir))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(documents(spark, sf_dir), load(spark, sf_dir, "labels"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (exact_groups(documents(spark, sf_dir))
            .select("doc_id", "keep_id", "group_size", "kept",
                    F.lower(F.hex("digest")).alias("text_sha256")))


def op9_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encoding(documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), load(spark, sf_dir, "benchmark"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (page_archives(load(spark, sf_dir, "pages", "page_id", "url", "html"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                    "status"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(spark, table_path(sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(documents(spark, sf_dir), load(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def _prepared(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES = {fn.__name__: _prepared(fn) for fn in (
    op1_jaccard_join, op2_context_mixing, op3_secret_scan, op4_toxicity, op5_suffix_dedup,
    op6_personal_data, op7_line_dedup, op8_exact_dedup, op9_piece_encoding, op10_decontamination,
    op11_warc, op12_filter_audit, op13_resampling, pipeline)}

ORACLE: dict[str, str] = {
    "op1_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k
        FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
    FROM shingles a JOIN shingles b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2)
  JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * common >= 80 * (s.n + t.n - common)
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.r = links.x
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(r) AS m FROM reach GROUP BY doc_id) USING (doc_id)""",
    "op8_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op10_decontamination": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[k : k + size - 1], ' ') AS gram
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM (SELECT item_id, w, least(10, len(w)) AS size FROM items WHERE len(w) > 0))
), grams AS (
  SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM words, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), hits AS (
  SELECT doc_id, item_id, size, k FROM grams JOIN windows USING (size, gram)
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
    "op11_warc": """
SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN strlen(body) >= 1000 AND page_id < largest THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN strlen(body) >= 1000 AND page_id < largest THEN largest END AS refers_to,
       'ok' AS status
FROM (SELECT page_id, coalesce(html, '') AS body,
             max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest FROM pages)""",
    "op12_filter_audit": r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), marks AS (
  SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good,
         coalesce(max((toxic = 1)::INT), 0) AS toxic
  FROM labels GROUP BY doc_id
), failures AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS mask
  FROM texts LEFT JOIN marks USING (doc_id)
), counts AS (
  SELECT part, mask, good, toxic, count(*) AS n FROM failures GROUP BY ALL
), letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), steps AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order,
         unnest([{'step': 1, 'bit': a.bit, 'earlier': 0},
                 {'step': 2, 'bit': b.bit, 'earlier': a.bit},
                 {'step': 3, 'bit': c.bit, 'earlier': a.bit + b.bit},
                 {'step': 4, 'bit': d.bit, 'earlier': a.bit + b.bit + c.bit},
                 {'step': 5, 'bit': e.bit, 'earlier': a.bit + b.bit + c.bit + d.bit}],
                recursive := true)
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), outcome AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & earlier <> 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT
           AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN n * good ELSE 0 END)::BIGINT
           AS good_lost,
         sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN n * toxic ELSE 0 END)::BIGINT
           AS toxic_lost
  FROM counts, steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost,
       toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM outcome""",
    "op13_resampling": r"""
WITH table_rows AS (
  SELECT k, list_reduce(range(8), lambda c, step:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k) AS v
  FROM (SELECT unnest(range(256)) AS k)
), crc AS (SELECT list(v ORDER BY k) AS t FROM table_rows
), words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), target AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f
  FROM benchmark
), features AS (SELECT doc_id, unnest(w) AS f FROM words
), vocabulary AS (
  SELECT f, list_transform(range(1, strlen(f) + 1),
              lambda k: ('0x' || substr(hex(encode(f)), 2 * k - 1, 2))::BIGINT) AS b
  FROM (SELECT f FROM features UNION SELECT f FROM target)
), bucketed AS (
  SELECT f, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]),
                4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM vocabulary, crc
), s AS (SELECT bucket, count(*) AS n FROM features JOIN bucketed USING (f) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS n FROM target JOIN bucketed USING (f) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE
             * ((SELECT count(*) FROM features) + 10000)
             / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM target) + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)
), weights AS (
  SELECT doc_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM features JOIN bucketed USING (f) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
         count(*) OVER () AS able
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= floor(10 * able / 100) THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)""",
}
