"""The registered queries of the operators, each over its whole table, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.bpe import encode_documents
from tallyframe.llm.exact_dedup import exact_duplicates
from tallyframe.llm.fingerprint import K, as_text, distinct_shingles, resemblance, sketch, with_next, word_hashes
from tallyframe.llm.html_text import extract_pages
from tallyframe.llm.importance import resampled
from tallyframe.llm.jaccard_join import similar_documents
from tallyframe.llm.langid import fit_languages, predict_languages
from tallyframe.llm.langid import held_out as language_held_out
from tallyframe.llm.line_dedup import repeated_lines
from tallyframe.llm.mixing import mix
from tallyframe.llm.pii import pseudonymised
from tallyframe.llm.quality import fit_quality, held_out, score_quality
from tallyframe.llm.token_counts import token_counts, vocabulary_of
from tallyframe.llm.variants import spelling_variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@_query
def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_duplicates(_documents(spark, sf)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op1_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""


@_query
def op2_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    pairs = with_next(_documents(spark, sf)).withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    start = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third)
    edited = pairs.select(
        "doc_id", "n_chars", "text", "next_text",
        F.concat(start, F.substring("next_text", F.lit(1), third)).alias("edited"),
    )
    words = edited.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        *[word_hashes(F.col(c)).alias(c) for c in ("text", "edited", "next_text")],
    )
    sketches = words.select(
        "doc_id", "n_chars", "edited_sha256",
        *[sketch(F.col(c)).alias(c) for c in ("text", "edited", "next_text")],
    )
    return sketches.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("text")).alias("fingerprint"),
        as_text(F.col("edited")).alias("edited_fingerprint"),
        resemblance(F.col("text"), F.col("edited"), K).alias("near_edited"),
        resemblance(F.col("text"), F.col("next_text"), K).alias("near_next"),
        distinct_shingles(F.col("text"), K).alias("n_shingles"),
    )


@_query
def op3_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mix(_documents(spark, sf))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


@_query
def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return token_counts(_documents(spark, sf), vocabulary_of(public_tokenizers.path("piece_bpe_32k.model")))


@_query
def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    lines = repeated_lines(_documents(spark, sf))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op5_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), r AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(r.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (r.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN r ON k.key = r.key
GROUP BY doc_id
"""


@_query
def op6_html_text(spark: SparkSession, sf: str) -> DataFrame:
    texts = extract_pages(spark.read.parquet(f"{sf}/pages.parquet"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pseudonymised(_documents(spark, sf), key="not a secret: the query's own key")


@_query
def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    encoded = encode_documents(_documents(spark, sf), public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op10_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    similar = similar_documents(_documents(spark, sf), percent=85, size=4)
    return similar.select("doc_id", "n_shingles", "component_id")


ORACLES["op10_ngram_jaccard"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.a = d.doc_id
GROUP BY d.doc_id
"""


@_query
def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    model = fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    return score_quality(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@_query
def op11_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    return predict_languages(docs, fit_languages(docs)).select(
        "doc_id", language_held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )


@_query
def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(_documents(spark, sf), misspelt=199)


#: crc32 of the UTF-8 bytes of distinct ``word``s of a relation: bytes one after the other through a table made by its rule
_CRC = r"""
  tbl AS (
    SELECT list(list_reduce(list_prepend(i, range(8)),
                            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)
  ), crc AS (
    SELECT key, xor(list_reduce(list_prepend(4294967295,
             list_transform(regexp_extract_all(hex(encode(key)), '..'), lambda b: ('0x' || b)::BIGINT)),
             lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h
    FROM keys, tbl
  )"""

ORACLES["op12_spelling_variants"] = (
    r"""
WITH RECURSIVE d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), o AS (
  SELECT run, concat(doc_id, ':', run) AS key, count(*) AS times FROM d WHERE length(run) >= 6 GROUP BY ALL
), keys AS (SELECT DISTINCT key FROM o), """
    + _CRC
    + r""", w AS (
  SELECT CASE WHEN h % 199 = 0
              THEN concat(substring(run, 1, h % length(run)), substring(run, h % length(run) + 2)) ELSE run END AS word, times
  FROM o JOIN crc USING (key)
), v AS (
  SELECT word, sum(times)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), x AS (
  SELECT word, n, i, concat(substring(word, 1, i - 1), substring(word, i + 1)) AS less
  FROM v, unnest(range(1, length(word) + 1)) u(i)
), p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM x a JOIN v b ON a.less = b.word
  UNION
  SELECT b.word, a.word, a.n FROM x a JOIN v b ON a.less = b.word
), f AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r
  FROM p
), g AS (
  SELECT v.word, v.n, coalesce(f.n_near, 0) AS n_near,
         CASE WHEN f.near_n >= 5 * v.n THEN f.near END AS form, CASE WHEN f.near_n >= 5 * v.n THEN f.near_n END AS form_n
  FROM v LEFT JOIN f ON v.word = f.word AND f.r = 1
), c AS (
  SELECT word, word AS at FROM g UNION ALL SELECT c.word, g.form FROM c JOIN g ON c.at = g.word WHERE g.form IS NOT NULL
)
SELECT g.word, g.form, c.at AS root, g.n, g.n_near, g.form_n
FROM g JOIN c ON c.word = g.word JOIN g e ON e.word = c.at AND e.form IS NULL
"""
)


@_query
def op13_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    drawn = resampled(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


ORACLES["op13_importance_resampling"] = (
    r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS key
  FROM benchmark
), o AS (
  SELECT doc_id, unnest(w) AS key FROM d
), keys AS (
  SELECT key FROM o UNION SELECT key FROM b
), """
    + _CRC
    + r""", s AS (
  SELECT h % 10000 AS bucket, count(*) AS s FROM o JOIN crc USING (key) GROUP BY 1
), t AS (
  SELECT h % 10000 AS bucket, count(*) AS t FROM b JOIN crc USING (key) GROUP BY 1
), totals AS (
  SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS all_s, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS all_t
), gain AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s + 10000) / ((s::DOUBLE + 1) * (all_t + 10000))))::BIGINT AS g
  FROM s LEFT JOIN t ON t.bucket = s.bucket, totals
), weight AS (
  SELECT doc_id, sum(g)::BIGINT AS weight FROM o JOIN crc USING (key) JOIN gain ON gain.bucket = h % 10000 GROUP BY doc_id
), r AS (
  SELECT d.doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256(concat('2024:', d.doc_id))[1:8])::BIGINT::DOUBLE + 0.5)
                                                    / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weight ON weight.doc_id = d.doc_id
), n AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS able
  FROM r
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
FROM n
"""
)
