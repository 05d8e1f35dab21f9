"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.llm.curriculum import assign_positions, delivered, write_training_order
from gridtally.llm.inner_topk import inner_top_k, whole_vectors
from gridtally.llm.jaccard_join import jaccard_components
from gridtally.llm.language_id import accepted, fit_languages, identify, learnable
from gridtally.llm.lexical_search import lexical_search
from gridtally.llm.merkle import edited_fingerprints
from gridtally.llm.mixture_packing import pack_mixture
from gridtally.llm.ordinal_quality import drawn_ratings, fit_grades, grade_texts
from gridtally.llm.preference_format import format_preferences
from gridtally.llm.suffix_dedup import remove_repeats
from gridtally.llm.token_files import read_token_files, write_token_files
from gridtally.llm.vector_packing import pack_documents
from gridtally.llm.whitening import by_component, whiten, whole_entries
from gridtally.session import materialize, scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_languages(docs.filter(learnable()))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"),
        "lang_pred",
        "score",
        accepted().alias("accepted"),
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), folder)
    return read_token_files(spark, folder, with_ids=False)


def op5_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op6_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2n and 2n+1 make a pair, the even one chosen."""
    turns = _table(spark, sf_dir, "conversations").withColumns(
        {"pair_id": F.floor(F.col("conv_id") / 2), "chosen": F.pmod("conv_id", F.lit(2)) == 0}
    )
    return format_preferences(turns)


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 toxic, 1 of low quality, 2 good; a document is kept if most likely better than toxic."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2).alias("grade")
    )
    found = grade_texts(docs, fit_grades(docs.join(F.broadcast(drawn_ratings(labels)), "doc_id")))
    return found.select(
        "doc_id",
        "expected_grade",
        F.try_element_at("tail", F.lit(1)).alias("p_not_toxic"),
        F.try_element_at("tail", F.lit(2)).alias("p_good"),
        (F.try_element_at("tail", F.lit(1)) >= 0.5).alias("keep"),
        (F.try_element_at("tail", F.lit(2)) >= 0.5).alias("selected"),
    )


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(_table(spark, sf_dir, "embeddings"))
    return inner_top_k(vectors, vectors.filter(F.pmod("vec_id", F.lit(100)) == 0))


def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document, counted in the written training order."""
    docs, folder = _table(spark, sf_dir, "documents"), scratch_path(spark, "training-order")
    assigned = materialize(assign_positions(docs), "assigned")
    write_training_order(docs, assigned, folder)
    found = delivered(assigned, spark.read.parquet(folder))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op10_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_component(whiten(whole_entries(_table(spark, sf_dir, "embeddings"))))


def op13_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_mixture(_table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP9_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 3 * source_size AS cap FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))
          / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w
  WINDOW b AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size,
         CASE WHEN level * weight > cap THEN CAST(cap AS DOUBLE)
              ELSE (SELECT arg_min(level, (cap / weight, rank)) FROM l WHERE level * weight <= cap) * weight END AS target
  FROM l
), r AS (
  SELECT doc_id, size, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * ((middle < target)::INT + (middle + source_size < target)::INT
                  + (middle + 2 * source_size < target)::INT) AS BIGINT) AS taken
FROM r
"""

OP11_SQL = """
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents
), counts AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term
), sizes AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id
), totals AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term) t, totals
), asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM benchmark) q
  GROUP BY item_id, term
), gains AS (
  SELECT c.doc_id, c.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))) AS gain
  FROM counts c JOIN sizes s ON c.doc_id = s.doc_id JOIN weights w ON c.term = w.term, totals
), scored AS (
  SELECT item_id, doc_id, CAST(sum(times * gain) AS BIGINT) AS score
  FROM asked JOIN gains ON asked.term = gains.term GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_language_id": op3_language_id,
    "op4_token_files": op4_token_files,
    "op5_merkle_fingerprint": op5_merkle_fingerprint,
    "op6_preference_format": op6_preference_format,
    "op7_ordinal_quality": op7_ordinal_quality,
    "op8_exact_topk": op8_exact_topk,
    "op9_curriculum_mix": op9_curriculum_mix,
    "op10_vector_best_fit": op10_vector_best_fit,
    "op11_lexical_search": op11_lexical_search,
    "op12_whitening": op12_whitening,
    "op13_mixture_packing": op13_mixture_packing,
}

SQL = {
    "op8_exact_topk": OP8_SQL,
    "op9_curriculum_mix": OP9_SQL,
    "op11_lexical_search": OP11_SQL,
}
