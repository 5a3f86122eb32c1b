"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import alignment, best_fit, decontaminate, hard_negatives, language, line_dedup, near_dup, packing, secrets, token_counts, topk, toxicity, url_filter
from adlake.llm.common import table


def tokenizer(name: str) -> str:
    """Place of a vocabulary file: ``ADLAKE_TOKENIZERS`` if set, else the installed package of public vocabularies."""
    folder = os.environ.get("ADLAKE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_dedup.line_dedup(table(spark, folder, "documents"))
    return rows.select("doc_id", F.col("__cut").alias("n_deleted_lines"), "text")


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, folder, "pages"))


def op5_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.languages(docs, language.train(docs))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets(table(spark, folder, "documents"))


def op11_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit.best_fit(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(table(spark, folder, "embeddings"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (op1_toxicity, op2_decontamination, op3_line_dedup, op4_url_filter, op5_topk, op6_language, op7_packing, op8_token_counts, op9_near_duplicates, op10_secrets, op11_best_fit, op12_hard_negatives, op13_alignment)
}

WORDS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
SHINGLES = "list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end)"

SQL = {
    "op2_decontamination": f"""
        with i as (select item_id, unnest({SHINGLES}) s from (select item_id, {WORDS} w from benchmark where item_id is not null)),
        d as (select doc_id, unnest({SHINGLES}) s from (select doc_id, {WORDS} w from documents where doc_id is not null)),
        n as (select item_id, cast(count(distinct s) as int) item_shingles from i group by 1),
        h as (select doc_id, item_id, count(distinct s) shared from (select distinct * from d) join (select distinct * from i) using (s) group by 1, 2)
        select doc_id, item_id, shared, item_shingles, shared / item_shingles as containment
        from h join n using (item_id) where shared >= 0.8 * item_shingles""",
    "op5_topk": """
        with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v from embeddings
            where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select q.vec_id query_id, c.vec_id, cast(list_dot_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) score
            from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
        select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
        from s qualify rank <= 5""",
    "op12_hard_negatives": """
        with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v from embeddings
            where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id anchor_id, a.label alabel, c.vec_id, c.label,
                coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda x: x[1] * x[2])), 0) score
            from v a join v c on a.vec_id % 100 = 0 and c.vec_id <> a.vec_id),
        p as (select anchor_id, vec_id positive_id, score positive_score from s where label = alabel
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
        n as (select p.anchor_id, positive_id, s.vec_id negative_id, positive_score, s.score negative_score from p join s
            on s.anchor_id = p.anchor_id and s.label <> s.alabel and 80 * positive_score <= 100 * s.score and s.score <= positive_score)
        select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by negative_score desc, negative_id) as int) as rank,
            negative_id, positive_score, negative_score from n qualify rank <= 5""",
}
