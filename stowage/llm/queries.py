"""One query per operator over its whole table, with production parameters, and its SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.llm.alignment import alignment
from stowage.llm.conversation_trie import TRIE_SQL, conversation_trie
from stowage.llm.embedding_dedup import near_vectors
from stowage.llm.jaccard_join import jaccard_join
from stowage.llm.line_dedup import LINE_DEDUP_SQL, line_dedup
from stowage.llm.lm_scoring import score_texts
from stowage.llm.mixing import mix_sources, taken_words
from stowage.llm.packing import pack_documents
from stowage.llm.quality import quality
from stowage.llm.secrets import find_secrets, secrets_digest
from stowage.llm.shipping import ship
from stowage.llm.token_counts import token_counts
from stowage.llm.top_k import TOP_K_SQL, top_k
from stowage.llm.toxicity import toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), PIECES)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), RANKS, BYTES)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(*mix_sources(table(spark, sf_dir, "documents")))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_digest(find_secrets(table(spark, sf_dir, "documents")))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"), BYTES, PIECES, ranks_file=RANKS)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {
    "op1_token_counts": op1,
    "op2_packing": op2,
    "op3_mixing": op3,
    "op4_line_dedup": op4,
    "op5_quality": op5,
    "op6_jaccard_join": op6,
    "op7_lm_scoring": op7,
    "op8_toxicity": op8,
    "op9_embedding_dedup": op9,
    "op10_secrets": op10,
    "op11_alignment": op11,
    "op12_conversation_trie": op12,
    "op13_top_k": op13,
}

JACCARD_SQL = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
), sets as (
    select doc_id, case when len(w) = 0 then []
                        when len(w) < 5 then [array_to_string(w, ' ')]
                        else list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')))
                   end as s
    from words
), shingles as (
    select doc_id, unnest(s) as g from sets
), pairs as (
    select a.doc_id as a, b.doc_id as b, count(*) as common
    from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id
    group by all
), links as (
    select p.a, p.b from pairs p join sets x on p.a = x.doc_id join sets y on p.b = y.doc_id
    where 100 * p.common >= 80 * (len(x.s) + len(y.s) - p.common)
), both_ways as (
    select a, b from links union all select b, a from links
), reach as (
    select doc_id, doc_id as other from sets
    union
    select r.doc_id, l.b from reach r join both_ways l on r.other = l.a
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, r.component_id
from sets s join (select doc_id, min(other) as component_id from reach group by doc_id) r on s.doc_id = r.doc_id
"""

VECTORS_SQL = """
with recursive v as (
    select vec_id, cast(embedding as double[]) as x from embeddings
), links as (
    select p.vec_id as a, q.vec_id as b from v p join v q on p.vec_id <> q.vec_id
    where list_cosine_similarity(p.x, q.x) >= 0.95
), reach as (
    select vec_id, vec_id as other from v
    union
    select r.vec_id, l.b from reach r join links l on r.other = l.a
)
select v.vec_id, coalesce(n.n, 0) as n_links, r.component_id, r.component_id = v.vec_id as kept
from v join (select vec_id, min(other) as component_id from reach group by vec_id) r on v.vec_id = r.vec_id
left join (select a, count(*) as n from links group by a) n on n.a = v.vec_id
"""

ORACLE = {
    "op4_line_dedup": LINE_DEDUP_SQL, "op6_jaccard_join": JACCARD_SQL, "op9_embedding_dedup": VECTORS_SQL,
    "op12_conversation_trie": TRIE_SQL, "op13_top_k": TOP_K_SQL,
}
