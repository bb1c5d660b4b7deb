"""The registered queries of the corpus operators: thin wrappers with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.exact_dedup import exact_dedup
from readloom.llm.lattice_lm import lm_scores
from readloom.llm.lexical import ranked_search
from readloom.llm.mixing import mix
from readloom.llm.near_dedup import near_classes
from readloom.llm.pii import pii_digest
from readloom.llm.set_join import joined_classes
from readloom.llm.shared import read_table
from readloom.llm.token_counts import count_tokens
from readloom.llm.token_shards import shard_round_trip
from readloom.llm.topk import exact_top_k
from readloom.llm.toxicity import fit_toxicity, score_toxicity, training_labels
from readloom.llm.whitening import whiten
from readloom.llm.word_bpe import compile_lexicon, encode_documents

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), PIECES)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read_table(spark, sf_dir, "documents"), width=2)


def op3_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return encode_documents(docs, WORDS, compile_lexicon(docs, WORDS))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"), PIECES)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, training_labels(read_table(spark, sf_dir, "labels")))
    return score_toxicity(docs, model)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_round_trip(read_table(spark, sf_dir, "documents"), WORDS)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(read_table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op11_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined_classes(read_table(spark, sf_dir, "documents"))


def op12_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_near_dedup, op3_word_bpe, op4_top_k, op5_lattice_lm, op6_toxicity, op7_mixing, op8_token_shards, op9_pii, op10_exact_dedup, op11_set_join, op12_mask_search, op13_whitening)}

_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES = {
    "op4_top_k": """
        with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v from embeddings
                   where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
              from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
        r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from s)
        select query_id, rank, vec_id, score from r where rank <= 10""",
    "op10_exact_dedup": f"""
        with d as (select doc_id, {_NORM} t from documents),
        g as (select t, min(doc_id) keep_id, count(*) group_size from d group by t)
        select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.t) as text_sha256
        from d join g using (t)""",
    "op11_set_join": f"""
        with recursive d as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
        s as (select distinct doc_id, unnest(case when w is null or len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                                             else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as sh from d),
        n as (select doc_id, count(*) as n from s group by doc_id),
        p as (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.sh = y.sh and x.doc_id <> y.doc_id group by all),
        l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
        r(a, b) as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
        m as (select a, min(b) as low from r group by a)
        select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) as component_id
        from d left join n using (doc_id) left join m on m.a = d.doc_id""",
    "op12_mask_search": f"""
        with e as (select r, doc_id, unnest(t) as term from (select row_number() over () as r, doc_id, {_TERMS} as t from documents)),
        d as (select r, count(*) as n from e group by r), s as (select count(*) as c, cast(sum(n) as bigint) as l from d),
        f as (select r, doc_id, term, count(*) as tf from e group by all),
        w as (select term, cast(floor(1000 * ln((2 * any_value(c) + 2) / (2 * count(*) + 1))) as bigint) as w from f, s group by term),
        q as (select distinct item_id, unnest({_TERMS}) as term from benchmark),
        g as (select item_id, r, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * c) // l)))) as bigint) as score
              from q join f using (term) join w using (term) join d using (r), s group by all),
        k as (select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank from g where score > 0)
        select item_id, rank, doc_id, score from k where rank <= 10""",
}
