"""The operators as queries over the given tables, and SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.llm import (
    alignment,
    decontaminate,
    divergence,
    html_templates,
    near_dup,
    packing,
    prefix_bpe,
    quality,
    suffix_tree,
    token_counts,
    topk,
    toxicity,
    url_rules,
)
from hackney.llm.common import table
from hackney.session import small_batches, stage

Query = Callable[[SparkSession, str], DataFrame]


LISTED = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of equal id: a page of low quality or with toxic text is to be blocked."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"),
    )
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), labels, LISTED)


def op2_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_templates.extract(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids, written once: texts go to Python in small batches."""
    with small_batches(docs.sparkSession):
        pieces = packing.pack(docs).select(
            "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
            "doc_tokens", "sequence_id", "offset", "sequence_tokens",
        )
        return stage(pieces, "pieces")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.judge(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = prefix_bpe.decode(prefix_bpe.encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = alignment.link_counts(table(spark, sf_dir, "documents"))
    return counts.withColumnRenamed("digest", "groups_sha256")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with words as (
  select r, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
               coalesce(text, '') as text from documents)
), kept as (
  select lang, term, cast(count(*) as hugeint) as n_lang
  from words group by lang, term having count(distinct r) >= 30
), sources as (
  select distinct coalesce(lang, '') as lang, coalesce(source, '') as source from documents
), counts as (
  select lang, source, term, cast(count(*) as hugeint) as n
  from words join kept using (lang, term) group by lang, source, term
), langs as (
  select lang, cast(count(*) as hugeint) as v, cast(sum(n_lang) as hugeint) as n_all from kept group by lang
), totals as (
  select lang, source, cast(sum(n) as hugeint) as n_all from counts group by lang, source
), shares as (
  select s.lang, s.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (coalesce(t.n_all, 0) + 5 * l.v) as p,
         1 + (1000000000 * (k.n_lang + 5)) // (l.n_all + 5 * l.v) as q
  from sources s join kept k using (lang) join langs l using (lang)
  left join counts c using (lang, source, term) left join totals t using (lang, source)
), pairs as (
  select a.lang, a.source, b.source as item, cast(coalesce(sum(abs(x.p - y.p)), 0) as bigint) as value
  from sources a join sources b on a.lang = b.lang and a.source <> b.source
  left join shares x on x.lang = a.lang and x.source = a.source
  left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by a.lang, a.source, b.source
), terms as (
  select lang, source, term as item, cast(p - q as bigint) as value from shares where n > 0 and p > q
), ranked as (
  select lang, source, 'pair' as part, item, value,
         cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank
  from pairs
  union all
  select lang, source, 'term' as part, item, value,
         cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank
  from terms
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""


OP9_SQL = r"""
with item_words as (
  select cast(item_id as varchar) as item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null and text is not null
), windows as (
  select distinct item_id, least(len(w), 13) as n,
         array_to_string(w[s : s + least(len(w), 13) - 1], ' ') as win
  from item_words, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as t(s) where len(w) > 0
), doc_words as (
  select row_number() over () as r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
  from documents
), hits as (
  select r, s, n, item_id from (
    select r, s, l.n, array_to_string(w[s : s + l.n - 1], ' ') as win
    from doc_words, (select distinct n from windows) l, unnest(range(1, len(w) - l.n + 2)) as t(s)
  ) join windows using (n, win)
), words_hit as (
  select r, count(distinct p) as n_hit
  from (select distinct r, s, n from hits), unnest(range(s, s + n)) as t(p) group by r
), items_hit as (
  select r, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids
  from hits group by r
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc_words left join words_hit using (r) left join items_hit using (r)
"""


OP6_SQL = """
with vectors as (
  select row_number() over () as n, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as vec
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.n as n, q.vec_id as query_id, r.vec_id as vec_id,
         cast(list_sum(list_transform(list_zip(q.vec, r.vec), lambda p: p[1] * p[2])) as bigint) as score
  from vectors q join vectors r on q.vec_id <> r.vec_id
  where q.vec_id % 20 = 0
), ranked as (
  select query_id, vec_id, score,
         cast(row_number() over (partition by n order by score desc, vec_id) as integer) as rank
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


def queries() -> dict[str, Query]:
    return {
        "op1_url_rules": op1_url_rules,
        "op2_html_templates": op2_html_templates,
        "op3_quality": op3_quality,
        "op4_packing": op4_packing,
        "op5_toxicity": op5_toxicity,
        "op6_topk": op6_topk,
        "op7_token_counts": op7_token_counts,
        "op8_suffix_tree": op8_suffix_tree,
        "op9_decontaminate": op9_decontaminate,
        "op10_near_dup": op10_near_dup,
        "op11_prefix_bpe": op11_prefix_bpe,
        "op12_alignment": op12_alignment,
        "op13_source_divergence": op13_source_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_topk": OP6_SQL, "op9_decontaminate": OP9_SQL, "op13_source_divergence": OP13_SQL}
