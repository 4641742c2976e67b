"""The queries of this subpackage, by name, each over its whole tables; and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import small_batches
from .decontaminate import contamination
from .exact_dedup import exact_duplicates
from . import fill_in_middle, licenses, mixing, secrets
from .html_text import extract
from .lm_score import ORDER, lm_scores
from .sentencepiece_codec import encode
from .simhash import near_duplicates
from .toxicity import toxicity
from .warc import through_archives
from .whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("locator")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), ORDER)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_archives(table(spark, sf_dir, "pages"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mixture(docs, mixing.cycled_weights(docs, (3, 1, 2)))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_html_text": op4_html_text,
    "op5_simhash": op5_simhash,
    "op6_warc": op6_warc,
    "op7_secrets": op7_secrets,
    "op8_decontaminate": op8_decontaminate,
    "op9_licenses": op9_licenses,
    "op10_toxicity": op10_toxicity,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_whitening": op12_whitening,
    "op13_mix_sources": op13_mix_sources,
}

ORACLES = {
    "op2_exact_dedup": r"""
with t as (
  select doc_id, coalesce(text, '') as raw, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents
), w as (
  select *, row_number() over (partition by text_sha256 order by length(raw) desc, doc_id nulls last) as rank,
    first_value(doc_id) over (partition by text_sha256 order by length(raw) desc, doc_id nulls last) as keep_id,
    count(*) over (partition by text_sha256) as group_size
  from t
)
select doc_id, keep_id, group_size, rank = 1 as kept, text_sha256 from w
""",
    "op8_decontaminate": r"""
with dw as (
  select doc_id, row_number() over () as r,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from documents
), bw as (
  select item_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from benchmark
), win as (
  select distinct item_id, least(13, len(w)) as n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as g
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from bw where len(w) > 0)
), lens as (
  select distinct n from win
), grams as (
  select r, i, n, array_to_string(w[i:i + n - 1], ' ') as g
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, lens where len(w) >= n)
), hits as (
  select grams.r, grams.i, grams.n, win.item_id from grams join win using (g, n)
), places as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits) group by r
), items as (
  select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as listed from hits group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from dw left join places using (r) left join items using (r)
""",
    "op9_licenses": licenses.oracle(),
    "op11_fill_in_middle": fill_in_middle.ORACLE,
    "op13_mix_sources": mixing.ORACLE,
    "op6_warc": r"""
with p as (
  select page_id, encode(coalesce(html, '')) as body, sha1(encode(coalesce(html, ''))) as h from pages
), f as (
  select *, min(page_id) over (partition by h) as first_id from p
)
select page_id, octet_length(body)::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (5 * (i // 4) + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int + 1, 1)), '') as payload_digest,
  case when first_id is null or page_id = first_id then 'response' else 'revisit' end as record_type,
  case when first_id is null or page_id = first_id then null else first_id end as refers_to, true as intact
from f
""",
}
