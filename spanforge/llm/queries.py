"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import bwtdedup, decontam, idcodec, langid, packing, quality, sharding, simhash, superkmers, urls
from spanforge.session import table

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(table(spark, sf_dir, "documents"), length=1024, end_id=0)


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.dedup_digest(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.learn(docs.where(~langid.held_out())))
    return found.select("doc_id", F.coalesce(langid.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idcodec.write_and_read(table(spark, sf_dir, "documents"), end_id=2)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf_dir, "pages"), urls.rules_frame(spark, URL_RULES), ["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), "doc_id", SHARDS)
    return placed.select("doc_id", "slot", "shard_id", "shard", F.length("text").cast("long").alias("n_text"))


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwtdedup.dedup_digest(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def queries() -> dict:
    return {"op1_simhash": op1_simhash, "op2_packing": op2_packing, "op6_substring": op6_substring, "op7_language": op7_language, "op8_token_ids": op8_token_ids, "op3_url_filter": op3_url_filter, "op4_decontamination": op4_decontamination, "op5_sharding": op5_sharding, "op9_suffix_array": op9_suffix_array, "op10_quality": op10_quality}


def oracle_sql() -> dict[str, str]:
    """SQL for those queries that it can express; the others are tested against brute force or a round trip."""
    return {"op3_url_filter": OP3_SQL, "op6_substring": OP6_SQL}


OP6_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
spots as (select doc_id, words, unnest(range(1, len(words) - 11)) as i from w where len(words) >= 13),
win as (select doc_id, i, array_to_string(words[i:i+12], ' ') as k from spots),
least_id as (select k, min(doc_id) as m from win group by k),
gone as (select distinct doc_id, i + j as p from win join least_id using (k) cross join range(0, 13) r(j) where doc_id > m),
word as (select doc_id, unnest(words) as x, unnest(range(1, len(words) + 1)) as p from w),
kept as (select doc_id, string_agg(x, ' ' order by p) as t from word anti join gone using (doc_id, p) group by doc_id),
losses as (select doc_id, count(*) as n from gone group by doc_id)
select w.doc_id, len(words) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from w left join kept using (doc_id) left join losses using (doc_id)
"""

OP3_SQL = """
with rules(rule, h, p, action) as (values ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
cut as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
ranked as (select parts.*, rule, action, row_number() over (partition by page_id order by length(rule) desc nulls last) as k
  from parts left join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from ranked where k = 1
"""
