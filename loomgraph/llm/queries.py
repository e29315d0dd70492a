"""The operators with production parameters over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from secrets import token_hex

from pyspark.sql import DataFrame, SparkSession

from . import common, media, mixing, near_dedup, packing, quality, secrets, substring_dedup, surrogates, token_counts, toxicity

WORD_LIST = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is; the same on the driver and the workers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(common.table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(common.table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(common.table(spark, sf_dir, "documents"), secrets.train(spark))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(common.table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("spark.loomgraph.pii.key", "")
    if not key:  # no key is known to others: one for this session
        key = token_hex(32)
        spark.conf.set("spark.loomgraph.pii.key", key)
    return surrogates.pseudonymise(common.table(spark, sf_dir, "documents"), key.encode())


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(common.table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.table(spark, sf_dir, "documents"))


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(common.table(spark, sf_dir, "documents"))


OP4_SQL = f"""
with w as (select doc_id, {WORD_LIST} as ws from documents),
win as (
  select doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) as h
  from (select doc_id, ws, unnest(range(1, len(ws) - 33)) as i from w where len(ws) >= 35)),
rep as (select h from win group by h having count(*) > 1),
gone as (select distinct doc_id, i + j as i from (select doc_id, i, unnest(range(0, 35)) as j from win semi join rep using (h))),
word as (select doc_id, unnest(ws) as x, unnest(range(1, len(ws) + 1)) as i from w where len(ws) > 0),
kept as (select doc_id, string_agg(x, ' ' order by i) as s, count(*) as n from word anti join gone using (doc_id, i) group by doc_id)
select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(kept.n, 0))::bigint as n_removed, sha256(coalesce(s, '')) as kept_sha256
from w left join kept using (doc_id)"""

OP8_SQL = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
s as (
  select distinct doc_id, array_to_string(ws[i:i + 3], ' ') as g
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) as i from w where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
e as materialized (
  select x.a, x.b from (select p.doc_id as a, q.doc_id as b, count(*) as k from s p join s q on p.g = q.g and p.doc_id < q.doc_id group by all) x
  join n on n.doc_id = x.a join n m on m.doc_id = x.b where 100 * k >= 80 * (n.n + m.n - k)),
sym as materialized (select a, b from e union all select b, a from e),
reach(a, b) as (select a, a from sym union select r.a, x.b from reach r join sym x on r.b = x.a),
c as (select a, min(b) as c from reach group by a)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(c.c, w.doc_id) as component_id, coalesce(c.c, w.doc_id) = w.doc_id as kept
from w left join n using (doc_id) left join c on c.a = w.doc_id"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_token_counts, op2_quality_rules, op3_secret_scan, op4_substring_dedup, op5_packing, op6_toxicity, op7_pii_surrogates, op8_minhash_dedup, op9_mixing, op10_media_columns)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """Operators 1, 2, 3, 5, 6, 7 and 10 are tested against brute force, exact round trips or held-out accuracy instead."""
    return {"op4_substring_dedup": OP4_SQL, "op8_minhash_dedup": OP8_SQL, "op9_mixing": mixing.oracle()}
