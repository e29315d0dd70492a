"""Links to other datasets: scores, review decisions, review rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from .rdf import RES, SAME_AS, WIKIDATA


@dataclass(frozen=True)
class Thresholds:
    auto_score: float = 0.90
    review_score: float = 0.70
    auto_km: float = 5.0
    review_km: float = 20.0
    #: A missing distance passes; strict sends it to review.
    strict: bool = False


def status(score: Column, km: Column, compatible: Column, th: Thresholds = Thresholds()) -> Column:
    near = lambda most: F.coalesce(km <= most, F.lit(not th.strict))
    far_enough = F.coalesce(km <= th.review_km, F.lit(True))
    return F.when(compatible & (score >= th.auto_score) & near(th.auto_km), "verified").when(compatible & (score >= th.review_score) & far_enough, "manual_review").otherwise("rejected")


def _row(source, target, dataset, method, score, km, compatible, state, reason) -> list[Column]:
    verified = state == "verified"
    return [
        source.alias("source_uri"), target.alias("target_uri"), F.lit(dataset).alias("target_dataset"), F.lit(method).alias("method"), score.cast("double").alias("score"), km.cast("double").alias("distance_km"),
        compatible.alias("type_compatible"), state.alias("status"), F.when(verified, F.lit("automated:linker")).alias("reviewer"), reason.alias("reason"),
    ]


def qid_links(records: DataFrame) -> DataFrame:
    """Review rows of records' Wikidata ids: well-formed ones are verified, others rejected."""
    q = F.col("external_ids")["wikidata"]
    good = q.rlike("^Q[1-9][0-9]*$")
    state = F.when(good, "verified").otherwise("rejected")
    return records.filter(q.isNotNull() & (q != "")).select(*_row(
        F.concat(F.lit(RES), "entity_id"), F.when(good, F.concat(F.lit(WIKIDATA), q)).otherwise(F.lit(WIKIDATA + "INVALID")), "wikidata", "wikidata-qid", F.when(good, 1.0).otherwise(0.0), F.lit(None), F.lit(True), state,
        F.when(good, "normalized deterministic QID").otherwise("invalid QID"),
    ))


def candidate_links(records: DataFrame, candidates: DataFrame, th: Thresholds = Thresholds(), exact_ratio: bool = True) -> DataFrame:
    """Review rows of candidates (entity_id, uri, label, score, distance_km, type_compatible, evidence); a score of their own goes before ours."""
    c = candidates.filter(F.col("uri").isNotNull() & (F.col("uri") != "")).join(records.select("entity_id", "label_vi"), "entity_id")
    compatible = F.coalesce("type_compatible", F.lit(True))
    own = lambda x: F.when(F.col("score").isNull(), F.col(x))  # no key and no ratio where there is a score
    c = c.withColumn("_a", t.link_key(own("label_vi"))).withColumn("_b", t.link_key(own("label")))
    ratio = t.sequence_ratio(F.col("_a"), F.col("_b")) if exact_ratio else t.edit_ratio(F.col("_a"), F.col("_b"))
    c = c.withColumn("_ratio", ratio)
    score = F.coalesce("score", F.when(compatible, F.col("_ratio")).otherwise(0.0))
    return c.select(*_row(F.concat(F.lit(RES), "entity_id"), F.col("uri"), "dbpedia", "silk", score, F.col("distance_km"), compatible, status(score, F.col("distance_km"), compatible, th), F.coalesce(F.nullif("evidence", F.lit("")), F.lit("deterministic label/type/distance review"))))


def verified_quads(reviews: DataFrame, graph: str = "external-links") -> DataFrame:
    return reviews.filter("status = 'verified'").select(
        F.col("source_uri").alias("s"), F.lit("iri").alias("s_kind"), F.lit(SAME_AS).alias("p"), F.col("target_uri").alias("o"), F.lit("iri").alias("o_kind"), F.lit("").alias("o_lang"), F.lit("").alias("o_dt"), F.lit(graph).alias("g"),
    ).distinct()


def blocked_pairs(left: DataFrame, right: DataFrame, block: str) -> DataFrame:
    """Pairs that share a block, each once."""
    return left.join(right, block)


#: Bytes, about, of labels and counts to compare with that each executor may hold.
MOST_HELD = 32 << 20


def similar_candidates(left: DataFrame, right: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """Pairs of left and right, which both have a label, each once, and every pair whose labels' sequence ratio reaches the review score; columns of left but the label come along, and the ratio.

    2 * matches / (length + length) is at most the ratio of shorter and longer that their sum allows, so lengths of such a pair differ by a factor
    of (2 - s) / s at most: they lie in the same or in adjacent buckets of that factor. Then matches are at most the letters in common. Labels are
    compared once however many rows have them, and the labels of a bucket are dealt over all tasks.
    """
    least = th.review_score - 1e-6  # scores are rounded to six places
    factor = (2 - least) / least
    bucket = lambda n: F.floor(F.log(n.cast("double")) / F.lit(math.log(factor)) + 1e-9).cast("int")
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def side(df: DataFrame, x: str) -> DataFrame:
        labels = df.select(F.col("label").alias(f"_label_{x}")).distinct().repartition(parts, F.xxhash64(f"_label_{x}"))  # by another key than distinct's, or Spark takes the two for one and coalesces it
        keyed = labels.withColumn(f"_{x}", t.link_key(F.col(f"_label_{x}"))).withColumn(f"_{x}_n", F.length(f"_{x}")).filter(F.col(f"_{x}_n") > 0)
        return keyed.withColumn(f"_{x}_c", t.letter_counts(F.col(f"_{x}")))

    a = side(left, "a").withColumn("_bucket", bucket(F.col("_a_n")))
    b = side(right, "b").withColumn("_near", bucket(F.col("_b_n"))).withColumn("_bucket", F.explode(F.array(F.col("_near") - 1, F.col("_near"), F.col("_near") + 1)))
    if b.agg(F.coalesce(F.sum(2 * F.col("_b_n") + 200), F.lit(0))).first()[0] <= MOST_HELD:
        met = a.join(F.broadcast(b), "_bucket")
    else:
        salted = b.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        met = a.withColumn("_salt", F.pmod(F.xxhash64("_a"), F.lit(parts)).cast("int")).join(salted, ["_bucket", "_salt"])
    lengths = F.col("_a_n") + F.col("_b_n")
    fits = (2 * F.least("_a_n", "_b_n") >= F.lit(least) * lengths) & (t.letters_bound(F.col("_a_c"), F.col("_b_c"), lengths) >= least)
    scored = met.filter(fits).select("_label_a", "_a", "_label_b", "_b").filter(t.letters_ratio(F.col("_a"), F.col("_b")) >= least)
    scored = scored.select("_label_a", "_label_b", t.sequence_ratio(F.col("_a"), F.col("_b")).alias("ratio"))
    rows = left.withColumnRenamed("label", "_label_a").join(scored, "_label_a").drop("_label_a")
    return rows.join(right.withColumn("_label_b", F.col("label")), "_label_b").drop("_label_b")
