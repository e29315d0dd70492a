"""The labelled property graph: nodes with label sets, typed edges, links to the outside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rdf import CLASSES

#: Entity types that are cultural entities, and edge types of relation fields.
CULTURAL = ("HeritageSite", "HeritageComplex", "Museum", "IntangibleHeritage", "NationalTreasure", "DocumentaryHeritage", "CulturalObject")
EDGES = {
    "located_in": "LOCATED_IN", "parent_area": "LOCATED_IN", "associated_persons": "ASSOCIATED_WITH_PERSON", "associated_events": "ASSOCIATED_WITH_EVENT", "periods": "BELONGS_TO_PERIOD",
    "part_of": "PART_OF", "member_sites": "HAS_MEMBER", "recognized_by": "RECOGNIZED_BY", "architectural_styles": "HAS_ARCHITECTURAL_STYLE",
}


def nodes(records: DataFrame, order: str = "retrieved_at") -> DataFrame:
    """A node for each entity, its last record's values, labels and properties; and the organisation that recognises world heritage."""
    last = records.groupBy("entity_id").agg(F.max_by(F.struct("entity_type", "label_vi", "registry_category", "recognition_year", "coordinates"), order).alias("r"))
    kind = F.col("r.entity_type")
    labels = F.array_compact(F.array(F.lit("Entity"), F.when(kind.isin(*CLASSES), kind), F.when(kind.isin(*CULTURAL), F.lit("CulturalHeritageEntity")), F.when(F.col("r.registry_category") == "world_heritage", F.lit("UNESCOHeritageSite"))))
    own = last.select(
        F.col("entity_id").alias("entityId"), labels.alias("labels"), F.col("r.label_vi").alias("label"), F.lit(None).cast("string").alias("labelEn"), kind.alias("entityType"), F.col("r.recognition_year").cast("int").alias("recognitionYear"),
        F.col("r.coordinates.lat").alias("lat"), F.col("r.coordinates.lon").alias("lon"),
    )
    unesco = records.sparkSession.createDataFrame([("organization-unesco", ["Entity", "Organization"], "UNESCO", "UNESCO", "Organization")], "entityId string, labels array<string>, label string, labelEn string, entityType string")
    unesco = unesco.join(own.select("entityId"), "entityId", "left_anti")
    return own.unionByName(unesco, allowMissingColumns=True)


def relation_edges(records: DataFrame) -> DataFrame:
    """src, type, dst of every relation, whether or not its ends exist."""
    edge = lambda e: lambda x: F.struct(F.lit(e).alias("type"), x.alias("dst"))
    every = F.flatten(F.array(*[F.transform(F.coalesce(F.col("relations")[f], F.array().cast("array<string>")), edge(e)) for f, e in EDGES.items()]))
    return records.select(F.col("entity_id").alias("src"), F.explode(every).alias("e")).select("src", "e.type", "e.dst").distinct()


def edges(relations: DataFrame, nodes_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges whose ends are nodes, dangling ones): nodes first, so the order of records does not matter."""
    ids = nodes_.select(F.col("entityId").alias("_id"))
    inside = relations.join(ids, relations["src"] == ids["_id"], "left_semi").join(ids, relations["dst"] == ids["_id"], "left_semi")
    return inside, relations.join(inside, ["src", "type", "dst"], "left_anti")


def same_as(records: DataFrame, reviews: DataFrame, base: str) -> DataFrame:
    """src, uri: from records' Wikidata ids and from verified reviews, each once."""
    own = records.filter(F.col("external_ids")["wikidata"].isNotNull()).select(F.col("entity_id").alias("src"), F.concat(F.lit("https://www.wikidata.org/entity/"), F.col("external_ids")["wikidata"]).alias("uri"))
    seen = reviews.filter("status = 'verified'").filter(F.startswith("source_uri", F.lit(base))).select(F.substr("source_uri", F.lit(len(base) + 1)).alias("src"), F.col("target_uri").alias("uri"))
    return own.unionByName(seen).distinct()


def label_counts(nodes_: DataFrame) -> DataFrame:
    return nodes_.select(F.explode("labels").alias("label")).groupBy("label").agg(F.count("*").alias("n"))
