"""Validation: record contracts, shapes over quads, parity of two result sets, gates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rdf import CLASSES, DCAT, DCT, PROV, TYPE, XSD


#: The canonical record's fields and allowed values.
FIELDS = """entity_id entity_type label_vi registry_id registry_category registry_url source_status coverage_snapshot source_page_id source_url retrieved_at aliases_vi
description_vi coordinates external_ids relations site_types construction_year recognition_year address birth_year death_year start_year end_year level country_code
parent_area museum_type organization_type artisan_title community location current_holder custodian object_type associated_intangible_heritage provenance""".split()
STATUSES = ("registry_only", "registry+wikipedia", "registry+enriched", "derived")
METHODS = ("registry", "mediawiki-api", "registry-plus-mediawiki-enrichment", "fixture", "derived")


def contract(record_columns: list[str]) -> list[tuple[str, Column]]:
    """(name, violated) of the canonical record's contract, for records of these columns; null is a field that is not there. Formats of URIs and times are not enforced."""
    have = set(record_columns)
    required = ("entity_id", "entity_type", "label_vi", "source_status", "retrieved_at", "provenance")
    out = [(f"required:{c}", F.col(c).isNull() if c in have else F.lit(True)) for c in required]
    within = lambda c, low, high: ~F.col(c).between(low, high)
    rules = [
        ("entity_id", "pattern:entity_id", ~F.col("entity_id").rlike("^[a-z0-9-]+$")), ("entity_type", "enum:entity_type", ~F.col("entity_type").isin(*CLASSES)),
        ("source_status", "enum:source_status", ~F.col("source_status").isin(*STATUSES)), ("source_page_id", "minimum:source_page_id", F.col("source_page_id") < 1),
        *[(c, f"minLength:{c}", F.length(c) < 1) for c in ("label_vi", "registry_id", "registry_category", "coverage_snapshot")],
        *[(c, f"uniqueItems:{c}", F.size(F.array_distinct(c)) < F.size(c)) for c in ("aliases_vi", "site_types")],
        *[(c, f"range:{c}", within(c, 1, 9999)) for c in FIELDS if c.endswith("_year")],
        ("coordinates", "range:coordinates", within("coordinates.lat", -90, 90) | within("coordinates.lon", -180, 180)),
        ("coordinates", "required:coordinates", F.col("coordinates").isNotNull() & (F.col("coordinates.lat").isNull() | F.col("coordinates.lon").isNull())),
        ("provenance", "required:provenance.fields", F.col("provenance").isNotNull() & (F.col("provenance.source").isNull() | F.col("provenance.method").isNull() | F.col("provenance.license").isNull())),
        ("provenance", "enum:provenance.method", ~F.col("provenance.method").isin(*METHODS)), ("provenance", "minLength:provenance.license", F.length("provenance.license") < 1),
    ]
    out += [(name, violated) for c, name, violated in rules if c in have]
    if "source_status" in have:  # a registry's record has the registry's fields
        of_registry = F.col("source_status").isin(*STATUSES[:3])
        out += [(f"conditional:{c}", of_registry & F.col(c).isNull() if c in have else of_registry) for c in ("registry_id", "registry_category", "registry_url", "coverage_snapshot")]
    return out + [(f"additional:{c}", F.col(f"`{c}`").isNotNull()) for c in record_columns if c not in FIELDS]


def violations(records: DataFrame, rules: list[tuple[str, Column]] | None = None, key: str = "entity_id") -> DataFrame:
    """key and rule of every violation: one pass, one array."""
    rules = contract(records.columns) if rules is None else rules
    return records.select(key, F.explode(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules]))).alias("rule"))


@dataclass(frozen=True)
class Property:
    path: str
    min_count: int = 0
    max_count: int | None = None
    kind: str | None = None
    datatype: str | None = None
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Shape:
    """Targets: subjects of a predicate, or members of a class."""

    name: str
    properties: tuple[Property, ...]
    subjects_of: str | None = None
    of_class: str | None = None


DATASET = Shape("Dataset", (
    Property(DCT + "identifier", 1, datatype=XSD + "string"), Property(DCT + "title", 1), Property(DCT + "license", 1, kind="iri"), Property(PROV + "wasGeneratedBy", 1, kind="iri"), Property(DCAT + "distribution", 5, kind="iri"),
), of_class=DCAT + "Dataset")
ACTIVITY = Shape("Activity", (Property(PROV + "startedAtTime", 1, datatype=XSD + "dateTime"),), of_class=PROV + "Activity")


def shape_violations(triples: DataFrame, shape: Shape) -> DataFrame:
    """s, shape, path, rule, n: one grouping by subject for all properties; subjects without a property count 0."""
    target = triples.filter(F.col("p") == shape.subjects_of) if shape.subjects_of else triples.filter((F.col("p") == TYPE) & (F.col("o") == shape.of_class))
    paths = [p.path for p in shape.properties]
    aggs, checks = [], []
    for i, p in enumerate(shape.properties):
        mine = F.col("p") == p.path
        value = F.col("o").try_cast("double")
        bad = {"count": mine}
        if p.kind:
            bad["nodeKind"] = mine & (F.col("o_kind") != p.kind)
        if p.datatype:
            dt = F.when((F.col("o_kind") == "literal") & (F.col("o_dt") == "") & (F.col("o_lang") == ""), XSD + "string").otherwise(F.col("o_dt"))
            bad["datatype"] = mine & (dt != p.datatype)
        if p.low is not None:
            bad["minInclusive"] = mine & ~F.coalesce(value >= p.low, F.lit(False))
        if p.high is not None:
            bad["maxInclusive"] = mine & ~F.coalesce(value <= p.high, F.lit(False))
        aggs += [F.count_if(c).alias(f"_{i}_{r}") for r, c in bad.items()]
        n = F.coalesce(f"_{i}_count", F.lit(0))
        row = lambda rule, k, p=p: F.struct(F.lit(p.path).alias("path"), F.lit(rule).alias("rule"), k.alias("n"))
        checks.append(F.when(n < p.min_count, row("minCount", n)))
        if p.max_count is not None:
            checks.append(F.when(n > p.max_count, row("maxCount", n)))
        checks += [F.when(F.col(f"_{i}_{r}") > 0, row(r, F.col(f"_{i}_{r}"))) for r in bad if r != "count"]
    per = triples.filter(F.col("p").isin(*paths)).dropDuplicates(["s", "p", "o", "o_kind", "o_lang", "o_dt"]).groupBy("s").agg(*aggs)
    return target.select("s").distinct().join(per, "s", "left").select("s", F.lit(shape.name).alias("shape"), F.explode(F.array_compact(F.array(*checks))).alias("v")).select("s", "shape", "v.*")


def parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one set only, with side: both sets have the same columns in any order."""
    right = right.select(*left.columns)
    a, b = left.distinct(), right.distinct()
    return a.join(b, left.columns, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, left.columns, "left_anti").withColumn("side", F.lit("right")))


def in_order_mismatches(got: DataFrame, expected: DataFrame, order: str) -> DataFrame:
    """Places (column order, of both) at which two results differ, or which one of them lacks. Nulls equal nulls; columns have to be the same set."""
    if set(got.columns) != set(expected.columns):
        raise ValueError(f"CQ_EXPECTED_MISMATCH: columns {sorted(got.columns)} and {sorted(expected.columns)}")
    packed = lambda df, name: df.select(order, F.struct(*sorted(got.columns)).alias(name))
    return packed(got, "got").join(packed(expected, "expected"), order, "full").filter(~F.col("got").eqNullSafe(F.col("expected")))


def gate(checks: DataFrame) -> DataFrame:
    """n, passed and ok of checks (name, ok)."""
    return checks.agg(F.count("*").alias("n"), F.count_if("ok").alias("passed"), F.every("ok").alias("ok"))
