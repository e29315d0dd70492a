"""The query service: faceted search, statistics, entity detail, the query catalogue. Parameters become column predicates, never query text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators.rdf import CLASSES, DCT, LABEL, ONT, OWL, PROV, RES, SAME_AS, TERM, TYPE, XSD


class ServiceError(ValueError):
    def __init__(self, status: int, code: str, message: str = ""):
        super().__init__(f"{code}: {message}")
        self.status, self.code = status, code


def page_number(value, default: int, most: int | None = None) -> int:
    if value is None or value == "":
        return default
    if not re.fullmatch(r"[0-9]+", str(value)) or int(value) < 1 or (most and int(value) > most):
        raise ServiceError(400, "INVALID_PAGINATION", f"{value} is no page or size")
    return int(value)


def entities(triples: DataFrame, prefix: str = RES, langs: tuple[str, ...] = ("vi", "en", "")) -> DataFrame:
    """A row for each labelled resource: s, label, label_lang, and lists of types, categories, locations, years, links, sources. One grouping by subject instead of a join for each field."""
    p, o = F.col("p"), F.col("o")
    of = lambda x: F.when(p == x, o)
    years = F.when((p == ONT + "recognitionYear") & (F.col("o_dt") == XSD + "gYear"), o)
    wanted = [TYPE, LABEL, DCT + "subject", ONT + "address", ONT + "recognitionYear", ONT + "constructionYear", SAME_AS, PROV + "wasDerivedFrom"]
    label = F.when((p == LABEL) & F.col("o_lang").isin(*langs), F.struct(o.alias("value"), F.col("o_lang").alias("lang")))
    return triples.filter(F.startswith("s", F.lit(prefix)) & p.isin(*wanted)).groupBy("s").agg(
        F.min(label).alias("label"), *[F.sort_array(F.collect_set(c)).alias(n) for n, c in (
            ("types", of(TYPE)), ("categories", of(DCT + "subject")), ("locations", of(ONT + "address")), ("recognition_years", years), ("construction_years", of(ONT + "constructionYear")),
            ("external_links", of(SAME_AS)), ("sources", of(PROV + "wasDerivedFrom")))],
    ).filter(F.col("label").isNotNull() & (F.size("types") > 0))


def conditions(params: dict[str, str]) -> list[Column]:
    """Predicates over entities(); wrong parameters fail as the service's do."""
    get = lambda k: (params.get(k) or "").strip()
    has = lambda c, x: F.contains(F.lower(c), F.lower(F.lit(x)))
    out = []
    if q := get("q"):
        out.append(has(F.col("label.value"), q) | F.exists("locations", lambda x: has(x, q)))
    if kind := get("entity_type"):
        if kind not in (*CLASSES, "CulturalHeritageEntity", "UNESCOHeritageSite"):
            raise ServiceError(400, "INVALID_ENTITY_TYPE", kind)
        out.append(F.array_contains("types", ONT + kind))
    if cat := get("registry_category"):
        if not re.fullmatch(r"[a-z0-9_-]+", cat):
            raise ServiceError(400, "INVALID_CATEGORY", cat)
        out.append(F.array_contains("categories", RES + "category/" + cat))
    if place := get("location"):
        out.append(F.exists("locations", lambda x: has(x, place)))
    if year := get("year"):
        if not re.fullmatch(r"[1-9][0-9]{0,3}", year):
            raise ServiceError(400, "INVALID_YEAR", year)
        out.append(F.array_contains("recognition_years", year) | F.array_contains("construction_years", year))
    return out


def search(found: DataFrame, params: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(one row with total, a page of entities): pages are of entities in order of label, then id; both come from one table of entities."""
    page, size = page_number(params.get("page"), 1), page_number(params.get("page_size"), 25, 100)
    for c in conditions(params):
        found = found.filter(c)
    rows = found.orderBy(F.lower("label.value"), "s").offset((page - 1) * size).limit(size)
    first = F.coalesce(F.try_element_at("recognition_years", F.lit(1)), F.try_element_at("construction_years", F.lit(1)))
    items = rows.select(
        F.col("s").alias("id"), "label.value", "label.lang", "types", "categories", F.try_element_at("locations", F.lit(-1)).alias("location"), first.alias("year"), "external_links", "sources",
        F.when(F.exists("sources", lambda x: F.contains(x, F.lit("wikipedia.org"))), "registry+wikipedia").otherwise("registry_only").alias("source_status"),
    )
    return found.agg(F.count("*").alias("total")), items


def stats(triples: DataFrame, root: str = ONT + "CulturalHeritageEntity", prefix: str = RES) -> dict[str, DataFrame]:
    mine = triples.filter(F.startswith("s", F.lit(prefix)))
    labelled = mine.filter(F.col("p") == LABEL).select("s").distinct()
    types = mine.filter(F.col("p") == TYPE).select("s", "o").join(labelled, "s")
    return {
        "total": types.filter(F.col("o") == root).agg(F.count_distinct("s").alias("total")),
        "classes": types.filter(F.col("o") != OWL + "Thing").groupBy(F.col("o").alias("type")).agg(F.count_distinct("s").alias("count")),
        "categories": mine.filter(F.col("p") == DCT + "subject").groupBy(F.col("o").alias("category")).agg(F.count_distinct("s").alias("count")),
        "links": mine.filter(F.col("p") == SAME_AS).agg(F.count("*").alias("count")),
    }


def entity(quads: DataFrame, entity_id: str, prefix: str = RES) -> dict[str, DataFrame]:
    """asserted and inferred statements of one entity, those inferred that are new, and its fields by predicate."""
    mine = quads.filter(F.col("s") == prefix + t.check_entity_id(entity_id))
    inferred = mine.filter(F.col("g") == "inferred")
    asserted = mine.filter(F.col("g") != "inferred")
    keys = [c for c in TERM if c != "s"]
    fields = mine.dropDuplicates(list(TERM)).groupBy("p").agg(F.sort_array(F.collect_list("o")).alias("values"))
    return {"asserted": asserted, "inferred": inferred, "novel": inferred.dropDuplicates(keys).join(asserted, keys, "left_anti"), "fields": fields}


def catalogue(files: dict[str, str], wanted: str | None = None) -> list[tuple[str, str]] | str:
    """(id, sha256) of the allowed queries, or one query's text."""
    import hashlib

    if wanted is None:
        return sorted((k, hashlib.sha256(v.encode()).hexdigest()) for k, v in files.items())
    if not re.fullmatch(r"CQ[0-9]{2}", wanted):
        raise ServiceError(400, "QUERY_NOT_FOUND", wanted)
    for k, v in files.items():
        if k.startswith(wanted):
            return v
    raise ServiceError(404, "QUERY_NOT_FOUND", wanted)
