"""Canonical records to quads. One pass over the records: every rule is an element of one array, exploded once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t

BASE = "https://kg.example.org/"
ONT, RES = BASE + "ontology/", BASE + "resource/"
RDF, RDFS, OWL, XSD = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2000/01/rdf-schema#", "http://www.w3.org/2002/07/owl#", "http://www.w3.org/2001/XMLSchema#"
DCT, PROV, SKOS, GEO, DCAT = "http://purl.org/dc/terms/", "http://www.w3.org/ns/prov#", "http://www.w3.org/2004/02/skos/core#", "http://www.w3.org/2003/01/geo/wgs84_pos#", "http://www.w3.org/ns/dcat#"
TYPE, LABEL, SAME_AS = RDF + "type", RDFS + "label", OWL + "sameAs"
WIKIDATA = "https://www.wikidata.org/entity/"
COLUMNS = ("s", "s_kind", "p", "o", "o_kind", "o_lang", "o_dt", "g")
TERM = ("s", "p", "o", "o_kind", "o_lang", "o_dt")
#: Classes of entities, of site types by words in them, and predicates of relation fields.
CLASSES = (
    "HeritageSite", "AdministrativeArea", "HistoricalPerson", "HistoricalEvent", "HistoricalPeriod", "HeritageComplex", "Organization", "ArchitecturalStyle", "Museum",
    "IntangibleHeritage", "NationalTreasure", "DocumentaryHeritage", "Artisan", "CulturalObject",
)
SITE_WORDS = {"lịch sử": "HistoricalSite", "tôn giáo": "ReligiousSite", "khảo cổ": "ArchaeologicalSite", "kiến trúc": "ArchitecturalSite"}
RELATIONS = {
    "located_in": "locatedIn", "parent_area": "locatedIn", "associated_persons": "associatedWithPerson", "associated_events": "associatedWithEvent", "periods": "belongsToPeriod",
    "part_of": "partOf", "member_sites": "hasMember", "recognized_by": "recognizedBy", "architectural_styles": "hasArchitecturalStyle",
}
SUBCLASS_BY_CATEGORY = {"intangible_representative": "RepresentativeIntangibleHeritage", "intangible_urgent": "UrgentSafeguardingIntangibleHeritage", "national_intangible": "NationalIntangibleHeritage"}


def _term(p: str, o: Column, kind: str, lang: str = "", dt: str = "", s: Column | None = None) -> Column:
    """One triple as a struct, null where its object is."""
    fields = F.struct((s if s is not None else F.col("_s")).alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), F.lit(lang).alias("o_lang"), F.lit(dt).alias("o_dt"))
    return F.when(o.isNotNull(), fields)


def iri(p: str, o: Column, s: Column | None = None) -> Column:
    return _term(p, o, "iri", s=s)


def literal(p: str, o: Column, lang: str = "", dt: str = "", s: Column | None = None) -> Column:
    return _term(p, o, "literal", lang, dt, s)


def quads_of(df: DataFrame, subject: Column, graph: str, triples: list[Column], lists: list[Column] = ()) -> DataFrame:
    """Quads of each row: triples (structs or null) and lists (arrays of such)."""
    none = F.array().cast("array<struct<s:string,p:string,o:string,o_kind:string,o_lang:string,o_dt:string>>")
    every = F.concat(F.array(*triples), *[F.coalesce(x, none) for x in lists])
    out = df.withColumn("_s", subject).select(F.explode(F.array_compact(every)).alias("q")).select("q.*")
    return out.select("s", F.lit("iri").alias("s_kind"), "p", "o", "o_kind", "o_lang", "o_dt", F.lit(graph).alias("g"))


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def record_quads(records: DataFrame, subclasses: bool = True, graph: str = "data") -> DataFrame:
    """All rules over canonical records; columns that records lack count as null. A set: repeated triples fall together."""
    have = {f.name for f in records.schema}
    col = lambda c, kind="string": F.col(c) if c in have else F.lit(None).cast(kind)
    resource = lambda c: F.concat(F.lit(RES), c)
    year = lambda p, c: literal(ONT + p, F.when(col(c, "int") != 0, col(c, "int")), dt=XSD + "gYear")
    category, label = _filled(col("registry_category")), _filled(col("label_vi"))
    concept = resource(F.concat(F.lit("category/"), t.slug(category)))
    both = col("coordinates.lat", "double") if "coordinates" not in have else F.col("coordinates.lat")
    lon = F.col("coordinates.lon") if "coordinates" in have else F.lit(None).cast("double")
    lat = F.when(lon.isNotNull(), both)
    lon = F.when(both.isNotNull(), lon)
    triples = [
        iri(TYPE, F.when(col("entity_type").isin(*CLASSES), F.concat(F.lit(ONT), col("entity_type")))),
        iri(TYPE, F.when(category == "world_heritage", F.lit(ONT + "UNESCOHeritageSite"))),
        literal(LABEL, label, lang="vi"),
        literal(RDFS + "comment", _filled(col("description_vi")), lang="vi"), literal(DCT + "description", _filled(col("description_vi")), lang="vi"),
        *[year(p, c) for p, c in (("constructionYear", "construction_year"), ("recognitionYear", "recognition_year"), ("birthYear", "birth_year"), ("deathYear", "death_year"))],
        literal(ONT + "address", _filled(col("address"))), literal(GEO + "lat", lat, dt=XSD + "decimal"), literal(GEO + "long", lon, dt=XSD + "decimal"),
        literal(ONT + "sourcePageId", F.when(col("source_page_id", "bigint") != 0, col("source_page_id", "bigint")), dt=XSD + "integer"), literal(ONT + "sourceTitle", _filled(col("title"))),
        iri(DCT + "subject", F.when(category.isNotNull(), concept)), iri(TYPE, F.when(category.isNotNull(), F.lit(SKOS + "Concept")), s=concept), literal(SKOS + "prefLabel", category, lang="en", s=concept),
        literal(DCT + "license", _filled(F.col("provenance.license")) if "provenance" in have else F.lit(None).cast("string")),
        iri(SAME_AS, F.concat(F.lit(WIKIDATA), _filled(F.col("external_ids")["wikidata"])) if "external_ids" in have else F.lit(None).cast("string")),
    ]
    if subclasses:
        triples.append(iri(TYPE, F.coalesce(*[F.when(category == k, F.lit(ONT + v)) for k, v in SUBCLASS_BY_CATEGORY.items()])))
    lists = []
    to = lambda p: lambda x: iri(p, resource(x))
    at = lambda p: lambda x: iri(p, x)
    if "site_types" in have:
        triples += [iri(TYPE, F.when(F.contains(F.array_join(F.transform("site_types", lambda x: F.lower(F.trim(x))), "\n"), F.lit(w)), F.lit(ONT + c))) for w, c in SITE_WORDS.items()]
    if "aliases_vi" in have:
        lists.append(F.transform(F.filter("aliases_vi", lambda a: (a != "") & ~a.eqNullSafe(F.col("label_vi"))), lambda a: literal(SKOS + "altLabel", a, lang="vi")))
    if "relations" in have:
        for f, p in RELATIONS.items():
            lists.append(F.transform(F.col("relations")[f], to(ONT + p)))
        person = F.coalesce(F.try_element_at(F.col("relations")["built_by_type"], F.lit(1)), F.lit("HistoricalPerson")) == "HistoricalPerson"
        for p, when in (("builtBy", person), ("recognizedBy", ~person)):
            lists.append(F.when(when, F.transform(F.col("relations")["built_by"], to(ONT + p))))
    source = [_filled(col(c)) for c in ("registry_url", "source_url")]
    if "provenance" in have:
        source.insert(0, _filled(F.col("provenance.source")))
    sources = F.array_distinct(F.array_compact(F.array(*source)))
    lists += [F.transform(sources, at(p)) for p in (DCT + "source", PROV + "wasDerivedFrom")]
    return quads_of(records, resource(F.col("entity_id")), graph, triples, lists).dropDuplicates(list(TERM))


#: A dataset's distributions and the graph of each.
DISTRIBUTIONS = {"ontology": "ontology", "asserted": "data", "external-links": "external-links", "inferred": "inferred", "metadata": "metadata"}


def extents(records: DataFrame, quads: DataFrame, delta: int | None = None, dataset: str = RES + "dataset/main", graph: str = "metadata") -> DataFrame:
    """Quads "key=value" of a dataset: numbers of records, of asserted and inferred triples, of links; delta: of triples new by inference, if known."""
    of = lambda g: F.count_if(F.col("g") == g)
    n = quads.agg(of("data").alias("asserted"), of("inferred").alias("inferred"), F.count_if((F.col("g") == "external-links") & (F.col("p") == SAME_AS)).alias("links"))
    counts = records.agg(F.count("*").alias("records")).crossJoin(n)  # one row and one row
    named = {"registry_records": "records", "canonical_records": "records", "asserted_triples": "asserted", "inferred_closure_triples": "inferred", "verified_external_links": "links"}
    values = [F.concat(F.lit(f"{k}="), F.col(c).cast("string")) for k, c in named.items()] + ([F.lit(f"inferred_delta_triples={delta}")] if delta is not None else [])
    return quads_of(counts, F.lit(dataset), graph, [literal(DCT + "extent", v) for v in values])


def dataset_metadata(
    records: DataFrame, quads: DataFrame, titles: list[tuple[str, str]], description: tuple[str, str], licence: str, service: str, coverage: DataFrame | None = None, delta: int | None = None,
    dataset: str = RES + "dataset/main", graph: str = "metadata",
) -> DataFrame:
    """A dataset with titles, description (text, language) and licence, its activity with first and last retrieval, its manifest, sources, extents and distributions.

    records: coverage_snapshot, retrieved_at, registry_url, source_url; coverage: url and checksum (or null) of pages that were looked at.
    """
    span = records.agg(F.coalesce(F.min("coverage_snapshot"), F.lit("unknown")).alias("snapshot"), F.min("retrieved_at").alias("first"), F.max("retrieved_at").alias("last"))
    s, snapshot = F.lit(dataset), F.col("snapshot")
    activity, manifest = F.concat(F.lit(RES + "activity/"), snapshot), F.concat(F.lit(RES + "manifest/"), snapshot)
    parts = []
    for name, g in DISTRIBUTIONS.items():
        part, uri = F.lit(f"{dataset}/distribution/{name}"), BASE + "graph/" + g
        parts += [iri(DCAT + "distribution", part), iri(TYPE, F.lit(DCAT + "Distribution"), s=part), literal(DCAT + "mediaType", F.lit("text/turtle"), s=part), iri(DCT + "identifier", F.lit(uri), s=part), iri(DCAT + "accessURL", F.lit(f"{service}?graph={uri}"), s=part)]
    whole = quads_of(span, s, graph, [
        iri(TYPE, F.lit(DCAT + "Dataset")), *[literal(DCT + "title", F.lit(x), lang=lang) for x, lang in titles], literal(DCT + "description", F.lit(description[0]), lang=description[1]), literal(DCT + "identifier", snapshot), iri(DCT + "license", F.lit(licence)),
        literal(DCT + "issued", snapshot, dt=XSD + "string"), literal(DCT + "modified", F.col("last"), dt=XSD + "dateTime"), iri(PROV + "wasGeneratedBy", activity), iri(PROV + "wasDerivedFrom", manifest),
        iri(TYPE, F.lit(PROV + "Activity"), s=activity), literal(DCT + "identifier", snapshot, s=activity), literal(PROV + "startedAtTime", F.col("first"), dt=XSD + "dateTime", s=activity), literal(PROV + "endedAtTime", F.col("last"), dt=XSD + "dateTime", s=activity),
        iri(TYPE, F.lit(PROV + "Entity"), s=manifest), literal(DCT + "identifier", snapshot, s=manifest), *parts,
    ])
    urls = records.select(F.explode(F.array_compact(F.array("registry_url", "source_url"))).alias("u"))
    if coverage is not None:
        urls = urls.unionByName(coverage.select(F.col("url").alias("u")))
        sums = coverage.filter("url IS NOT NULL AND checksum IS NOT NULL").crossJoin(F.broadcast(span.select("snapshot")))  # one row
        whole = whole.unionByName(quads_of(sums, manifest, graph, [literal(DCT + "description", F.concat("url", F.lit(" sha256="), "checksum"))]))
    sources = quads_of(urls.filter("u <> ''").distinct(), s, graph, [iri(DCT + "source", F.col("u"))])
    return whole.unionByName(sources).unionByName(extents(records, quads, delta, dataset, graph)).dropDuplicates(list(TERM))


def triple_counts(quads: DataFrame) -> DataFrame:
    return quads.groupBy("g").agg(F.count("*").alias("n"))


def refreshed(quads: DataFrame, new: DataFrame, dataset: str = RES + "dataset/main", graph: str = "metadata") -> DataFrame:
    """quads with the dataset's extents replaced by new ones."""
    old = (F.col("g") == graph) & (F.col("s") == dataset) & (F.col("p") == DCT + "extent")
    return quads.filter(~old).unionByName(new)


def union_graph(quads: DataFrame, graphs: list[str] | None = None) -> DataFrame:
    """The default graph: distinct triples of all graphs, or of some."""
    some = quads.filter(F.col("g").isin(*graphs)) if graphs else quads
    return some.drop("g").dropDuplicates([*TERM])


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in COLUMNS))
