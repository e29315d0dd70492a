"""The driver's tables as a knowledge graph: quads, schema, canonical records. Each view has the same rows in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import rdf
from .operators.rdf import DCT, GEO, LABEL, ONT, OWL, PROV, RDFS, RES, SAME_AS, TYPE, WIKIDATA, XSD, iri, literal, quads_of
from .sources.readers import QUAD, turtle

SCHEMA_TURTLE = f"""
@prefix o: <{ONT}> . @prefix rdfs: <{RDFS}> . @prefix owl: <{OWL}> . @prefix rdf: <{rdf.RDF}> .
o:UNESCOHeritageSite rdfs:subClassOf o:HeritageSite . o:HeritageSite rdfs:subClassOf o:CulturalHeritageEntity .
o:CulturalObject rdfs:subClassOf o:CulturalHeritageEntity . o:CulturalHeritageEntity rdfs:subClassOf owl:Thing .
o:HistoricalPerson owl:equivalentClass o:Person .
o:partOf a owl:ObjectProperty , owl:TransitiveProperty ; owl:inverseOf o:hasPart .
o:hasMember rdfs:subPropertyOf o:hasPart . o:builtBy rdfs:subPropertyOf o:associatedWithPerson .
o:hasRelatedSite a owl:SymmetricProperty .
"""


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def schema_quads(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(turtle(SCHEMA_TURTLE, "ontology"), QUAD)


def _id(prefix: str, c: str):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _res(prefix: str, c):
    return F.concat(F.lit(RES + prefix), (F.col(c) if isinstance(c, str) else c).cast("string"))


def quads(spark: SparkSession, d: str) -> DataFrame:
    """Graphs data, external-links and inferred, without the schema. One pass over each table for each graph."""
    t = lambda n: table(spark, d, n)
    typed = lambda c: iri(TYPE, F.lit(ONT + c))
    high = F.col("s_acctbal") > 5000
    wikidata = iri(SAME_AS, F.when(F.col("s_acctbal") > 0, F.concat(F.lit(WIKIDATA + "Q"), F.col("s_suppkey").cast("string"))))
    site, part = _res("site-", "s_suppkey"), _res("part-", "p_partkey")
    source = F.when(F.col("p_retailprice") > 950, F.concat(F.lit("https://source.example.org/part/"), F.col("p_partkey").cast("string")))
    out = [
        quads_of(t("region"), _res("region-", "r_regionkey"), "data", [typed("AdministrativeArea"), literal(LABEL, F.col("r_name"), lang="en")]),
        quads_of(t("nation"), _res("nation-", "n_nationkey"), "data", [typed("AdministrativeArea"), literal(LABEL, F.col("n_name"), lang="en"), iri(ONT + "locatedIn", _res("region-", "n_regionkey"))]),
        quads_of(t("supplier"), site, "data", [
            typed("HeritageSite"), iri(TYPE, F.when(high, F.lit(ONT + "UNESCOHeritageSite"))), literal(LABEL, F.col("s_name"), lang="vi"), iri(ONT + "locatedIn", _res("nation-", "s_nationkey")), wikidata,
            iri(ONT + "builtBy", F.when(high, _res("person-", "s_suppkey"))), iri(ONT + "hasMember", F.when(high, _res("part-", "s_suppkey"))), iri(ONT + "hasRelatedSite", F.when(high, _res("site-", F.col("s_suppkey") + 1))),
            iri(ONT + "recognizedBy", F.when(F.col("s_acctbal") > 7000, F.lit(RES + "organization-unesco"))), literal(ONT + "address", F.concat(F.lit("Street "), F.col("s_suppkey").cast("string"))),
        ]),
        quads_of(t("customer"), _res("person-", "c_custkey"), "data", [typed("HistoricalPerson"), literal(LABEL, F.col("c_name"), lang="vi"), iri(ONT + "locatedIn", _res("nation-", "c_nationkey")), iri(DCT + "subject", _res("category/", F.lower("c_mktsegment")))]),
        quads_of(t("part"), part, "data", [
            typed("CulturalObject"), literal(LABEL, F.col("p_name"), lang="vi"), literal(LABEL, F.when(F.col("p_size") <= 10, F.col("p_name")), lang="en"), iri(ONT + "partOf", F.when(F.col("p_partkey") > 0, _res("part-", F.floor(F.col("p_partkey") / 2)))),
            literal(ONT + "recognitionYear", F.when(F.col("p_size") <= 30, 1900 + F.col("p_size")), dt=XSD + "gYear"),
            literal(GEO + "lat", F.col("p_size") * 4 - 95, dt=XSD + "decimal"), literal(GEO + "long", F.col("p_size") * 8 - 190, dt=XSD + "decimal"), iri(DCT + "source", source), iri(PROV + "wasDerivedFrom", source),
        ]),
        quads_of(t("orders"), _res("event-", "o_orderkey"), "data", [typed("HistoricalEvent"), literal(LABEL, F.concat(F.lit("Event "), F.col("o_orderkey").cast("string")), lang="vi"), iri(ONT + "associatedWithPerson", _res("person-", "o_custkey"))]),
        quads_of(t("supplier"), site, "external-links", [wikidata]),
        quads_of(t("supplier"), site, "inferred", [typed("CulturalHeritageEntity"), iri(TYPE, F.when(high, F.lit(ONT + "HeritageSite")))]),
    ]
    whole = out[0]
    for x in out[1:]:
        whole = whole.unionByName(x)
    return whole


def _sql_part(frame: str, subject: str, graph: str, rows: list[tuple]) -> str:
    """rows: (predicate, object SQL, kind, lang, datatype); null objects are left out."""
    return " union all ".join(f"select {subject} as s, 'iri' as s_kind, '{p}' as p, cast({o} as varchar) as o, '{k}' as o_kind, '{lang}' as o_lang, '{dt}' as o_dt, '{graph}' as g from {frame} where ({o}) is not null" for p, o, k, lang, dt in rows)


def _r(prefix: str, expression: str) -> str:
    return f"'{RES}{prefix}' || {expression}"


_site, _part = _r("site-", "s_suppkey"), _r("part-", "p_partkey")
_wd = f"case when s_acctbal > 0 then '{WIKIDATA}Q' || s_suppkey end"
_src = "case when p_retailprice > 950 then 'https://source.example.org/part/' || p_partkey end"
_high = lambda x: f"case when s_acctbal > 5000 then {x} end"
QUADS_SQL = "quads as (" + " union all ".join([
    _sql_part("region", _r("region-", "r_regionkey"), "data", [(TYPE, f"'{ONT}AdministrativeArea'", "iri", "", ""), (LABEL, "r_name", "literal", "en", "")]),
    _sql_part("nation", _r("nation-", "n_nationkey"), "data", [(TYPE, f"'{ONT}AdministrativeArea'", "iri", "", ""), (LABEL, "n_name", "literal", "en", ""), (ONT + "locatedIn", _r("region-", "n_regionkey"), "iri", "", "")]),
    _sql_part("supplier", _site, "data", [
        (TYPE, f"'{ONT}HeritageSite'", "iri", "", ""), (TYPE, _high(f"'{ONT}UNESCOHeritageSite'"), "iri", "", ""), (LABEL, "s_name", "literal", "vi", ""), (ONT + "locatedIn", _r("nation-", "s_nationkey"), "iri", "", ""), (SAME_AS, _wd, "iri", "", ""),
        (ONT + "builtBy", _high(_r("person-", "s_suppkey")), "iri", "", ""), (ONT + "hasMember", _high(_r("part-", "s_suppkey")), "iri", "", ""), (ONT + "hasRelatedSite", _high(_r("site-", "(s_suppkey + 1)")), "iri", "", ""),
        (ONT + "recognizedBy", f"case when s_acctbal > 7000 then '{RES}organization-unesco' end", "iri", "", ""), (ONT + "address", "'Street ' || s_suppkey", "literal", "", ""),
    ]),
    _sql_part("customer", _r("person-", "c_custkey"), "data", [(TYPE, f"'{ONT}HistoricalPerson'", "iri", "", ""), (LABEL, "c_name", "literal", "vi", ""), (ONT + "locatedIn", _r("nation-", "c_nationkey"), "iri", "", ""), (DCT + "subject", _r("category/", "lower(c_mktsegment)"), "iri", "", "")]),
    _sql_part("part", _part, "data", [
        (TYPE, f"'{ONT}CulturalObject'", "iri", "", ""), (LABEL, "p_name", "literal", "vi", ""), (LABEL, "case when p_size <= 10 then p_name end", "literal", "en", ""), (ONT + "partOf", f"case when p_partkey > 0 then {_r('part-', '(p_partkey // 2)')} end", "iri", "", ""),
        (ONT + "recognitionYear", "case when p_size <= 30 then 1900 + p_size end", "literal", "", XSD + "gYear"), (GEO + "lat", "p_size * 4 - 95", "literal", "", XSD + "decimal"), (GEO + "long", "p_size * 8 - 190", "literal", "", XSD + "decimal"),
        (DCT + "source", _src, "iri", "", ""), (PROV + "wasDerivedFrom", _src, "iri", "", ""),
    ]),
    _sql_part("orders", _r("event-", "o_orderkey"), "data", [(TYPE, f"'{ONT}HistoricalEvent'", "iri", "", ""), (LABEL, "'Event ' || o_orderkey", "literal", "vi", ""), (ONT + "associatedWithPerson", _r("person-", "o_custkey"), "iri", "", "")]),
    _sql_part("supplier", _site, "external-links", [(SAME_AS, _wd, "iri", "", "")]),
    _sql_part("supplier", _site, "inferred", [(TYPE, f"'{ONT}CulturalHeritageEntity'", "iri", "", ""), (TYPE, _high(f"'{ONT}HeritageSite'"), "iri", "", "")]),
]) + "), triples as (select distinct s, s_kind, p, o, o_kind, o_lang, o_dt from quads), schema_q as (select * from (values " + ", ".join(
    "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in row) + ")" for row in turtle(SCHEMA_TURTLE, "ontology")
) + ") v(s, s_kind, p, o, o_kind, o_lang, o_dt, g))"


def raw_records(spark: SparkSession, d: str) -> DataFrame:
    """Documents as records of a registry: the first line is the label, the source the category; another language's records lack a label."""
    doc = table(spark, d, "documents")
    label = F.element_at(F.split("text", "\n"), 1)
    return doc.select(
        "doc_id", _id("doc-", "doc_id").alias("registry_id"), F.col("source").alias("registry_category"), F.when(F.col("lang") != "es", label).alias("label_vi"),
        F.concat(F.lit("https://registry.example.org/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("registry_url"), F.lit("registry_only").alias("source_status"),
        F.lit("20240101T000000Z").alias("coverage_snapshot"), F.lit("2024-01-01T00:00:00Z").alias("retrieved_at"), "lang", "n_chars",
    )


RAW_SQL = """raw as (select doc_id, 'doc-' || doc_id as registry_id, source as registry_category, case when lang <> 'es' then string_split(text, chr(10))[1] end as label_vi,
  'https://registry.example.org/' || source || '/' || doc_id as registry_url, lang, n_chars from documents)"""
