"""Records: normalisation, identity, duplicate merging, mapping, enrichment, coverage."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as t

REQUIRED = ("registry_id", "registry_category", "label_vi", "registry_url", "source_status", "coverage_snapshot", "retrieved_at")


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """df with `name`, 1 for the first row by `order`: ranges are counted, counts are summed, and rows are numbered inside each range."""
    ranged = df.repartitionByRange(order).withColumn("_part", F.spark_partition_id())
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    offsets = counts.select("_part", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return ranged.withColumn("_at", inside).join(offsets, "_part").withColumn(name, F.col("_at") + F.col("_before")).drop("_part", "_at", "_before")


def missing_fields(required: tuple[str, ...] = REQUIRED) -> Column:
    """Names of required columns that are null or empty."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(c)) for c in required]))


def split_required(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields, and the rest with error and missing_fields."""
    marked = df.withColumn("missing_fields", missing_fields(required))
    bad = marked.filter(F.size("missing_fields") > 0).select("registry_id", F.lit("RAW_MISSING_CORE").alias("error"), "missing_fields")
    return marked.filter(F.size("missing_fields") == 0).drop("missing_fields"), bad


def normalized(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, skipped): labels and optional fields cleaned, _identity_key and _warnings added."""
    ok, skipped = split_required(raw)
    has = set(ok.columns)
    out = ok.withColumn("label_vi", t.display_label(F.col("label_vi"))).withColumn("_identity_key", t.identity_key(F.col("label_vi")))
    warnings = []
    if "coordinates" in has:
        out = out.withColumn("_c", t.coordinate(t.latitude(F.col("coordinates.lat").cast("string")), t.longitude(F.col("coordinates.lon").cast("string"))))
        out = out.withColumn("coordinates", F.when(F.col("_c.lat").isNotNull(), F.struct(F.col("_c.lat").alias("lat"), F.col("_c.lon").alias("lon"))))
        warnings.append(F.col("_c.warning"))
    if "wikidata_id" in has:
        out = out.withColumn("_q", t.qid(F.col("wikidata_id"))).withColumn("wikidata_id", F.col("_q.qid"))
        warnings.append(F.col("_q.warning"))
    if "categories" in has:
        out = out.withColumn("categories", F.transform("categories", t.category))
    found = F.array_compact(F.array(*warnings)) if warnings else F.array().cast("array<string>")
    return out.withColumn("_warnings", found).drop("_c", "_q"), skipped


def registry_entity_id(registry_id: Column) -> Column:
    s = t.slug(registry_id)
    return F.when(F.startswith(s, F.lit("registry-")), s).otherwise(F.concat(F.lit("registry-"), s))


def entity_id() -> Column:
    """The id of a record with registry_id, entity_type, wikidata_id, page_id, start_year, end_year, _identity_key, label_vi: the registry's first, then by type."""
    kind, q = F.col("entity_type"), F.lower(F.nullif("wikidata_id", F.lit("")))
    name = F.coalesce(F.nullif("_identity_key", F.lit("")), F.lower(F.trim("label_vi")), F.lit(""))
    start, end = (F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("0")), F.lit("")) for c in ("start_year", "end_year"))
    named = lambda prefix, x: F.concat(F.lit(prefix), t.sha12(x))
    by_qid = lambda p: F.coalesce(F.concat(F.lit(f"{p}-wikidata-"), q), named(f"{p}-name-", name))
    return (
        F.when(F.coalesce("registry_id", F.lit("")) != "", registry_entity_id(F.col("registry_id")))
        .when(kind == "HistoricalPerson", by_qid("person")).when(kind == "AdministrativeArea", by_qid("area"))
        .when(kind == "HistoricalEvent", named("event-", F.concat(name, start))).when(kind == "HistoricalPeriod", named("period-", F.concat(name, start, end)))
        .when(kind == "HeritageComplex", named("complex-", name)).when(kind == "Organization", named("organization-", name)).when(kind == "ArchitecturalStyle", named("style-", name))
        .otherwise(F.coalesce(F.concat(F.lit("derived-wikidata-"), q), F.concat(F.lit("derived-page-"), F.nullif(F.col("page_id").cast("string"), F.lit("0"))), named("derived-", F.concat(F.coalesce(kind, F.lit("")), name))))
    )


def merge_duplicates(df: DataFrame, key: str = "_entity_id", order: str = "pos", arrays: tuple[str, ...] = ("aliases_vi", "categories")) -> DataFrame:
    """One row for each key: the first value that is not null of every column by order, arrays joined in order, n_merged.

    Arrays of a key are gathered as distinct (element, first place) rows first, so that a key with very many rows holds no more than its result.
    """
    scalars = [c for c in df.columns if c not in (key, order, *arrays)]
    agg = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in scalars]
    out = df.groupBy(key).agg(*agg, F.min(order).alias(order), (F.count("*") - 1).alias("n_merged"))
    for a in arrays:
        if a in df.columns:
            items = df.select(key, order, F.posexplode(a).alias("i", "x")).groupBy(key, "x").agg(F.min(F.struct(order, "i")).alias("at"))
            got = items.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda v: v["x"]).alias(a))
            out = out.join(got, key, "left").withColumn(a, F.coalesce(a, F.array().cast(df.schema[a].dataType)))
    return out


def merge_log(df: DataFrame, key: str = "_entity_id", order: str = "pos", source: str = "registry_id") -> DataFrame:
    """entity_id, merged_from of every row after the first of its key."""
    first = df.groupBy(key).agg(F.min(order).alias("_first"))
    return df.join(first, key).filter(F.col(order) > F.col("_first")).select(F.col(key).alias("entity_id"), F.col(source).alias("merged_from"))


def identity_collisions(df: DataFrame, key: str = "_entity_id") -> DataFrame:
    """Keys of more than one entity_type."""
    return df.groupBy(key).agg(F.count_distinct("entity_type").alias("n_types")).filter("n_types > 1")


def category_collisions(df: DataFrame) -> DataFrame:
    """registry_id, first_category and category: an id that an earlier category (by ordinal) or the same one has with another label or URL. All of that category's records are rejected."""
    same = df.groupBy("registry_id").agg(F.count_distinct(F.struct("label_vi", "registry_url")).alias("n"), F.min(F.struct("ordinal", "registry_category")).alias("first")).filter("n > 1")
    return df.join(same, "registry_id").groupBy("registry_id", "registry_category", F.col("first.registry_category").alias("first_category")).agg(F.count("*").alias("rows"))


def map_canonical(entities: DataFrame, category_types: DataFrame, pages: DataFrame, exact: DataFrame) -> DataFrame:
    """Canonical records: type by category, page by title key, QID of the entity before the page's before the manifest's.

    entities: _entity_id, label_vi, registry_*, coverage_snapshot, retrieved_at, registry_fields, aliases_vi, coordinates, wikidata_id, relations;
    category_types: key, entity_type; pages: title, page_id, wikidata_id, source_url, abstract, coordinates, pos; exact: entity_id, wikidata_id, pos.
    Unknown categories and wrong ids fail.
    """
    page = pages.withColumn("_k", t.title_key(F.col("title"))).groupBy("_k").agg(F.max_by(F.struct("title", "page_id", "wikidata_id", "source_url", "abstract", "coordinates"), "pos").alias("page"))
    known = exact.groupBy("entity_id").agg(F.min_by("wikidata_id", "pos").alias("_exact")).withColumnRenamed("entity_id", "_entity_id")
    types = category_types.select(F.col("key").alias("registry_category"), "entity_type")
    e = entities.withColumn("_k", t.title_key(F.col("label_vi"))).join(types, "registry_category", "left").join(page, "_k", "left").join(known, "_entity_id", "left")
    has = F.col("page").isNotNull()
    q = F.coalesce(F.nullif("wikidata_id", F.lit("")), F.nullif("page.wikidata_id", F.lit("")), F.col("_exact"))
    text = F.col("registry_fields")["recognition_text"]
    entity_type = F.when(F.col("entity_type").isNotNull(), F.col("entity_type")).otherwise(F.raise_error(F.concat(F.lit("MAPPING_UNKNOWN_CATEGORY: "), F.coalesce("registry_category", F.lit("")))))
    ident = F.when(F.col("_entity_id").rlike("^[a-z0-9-]+$"), F.col("_entity_id")).otherwise(F.raise_error(F.concat(F.lit("MAPPING_INVALID_ENTITY_ID: "), F.coalesce("_entity_id", F.lit("")))))
    return e.select(
        ident.alias("entity_id"), entity_type.alias("entity_type"), "label_vi", "registry_id", "registry_category", "registry_url",
        F.when(has, "registry+wikipedia").otherwise("registry_only").alias("source_status"), "coverage_snapshot", F.col("page.page_id").alias("source_page_id"),
        F.coalesce("page.source_url", "registry_url").alias("source_url"), "retrieved_at",
        F.array_distinct(F.array_compact(F.concat(F.coalesce("aliases_vi", F.array().cast("array<string>")), F.array(F.col("page.title"))))).alias("aliases_vi"),
        F.col("page.abstract").alias("description_vi"), F.coalesce("page.coordinates", "coordinates").alias("coordinates"),
        F.when(q.isNotNull(), F.create_map(F.lit("wikidata"), q)).otherwise(F.create_map().cast("map<string,string>")).alias("external_ids"), "relations",
        F.array_compact(F.array(F.nullif(F.col("registry_fields")["type"], F.lit("")))).alias("site_types"), t.year(text).alias("recognition_year"),
        F.col("registry_fields")["location"].alias("address"), F.col("registry_fields")["location"].alias("location"),
        F.struct(F.col("registry_url").alias("source"), F.when(has, "registry-plus-mediawiki-enrichment").otherwise("registry").alias("method"), F.when(has, "CC BY-SA 4.0").otherwise("Official registry snapshot").alias("license")).alias("provenance"),
    )


def match_pages(labels: DataFrame, redirects: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(label with its page, labels without one): by title key, directly or by one redirect (from, to). Pages of one id and key count once, the first by pos."""
    page = pages.withColumn("_k", t.title_key(F.col("title"))).groupBy("page_id", "_k").agg(F.min_by("title", "pos").alias("title")).groupBy("_k").agg(F.min(F.struct("page_id", "title")).alias("page"))
    hop = redirects.select(t.title_key(F.col("from")).alias("_k"), t.title_key(F.col("to")).alias("_to")).groupBy("_k").agg(F.min("_to").alias("_to"))
    asked = labels.withColumn("_k", t.title_key(F.col("label_vi"))).join(hop, "_k", "left").withColumn("_k", F.coalesce("_to", "_k"))
    got = asked.join(page, "_k", "left")
    return got.filter("page is not null").select(*labels.columns, "page.*"), got.filter("page is null").select(*labels.columns, F.lit("ENRICHMENT_MISSING").alias("error_code"))


def unique_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, key: str) -> DataFrame:
    """left_id, right_id where a left row's key meets just one right id.

    Ids are one if the least is the greatest, which is told of each key before the join: a left row meets one row, however many share its key.
    """
    ends = right.groupBy(key).agg(F.min(right_id).alias("_least"), F.max(right_id).alias("_most"))
    met = left.join(ends, key).groupBy(left_id).agg(F.min("_least").alias(right_id), F.max("_most").alias("_most"))
    return met.filter(F.col(right_id) == F.col("_most")).drop("_most")


def type_compatible(found: Column, allowed: Column) -> Column:
    return F.arrays_overlap(F.transform(found, F.lower), allowed)


def coverage(categories: DataFrame, records: DataFrame, failures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a row for each category, one row of totals). categories: key, expected; records: registry_category; failures: registry_category, error_code. An empty source covers itself."""
    got = records.groupBy("registry_category").agg(F.count("*").alias("collected")).withColumnRenamed("registry_category", "key")
    bad = failures.groupBy("registry_category").agg(F.max("error_code").alias("error_code")).withColumnRenamed("registry_category", "key")
    per = categories.join(got, "key", "left").join(bad, "key", "left").select("key", "expected", F.coalesce("collected", F.lit(0)).cast("long").alias("collected"), "error_code")
    per = per.withColumn("percent", F.when((F.col("expected") == 0) | (F.col("error_code") == "REGISTRY_EMPTY_SOURCE"), 100.0).otherwise(F.round(100.0 * F.col("collected") / F.col("expected"), 2)))
    totals = per.agg(F.count("*").alias("categories"), F.sum("expected").alias("expected"), F.sum("collected").alias("collected"), F.count_if(F.col("error_code").isNotNull()).alias("failed"), F.every(F.col("percent") == 100.0).alias("complete"))
    return per, totals


def enrichment_counts(labels: DataFrame, pages: DataFrame, failures: DataFrame) -> DataFrame:
    """One row: matched pages, missing (failures), total labels asked for, and pages linked to Wikidata."""
    n = lambda df: df.agg(F.count("*").alias("n"))
    found = pages.agg(F.count("*").alias("matched"), F.count_if(F.coalesce(F.col("wikidata_id") != "", F.lit(False))).alias("wikidata_linked"))
    return found.join(n(failures).withColumnRenamed("n", "missing")).join(n(labels).withColumnRenamed("n", "total"))  # one row each


def latencies(df: DataFrame, name: str, value: str) -> DataFrame:
    """n, median, p95 (between neighbours as their distance tells), and p95_index: the value at place max(0, int(0.95 n) - 1) of the sorted ones; nulls are no values.

    Distinct values are counted first, then added up in bins of about 1 % of their size, of which there are 270,000 at most whatever the number of
    rows; only the bins that hold a place asked for are sorted. No task gets all values of a name.
    """
    v = F.col(value).cast("double")
    size = F.floor(F.log2(F.abs(v)) * 64).cast("long") + (1 << 17)  # above 0 for the least of doubles
    bin_of = F.when(F.isnan(v), (1 << 63) - 1).when(v == 0, 0).otherwise(size * F.signum(v).cast("long"))
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(name).alias("_name"), F.col(value).alias("_v"), bin_of.alias("_bin")).agg(F.count("*").alias("_c"))
    every = Window.partitionBy("_name")
    bins = counts.groupBy("_name", "_bin").agg(F.sum("_c").alias("_in")).withColumn("_start", F.sum("_in").over(every.orderBy("_bin")) - F.col("_in")).withColumn("n", F.sum("_in").over(every))
    at = {"median": (F.col("n") - 1) * 0.5, "p95": (F.col("n") - 1) * 0.95}
    places = {"p95_index": F.greatest(F.lit(0), F.floor(F.col("n") * 0.95) - 1)} | {f"_{k}_{side}": f(x) for k, x in at.items() for side, f in (("low", F.floor), ("high", F.ceil))}
    held = functools.reduce(Column.__or__, [(x >= F.col("_start")) & (x < F.col("_start") + F.col("_in")) for x in places.values()])
    few = bins.filter(held).select(F.col("_name").alias("_of"), F.col("_bin").alias("_at"), "_start", "n")
    near = counts.join(few, F.col("_name").eqNullSafe(F.col("_of")) & (F.col("_bin") == F.col("_at")))
    upto = F.col("_start") + F.sum("_c").over(Window.partitionBy("_name", "_bin").orderBy("_v"))
    here = near.withColumn("_upto", upto)
    found = here.groupBy("_name", "n").agg(*[F.max(F.when((x >= F.col("_upto") - F.col("_c")) & (x < F.col("_upto")), F.col("_v"))).alias(k) for k, x in places.items()])
    between = lambda k: F.when(F.col(f"_{k}_low") == F.col(f"_{k}_high"), F.col(f"_{k}_low").cast("double")).otherwise((F.ceil(at[k]) - at[k]) * F.col(f"_{k}_low") + (at[k] - F.floor(at[k])) * F.col(f"_{k}_high"))
    return found.select(F.col("_name").alias(name), "n", "p95_index", between("median").alias("median"), between("p95").alias("p95"))


def last_lookup(items: DataFrame, lookup: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """items with `found`: the lookup's last value of the key, or the key itself."""
    last = lookup.groupBy(key).agg(F.max_by(value, pos).alias("_v"))
    return items.join(last, key, "left").withColumn("found", F.coalesce("_v", key)).drop("_v")
