"""Every query of the library by name, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as t
from .operators import checks, closure, linking, lpg, rdf, records
from .operators.rdf import DCT, GEO, LABEL, ONT, OWL, PROV, RDFS, RES, SAME_AS, TYPE, XSD
from .plans import cypher, service, sparql
from .sources import readers, writers
from .testbed import QUADS_SQL, RAW_SQL, quads, raw_records, schema_quads, table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
PREFIXES = f"PREFIX o: <{ONT}> PREFIX r: <{RES}> PREFIX rdfs: <{RDFS}> PREFIX owl: <{OWL}> PREFIX dct: <{DCT}> PREFIX prov: <{PROV}> PREFIX geo: <{GEO}> PREFIX xsd: <{XSD}> "
#: White space of the texts, for SQL without Unicode classes.
WS = r"[\s\x0B\x1C-\x1F\x85\xA0]+"
COLLAPSED = f"trim(regexp_replace({{}}, '{WS}', ' ', 'g'))"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def graph_sql(body: str, more: str = "", recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{QUADS_SQL}{', ' + more if more else ''} {body}"


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# text functions, over whole texts


@query(f"select doc_id, md5({COLLAPSED.format('text')}) as h from documents")
def norm_whitespace(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(t.collapsed(F.col("text"))).alias("h"))


@query("select doc_id, md5(translate(replace(text, ',', '–'), '‒–—', '---')) as h from documents")
def norm_dash(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(t.plain_dashes(F.replace("text", F.lit(","), F.lit("–")))).alias("h"))


@query(f"select doc_id, md5(nfc_normalize({COLLAPSED.format('text')})) as h from documents")
def norm_display_label(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(t.display_label(F.col("text"))).alias("h"))


@query(f"select doc_id, md5(replace(lower(nfc_normalize(translate({COLLAPSED.format('text')}, '‒–—', '---'))), 'ß', 'ss')) as h from documents")
def norm_identity_key(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(t.identity_key(F.col("text"))).alias("h"))


@query(f"select doc_id, md5(trim(regexp_replace(replace(lower(nfc_normalize(text)), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}\\s\\x0B]', '', 'g'))) as h from documents")
def norm_link_key(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(t.link_key(F.col("text"))).alias("h"))


@query("select c_custkey, trim(regexp_replace('  CATEGORY:  ' || c_mktsegment, '^\\s*category:\\s*', '', 'i')) as cat from customer")
def norm_category(spark, d):
    return table(spark, d, "customer").select("c_custkey", t.category(F.concat(F.lit("  CATEGORY:  "), "c_mktsegment")).alias("cat"))


@query("select page_id, string_split(url || '#a#b', '#')[1] as url from pages")
def norm_fragment(spark, d):
    return table(spark, d, "pages").select("page_id", t.without_fragment(F.concat("url", F.lit("#a#b"))).alias("url"))


_YEAR = "nullif(regexp_extract({}, '(?:^|[^0-9])([0-9]{{4}})(?:[^0-9]|$)', 1), '')::int"


@query("with x as (select o_orderkey, 'QD ' || o_orderkey || ' nam ' || year(o_orderdate) || '.' as s from orders) select o_orderkey, " + _YEAR.format("s") + " as year from x")
def norm_year(spark, d):
    s = F.concat(F.lit("QD "), F.col("o_orderkey").cast("string"), F.lit(" nam "), F.year("o_orderdate").cast("string"), F.lit("."))
    return table(spark, d, "orders").select("o_orderkey", t.year(s).alias("year"))


@query("select o_orderkey, year(o_orderdate)::int as start_year, case when o_orderstatus <> 'F' then year(o_orderdate)::int + 5 end as end_year from orders")
def norm_year_range(spark, d):
    y = F.year("o_orderdate")
    s = F.when(F.col("o_orderstatus") != "F", F.concat(y.cast("string"), F.lit("–"), (y + 5).cast("string"))).otherwise(y.cast("string"))
    r = t.year_range(s)
    return table(spark, d, "orders").select("o_orderkey", r["start"].alias("start_year"), r["end"].alias("end_year"))


@query("select o_orderkey, case o_orderstatus when 'F' then year(o_orderdate)::int when 'O' then 1000 + o_orderkey::int % 1000 end as year from orders")
def norm_first_year(spark, d):
    """A number where there is one, else the first year of a text, else null."""
    number = F.when(F.col("o_orderstatus") == "F", F.year("o_orderdate").cast("string"))
    text = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("khoảng "), (1000 + F.col("o_orderkey") % 1000).cast("string"), F.lit(", 2001"))).otherwise("không rõ")
    return table(spark, d, "orders").select("o_orderkey", t.first_year(number, text).alias("year"))


@query("select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso, strftime(ts, '%Y%m%dT%H%M%SZ') as snapshot from events")
def norm_timestamps(spark, d):
    return table(spark, d, "events").select("event_id", t.iso_time(F.col("ts")).alias("iso"), t.snapshot_id(F.col("ts")).alias("snapshot"))


@query("select c_custkey, lower(c_mktsegment) || ' & ä <' || c_custkey || '>' as key from customer")
def norm_markup_key(spark, d):
    s = F.concat(F.lit('<b class="x">'), "c_mktsegment", F.lit("</b>\n &amp; <i>&Auml;</i>  &lt;"), F.col("c_custkey").cast("string"), F.lit("&#62;"))
    return table(spark, d, "customer").select("c_custkey", t.markup_key(s).alias("key"))


@query("select o_orderkey, lower(trim(case o_orderstatus when 'F' then ' N/A ' when 'O' then 'Chưa rõ' else o_orderpriority end)) in ('', 'n/a', '?', 'chưa rõ', 'chua ro') as unknown from orders")
def norm_unknown(spark, d):
    s = F.when(F.col("o_orderstatus") == "F", " N/A ").when(F.col("o_orderstatus") == "O", "Chưa rõ").otherwise(F.col("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", t.is_unknown(s).alias("unknown"))


# hundredths as whole numbers first: both sides round a double's hundredth alike
_COORD = "select c_custkey, (round(c_acctbal * 100)::bigint % 18100) / 100.0 as lat, (round(c_acctbal * 100)::bigint % 36100) / 100.0 as lon from customer"


@query(f"with x as ({_COORD}) select c_custkey, case when ok then lat::double end as lat, case when ok then lon::double end as lon, case when not ok then 'INVALID_COORDINATE' end as warning from (select *, lat between -90 and 90 and lon between -180 and 180 as ok from x)")
def norm_coordinate(spark, d):
    dec = lambda n: F.format_string("%.2f", (F.round(F.col("c_acctbal") * 100).cast("long") % n) / F.lit(100.0))
    c = t.coordinate(t.latitude(dec(18100)), t.longitude(F.replace(dec(36100), F.lit("."), F.lit(","))))
    return table(spark, d, "customer").select("c_custkey", c["lat"].alias("lat"), c["lon"].alias("lon"), c["warning"].alias("warning"))


_QIDS = "case c_mktsegment when 'BUILDING' then ' q' || c_custkey || ' ' when 'MACHINERY' then 'Q-1' when 'HOUSEHOLD' then '?' else 'Q' || c_custkey end"


@query(f"with x as (select c_custkey, {_QIDS} as q from customer) select c_custkey, case when regexp_matches(upper(trim(q)), '^Q\\s*[0-9]+$') then upper(trim(q)) end as qid, case when q <> '?' and not regexp_matches(upper(trim(q)), '^Q\\s*[0-9]+$') then 'INVALID_QID' end as warning from x")
def norm_qid(spark, d):
    k = F.col("c_custkey").cast("string")
    seg = F.col("c_mktsegment")
    q = t.qid(F.when(seg == "BUILDING", F.concat(F.lit(" q"), k, F.lit(" "))).when(seg == "MACHINERY", "Q-1").when(seg == "HOUSEHOLD", "?").otherwise(F.concat(F.lit("Q"), k)))
    return table(spark, d, "customer").select("c_custkey", q["qid"].alias("qid"), q["warning"].alias("warning"))


@query("""with x as (select p_partkey, lower(p_name) as k0, unnest([p_name, upper(p_name), p_brand, p_type, lower(p_brand)]) as a, unnest(range(5)) as pos from part),
y as (select p_partkey, k0, a, lower(a) as k, min(pos) as pos from x group by all)
select p_partkey, coalesce(string_agg(a, '|' order by pos), '') as aliases from (select p.p_partkey, f.a, f.pos from part p left join (select p_partkey, arg_min(a, pos) as a, min(pos) as pos from x where lower(a) <> k0 group by p_partkey, lower(a)) f using (p_partkey)) group by p_partkey""")
def norm_alias_dedupe(spark, d):
    a = F.array("p_name", F.upper("p_name"), "p_brand", "p_type", F.lower("p_brand"))
    rows = table(spark, d, "part").withColumn("aliases", a).withColumn("keys", F.transform("aliases", F.lower))
    return rows.select("p_partkey", F.array_join(t.distinct_aliases(F.lower("p_name"), F.col("aliases"), F.col("keys")), "|").alias("aliases"))


@query("select s_suppkey, 2 * 6371.0088 * asin(sqrt(least(1.0, power(sin(radians(b - a) / 2), 2) + cos(radians(a)) * cos(radians(b)) * power(sin(radians(y - x) / 2), 2)))) as km from (select s_suppkey, s_nationkey * 1.0::double as a, s_nationkey * 2.0::double as b, s_nationkey * 3.0::double as x, s_nationkey * 5.0::double as y from supplier)")
def haversine_km(spark, d):
    n = F.col("s_nationkey").cast("double")
    return table(spark, d, "supplier").select("s_suppkey", F.round(t.haversine_km(n, n * 3, n * 2, n * 5), 6).alias("km"))


_SQL["haversine_km"] = _SQL["haversine_km"].replace("select s_suppkey, 2 *", "select s_suppkey, round(2 *", 1).replace(" as km from", ", 6) as km from", 1)


@query("select p_partkey, case when p_size <= 10 then ltrim(regexp_replace(regexp_replace(p_retailprice::decimal(12, 4)::varchar, '(\\.[0-9]*?)0+$', '\\1'), '\\.$', ''), '+') else p_name end as v from part")
def parity_value(spark, d):
    x = F.when(F.col("p_size") <= 10, F.col("p_retailprice").cast("decimal(12,4)").cast("string")).otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", t.parity_value(x, rdf.BASE).alias("v"))


# records


@query(f"with {RAW_SQL} select registry_id, 'RAW_MISSING_CORE' as error, 'label_vi' as missing from raw where label_vi is null or label_vi = ''")
def split_skipped(spark, d):
    _, bad = records.split_required(raw_records(spark, d))
    return bad.select("registry_id", "error", F.array_join("missing_fields", ",").alias("missing"))


@query(f"with {RAW_SQL} select registry_id, nfc_normalize({COLLAPSED.format('label_vi')}) as label_vi from raw where label_vi <> ''")
def normalized_records(spark, d):
    ok, _ = records.normalized(raw_records(spark, d))
    return ok.select("registry_id", "label_vi")


@query(f"with {RAW_SQL} select doc_id, 'registry-' || sha256(registry_url || '|' || registry_category || '|' || concat_ws('|', lower(trim(label_vi)), nullif(lower(trim(lang)), '')))[1:12] as id, 'registry-' || sha256(registry_url || registry_category || coalesce(label_vi, ''))[1:12] as fallback from raw")
def id_registry(spark, d):
    r = raw_records(spark, d)
    ident = t.identity_parts(F.col("label_vi"), F.col("lang"))
    return r.select("doc_id", t.registry_id(F.lit(None).cast("string"), F.col("registry_url"), F.col("registry_category"), ident).alias("id"), t.fallback_id(F.col("registry_url"), F.col("registry_category"), F.coalesce("label_vi", F.lit(""))).alias("fallback"))


_TYPED = ["HistoricalPerson", "AdministrativeArea", "HistoricalEvent", "HistoricalPeriod", "HeritageComplex", "Organization", "ArchitecturalStyle", "Artisan"]


@query("""with x as (select c_custkey, lower(c_name) as n, case when c_acctbal > 0 then 'q' || c_custkey end as q,
  case c_mktsegment when 'BUILDING' then 'HistoricalPerson' when 'AUTOMOBILE' then 'HistoricalEvent' when 'MACHINERY' then 'HistoricalPeriod' when 'HOUSEHOLD' then 'HeritageComplex' else 'Artisan' end as k from customer)
select c_custkey, case k when 'HistoricalPerson' then coalesce('person-wikidata-' || q, 'person-name-' || sha256(n)[1:12]) when 'HistoricalEvent' then 'event-' || sha256(n || '1900')[1:12]
  when 'HistoricalPeriod' then 'period-' || sha256(n || '1900' || '1950')[1:12] when 'HeritageComplex' then 'complex-' || sha256(n)[1:12] else coalesce('derived-wikidata-' || q, 'derived-' || sha256(k || n)[1:12]) end as id from x""")
def id_typed(spark, d):
    seg = F.col("c_mktsegment")
    kind = F.when(seg == "BUILDING", "HistoricalPerson").when(seg == "AUTOMOBILE", "HistoricalEvent").when(seg == "MACHINERY", "HistoricalPeriod").when(seg == "HOUSEHOLD", "HeritageComplex").otherwise("Artisan")
    rows = table(spark, d, "customer").select(
        "c_custkey", F.lit(None).cast("string").alias("registry_id"), kind.alias("entity_type"), F.when(F.col("c_acctbal") > 0, F.concat(F.lit("Q"), F.col("c_custkey").cast("string"))).alias("wikidata_id"), F.lit(None).cast("bigint").alias("page_id"),
        F.lit(1900).alias("start_year"), F.lit(1950).alias("end_year"), F.lower("c_name").alias("_identity_key"), F.col("c_name").alias("label_vi"),
    )
    return rows.select("c_custkey", records.entity_id().alias("id"))


def _merge_input(spark, d):
    """Documents keyed by their first line: copies meet."""
    doc = table(spark, d, "documents")
    return doc.select(t.sha12(F.element_at(F.split("text", "\n"), 1)).alias("_entity_id"), F.col("doc_id").alias("pos"), _d("doc_id").alias("registry_id"), F.when(F.col("n_chars") > 1000, F.col("lang")).alias("entity_type"), F.array("source", "lang").alias("categories"), F.when(F.col("n_chars") > 2000, F.col("n_chars")).alias("size"))


def _d(c):
    return F.concat(F.lit("doc-"), F.col(c).cast("string"))


_MERGE = "x as (select sha256(string_split(text, chr(10))[1])[1:12] as id, doc_id as pos, 'doc-' || doc_id as rid, case when n_chars > 1000 then lang end as ty, [source, lang] as cats, case when n_chars > 2000 then n_chars end as size from documents)"


@query(f"""with {_MERGE}, c as (select id, string_agg(cat, ',' order by p, i) as cats from (select id, cat, min(p) as p, arg_min(i, p) as i from (select id, unnest(cats) as cat, pos as p, unnest([1, 2]) as i from x) group by id, cat) group by id)
select id, min(pos) as pos, arg_min(rid, pos) as rid, arg_min(ty, pos) filter (ty is not null) as ty, arg_min(size, pos) filter (size is not null) as size, (count(*) - 1)::bigint as n_merged, any_value(c.cats) as cats from x join c using (id) group by id""")
def merge_duplicates(spark, d):
    out = records.merge_duplicates(_merge_input(spark, d), arrays=("categories",))
    return out.select(F.col("_entity_id").alias("id"), "pos", F.col("registry_id").alias("rid"), F.col("entity_type").alias("ty"), "size", "n_merged", F.array_join("categories", ",").alias("cats"))


@query(f"with {_MERGE} select id as entity_id, rid as merged_from from x qualify pos > min(pos) over (partition by id)")
def merge_log(spark, d):
    return records.merge_log(_merge_input(spark, d))


@query(f"with {_MERGE} select id, count(distinct ty) as n_types from x group by id having count(distinct ty) > 1")
def identity_collision(spark, d):
    return records.identity_collisions(_merge_input(spark, d)).withColumnRenamed("_entity_id", "id")


@query("with x as (select sha256(string_split(text, chr(10))[1])[1:12] as registry_id, source as cat, string_split(text, chr(10))[1] as l, 'u/' || lang || '/' || n_chars as u, try_cast(replace(source, 'src', '') as int) as o from documents), s as (select registry_id, arg_min(cat, o) as first_category from x group by 1 having count(distinct l || u) > 1) select registry_id, cat as registry_category, first_category, count(*) as rows from x join s using (registry_id) group by all")
def category_collision(spark, d):
    label = F.element_at(F.split("text", "\n"), 1)
    rows = table(spark, d, "documents").select(t.sha12(label).alias("registry_id"), F.col("source").alias("registry_category"), label.alias("label_vi"), F.concat(F.lit("u/"), "lang", F.lit("/"), F.col("n_chars").cast("string")).alias("registry_url"), F.replace("source", F.lit("src"), F.lit("")).cast("int").alias("ordinal"))
    return records.category_collisions(rows)


def _canonical(spark, d):
    raw = raw_records(spark, d).filter("label_vi <> ''")
    entities = raw.select(
        records.registry_entity_id(F.col("registry_id")).alias("_entity_id"), "label_vi", "registry_id", "registry_category", "registry_url", "coverage_snapshot", "retrieved_at",
        F.create_map(F.lit("recognition_text"), F.concat(F.lit("QD nam "), (1900 + F.col("n_chars") % 100).cast("string")), F.lit("location"), F.col("lang"), F.lit("type"), F.lit("Di tích lịch sử")).alias("registry_fields"),
        F.array("lang").alias("aliases_vi"), F.lit(None).cast("struct<lat:double,lon:double>").alias("coordinates"), F.when(F.col("n_chars") > 3000, F.concat(F.lit("Q"), F.col("doc_id").cast("string"))).alias("wikidata_id"),
        F.create_map(F.lit("located_in"), F.array(F.concat(F.lit("area-"), "lang"))).alias("relations"),
    )
    types = table(spark, d, "documents").select(F.col("source").alias("key")).distinct().withColumn("entity_type", F.lit("HeritageSite"))
    bench = table(spark, d, "benchmark")
    pages = bench.select(F.element_at(F.split("text", "\n"), 1).alias("title"), F.col("item_id").alias("page_id"), F.lit(None).cast("string").alias("wikidata_id"), F.concat(F.lit("https://wiki.example.org/"), F.col("item_id").cast("string")).alias("source_url"), F.col("text").alias("abstract"), F.lit(None).cast("struct<lat:double,lon:double>").alias("coordinates"), F.col("item_id").alias("pos"))
    labels = table(spark, d, "labels")
    exact = labels.filter("quality = 1").select(F.concat(F.lit("registry-doc-"), F.col("doc_id").cast("string")).alias("entity_id"), F.concat(F.lit("Q9"), F.col("doc_id").cast("string")).alias("wikidata_id"), F.col("doc_id").alias("pos"))
    return records.map_canonical(entities, types, pages, exact)


_CANON = RAW_SQL + """, canon as (
  select 'registry-' || registry_id as entity_id, label_vi, registry_category, registry_url, lang, 1900 + n_chars % 100 as year, registry_id,
    coalesce(case when n_chars > 3000 then 'Q' || raw.doc_id end, case when l.quality = 1 then 'Q9' || raw.doc_id end) as qid, b.item_id, b.title, b.text as descr
  from raw left join labels l on l.doc_id = raw.doc_id
  left join (select item_id, string_split(text, chr(10))[1] as title, text from benchmark) b on lower(trim(regexp_replace(b.title, '\\s+', ' ', 'g'))) = lower(trim(regexp_replace(label_vi, '\\s+', ' ', 'g')))
  where label_vi <> '')"""


@query(f"with {_CANON} select entity_id, 'HeritageSite' as entity_type, case when item_id is null then 'registry_only' else 'registry+wikipedia' end as source_status, qid, year::int as recognition_year, case when item_id is null then registry_url else 'https://wiki.example.org/' || item_id end as source_url, lang as address from canon")
def map_canonical(spark, d):
    c = _canonical(spark, d)
    return c.select("entity_id", "entity_type", "source_status", F.col("external_ids")["wikidata"].alias("qid"), "recognition_year", "source_url", "address")


@query("select l_orderkey, l_linenumber, coalesce(o.o_orderpriority, 'none') as found from lineitem left join (select o_orderkey, arg_max(o_orderpriority, o_orderdate) as o_orderpriority from orders group by 1) o on o.o_orderkey = l_orderkey")
def last_wins_lookup(spark, d):
    o = readers.last_wins(table(spark, d, "orders"), "o_orderkey", "o_orderpriority", ["o_orderdate"])
    return table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("l_orderkey", "l_linenumber", F.coalesce("o_orderpriority", F.lit("none")).alias("found"))


@query("select o_custkey, arg_min(o_orderpriority, {'a': o_orderdate, 'b': o_orderkey}) as o_orderpriority from orders group by 1")
def first_wins_lookup(spark, d):
    return readers.first_wins(table(spark, d, "orders"), "o_custkey", "o_orderpriority", ["o_orderdate", "o_orderkey"])


def _enrich(spark, d):
    """Parts' types as labels; pages are the types of the smallest parts, every other name leads there by a redirect from its capitals."""
    part = table(spark, d, "part")
    pages = part.filter("p_size <= 2").select(F.col("p_type").alias("title"), F.col("p_partkey").alias("page_id"), F.col("p_partkey").alias("pos"))
    redirects = pages.select(F.concat(F.lit("see "), "title").alias("from"), F.col("title").alias("to"))
    labels = part.select("p_partkey", F.when(F.col("p_size") > 25, F.concat(F.lit("SEE  "), "p_type")).otherwise(F.col("p_type")).alias("label_vi"))
    return records.match_pages(labels, redirects, pages)


_PAGES = "pg as (select lower(p_type) as k, min(p_partkey) as page_id from part where p_size <= 2 group by 1)"


@query(f"with {_PAGES} select p_partkey, page_id from part join pg on lower(p_type) = k")
def enrich_match(spark, d):
    return _enrich(spark, d)[0].select("p_partkey", "page_id")


@query(f"with {_PAGES} select p_partkey, 'ENRICHMENT_MISSING' as error_code from part where lower(p_type) not in (select k from pg)")
def enrich_failures(spark, d):
    return _enrich(spark, d)[1].select("p_partkey", "error_code")


@query("select c_custkey, any_value(s_suppkey) as s_suppkey from customer join supplier on c_nationkey = s_nationkey and round(c_acctbal / 1000) = round(s_acctbal / 1000) group by 1 having count(distinct s_suppkey) = 1")
def unique_exact_match(spark, d):
    key = lambda p: F.concat_ws("|", F.col(f"{p}_nationkey").cast("string"), F.round(F.col(f"{p}_acctbal") / 1000).cast("int").cast("string")).alias("k")
    return records.unique_match(table(spark, d, "customer").select("c_custkey", key("c")), table(spark, d, "supplier").select("s_suppkey", key("s")), "c_custkey", "s_suppkey", "k")


@query("select key, expected, collected, case when expected = 0 then 100.0 else round(100.0 * collected / expected, 2) end as percent from (select source as key, count(*) as expected, count(*) filter (lang <> 'es') as collected from documents group by 1)")
def coverage_report(spark, d):
    doc = table(spark, d, "documents")
    cats = doc.groupBy(F.col("source").alias("key")).agg(F.count("*").alias("expected"))
    got = doc.filter("lang <> 'es'").select(F.col("source").alias("registry_category"))
    per, _ = records.coverage(cats, got, spark.createDataFrame([], "registry_category string, error_code string"))
    return per.select("key", "expected", "collected", "percent")


@query("select event_type, count(value) as n, quantile_cont(value, 0.5) as median, quantile_cont(value, 0.95) as p95, list_sort(list(value))[greatest(0, floor(count(value) * 0.95)::int - 1) + 1] as p95_index from events where value is not null group by 1")
def percentile_latency(spark, d):
    out = records.latencies(table(spark, d, "events"), "event_type", "value")
    return out.select("event_type", "n", "median", "p95", "p95_index")


@query("select doc_id, source, n_chars from documents where lang <> 'en' union all select doc_id, source || '*', n_chars + 1 from documents where lang = 'en'")
def upsert_manifest(spark, d):
    doc = table(spark, d, "documents").select("doc_id", "source", "n_chars", "lang")
    new = doc.filter("lang = 'en'").select("doc_id", F.concat("source", F.lit("*")).alias("source"), F.col("n_chars") + 1)
    return writers.upsert(doc.select("doc_id", "source", "n_chars"), new.withColumnRenamed("(n_chars + 1)", "n_chars"), "doc_id")


@query("select s_suppkey, floor((row_number() over (order by s_suppkey) - 1) / 50)::bigint as batch from supplier")
def batch_numbers(spark, d):
    return readers.batches(table(spark, d, "supplier").select("s_suppkey"), "s_suppkey").select("s_suppkey", "batch")


@query("select s_suppkey, coalesce(n.k::varchar, s_suppkey::varchar) as found from supplier left join (select n_nationkey as s_suppkey, max(n_regionkey) as k from nation group by 1) n using (s_suppkey)")
def label_or_id_lookup(spark, d):
    lookup = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("k"), F.col("n_regionkey").cast("string").alias("v"), F.col("n_regionkey").alias("pos"))
    return records.last_lookup(table(spark, d, "supplier").select("s_suppkey", F.col("s_suppkey").cast("string").alias("k")), lookup, "k", "v", "pos").select("s_suppkey", "found")


# sources


@query(r"""with x as (select page_id, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)) as href from pages) select page_id, count(*) as n, md5(string_agg(href, '|' order by href)) as h from x group by 1""")
def html_links(spark, d):
    got = readers.links(table(spark, d, "pages"), "page_id", "html")
    return got.groupBy("page_id").agg(F.count("*").alias("n"), F.md5(F.array_join(F.sort_array(F.collect_list("href")), "|")).alias("h"))


_ROW = "<table><thead><tr><th>TT</th><th>X</th></tr></thead><tbody><tr><td>Số TT</td><td>Tên di tích</td></tr><tr><td>1</td><td><a href='/s/{k}'>Site&nbsp; <b>{k}</b></a></td><td></td><td>City</td></tr><tr><td></td><td> </td></tr><tr><td colspan=4>Tổng số: 1</td></tr></tbody></table>"


@query("select s_suppkey, 'Site ' || s_suppkey as label_vi, 'https://registry.example.org/s/' || s_suppkey as registry_url, 'registry-' || sha256('https://registry.example.org/s/' || s_suppkey || '|sites|site ' || s_suppkey || '|1|city')[1:12] as registry_id from supplier")
def html_rows(spark, d):
    a, _, rest = _ROW.partition("{k}")
    b, _, c = rest.partition("{k}")
    k = F.col("s_suppkey").cast("string")
    pages = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit(a), k, F.lit(b), k, F.lit(c)).alias("html"))
    rows = readers.table_rows(pages, "html", ["^Tổng số"])
    out = readers.row_records(rows, {"ordinal": 0, "label_vi": 1, "location": 3}, "https://registry.example.org/list/", "sites", "https://registry.example.org/list/", "s", "t")
    return out.select(F.substring_index("registry_url", "/", -1).cast("bigint").alias("s_suppkey"), "label_vi", "registry_url", "registry_id")


@query("select event_id as page_id, 'T ' || user_id as title, 'Q' || event_id as wikidata_id, value as lat, event_type as name, 'https://w.example.org/T_' || user_id as source_url, 2 as n_categories from events")
def wiki_pages(spark, d):
    e = table(spark, d, "events").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id")  # a few MB of events are very many pages
    page = F.struct(
        F.col("event_id").alias("pageid"), F.concat(F.lit("T "), F.col("user_id").cast("string")).alias("title"), F.struct(F.concat(F.lit("Q"), F.col("event_id").cast("string")).alias("wikibase_item")).alias("pageprops"),
        F.array(F.struct(F.col("value").alias("lat"), F.col("value").alias("lon"))).alias("coordinates"), F.array(F.struct(F.lit("Category:A").alias("title")), F.struct(F.lit("B").alias("title"))).alias("categories"),
        F.array(F.struct(F.col("event_id").alias("revid"), F.struct(F.struct(F.concat(F.lit("x {{cite|a=b}} {{Infobox site\n| Full name = "), "event_type", F.lit("\n| x = 1}} y")).alias("content")).alias("main")).alias("slots"))).alias("revisions"),
    )
    body = F.to_json(F.struct(F.struct(F.array(page).alias("pages")).alias("query")))
    out = readers.wiki_pages(e.select(body.alias("j")), "j", "t", "https://w.example.org/")
    return out.select("page_id", "title", "wikidata_id", F.col("coordinates.lat").alias("lat"), F.col("infobox")["full_name"].alias("name"), "source_url", F.size("categories").alias("n_categories"))


# quads


@query(graph_sql("select g, count(*) as n from quads group by 1"))
def triple_counts(spark, d):
    return rdf.triple_counts(quads(spark, d))


@query(graph_sql("select p, count(*) as n, count(distinct s) as subjects from triples group by 1"))
def union_default_graph(spark, d):
    return rdf.union_graph(quads(spark, d)).groupBy("p").agg(F.count("*").alias("n"), F.count_distinct("s").alias("subjects"))


@query(graph_sql("select s, o, g from quads where p = '" + SAME_AS + "'"))
def named_graph_scan(spark, d):
    return sparql.run(PREFIXES + "SELECT ?s ?o ?g WHERE { GRAPH ?g { ?s owl:sameAs ?o } }", quads(spark, d))


def _rdf_sql(cond: str) -> str:
    r = f"'{RES}' || entity_id"
    parts = [
        (r, TYPE, f"'{ONT}HeritageSite'", "iri", "", ""), (r, TYPE, f"'{ONT}HistoricalSite'", "iri", "", ""), (r, LABEL, "label_vi", "literal", "vi", ""),
        (r, RDFS + "comment", "descr", "literal", "vi", ""), (r, DCT + "description", "descr", "literal", "vi", ""), (r, "http://www.w3.org/2004/02/skos/core#altLabel", "case when lang <> label_vi then lang end", "literal", "vi", ""),
        (r, "http://www.w3.org/2004/02/skos/core#altLabel", "case when title <> label_vi then title end", "literal", "vi", ""),
        (r, ONT + "recognitionYear", "year", "literal", "", XSD + "gYear"), (r, ONT + "address", "lang", "literal", "", ""), (r, ONT + "sourcePageId", "nullif(item_id, 0)", "literal", "", XSD + "integer"),
        (r, DCT + "subject", f"'{RES}category/' || registry_category", "iri", "", ""), (f"'{RES}category/' || registry_category", TYPE, "'http://www.w3.org/2004/02/skos/core#Concept'", "iri", "", ""), (f"'{RES}category/' || registry_category", "http://www.w3.org/2004/02/skos/core#prefLabel", "registry_category", "literal", "en", ""),
        (r, ONT + "locatedIn", f"'{RES}area-' || lang", "iri", "", ""), (r, DCT + "license", "case when item_id is null then 'Official registry snapshot' else 'CC BY-SA 4.0' end", "literal", "", ""), (r, SAME_AS, "'https://www.wikidata.org/entity/' || qid", "iri", "", ""),
    ]
    for p in (DCT + "source", PROV + "wasDerivedFrom"):
        parts += [(r, p, "registry_url", "iri", "", ""), (r, p, "'https://wiki.example.org/' || item_id", "iri", "", "")]
    rows = " union ".join(f"select {s} as s, '{p}' as p, ({o})::varchar as o, '{k}' as o_kind, '{lang}' as o_lang, '{dt}' as o_dt from canon where ({o}) is not null" for s, p, o, k, lang, dt in parts)
    return f"with {_CANON}, made as ({rows}) select s, p, md5(o) as o, o_kind, o_lang, o_dt from made where {cond}"


def _rdf(spark, d, condition):
    return rdf.record_quads(_canonical(spark, d)).filter(condition).select("s", "p", F.md5("o").alias("o"), "o_kind", "o_lang", "o_dt")


@query(_rdf_sql(f"p = '{TYPE}'"))
def rdf_types(spark, d):
    return _rdf(spark, d, F.col("p") == TYPE)


@query(_rdf_sql("o_kind = 'literal'"))
def rdf_literals(spark, d):
    return _rdf(spark, d, F.col("o_kind") == "literal")


@query(_rdf_sql(f"p = '{ONT}locatedIn'"))
def rdf_relations(spark, d):
    return _rdf(spark, d, F.col("p") == ONT + "locatedIn")


@query(_rdf_sql(f"p in ('{DCT}source', '{PROV}wasDerivedFrom', '{DCT}license', '{SAME_AS}')"))
def rdf_provenance(spark, d):
    return _rdf(spark, d, F.col("p").isin(DCT + "source", PROV + "wasDerivedFrom", DCT + "license", SAME_AS))


@query(_rdf_sql("true"))
def rdf_graph(spark, d):
    return _rdf(spark, d, F.lit(True))


def _dataset(spark, d):
    doc = table(spark, d, "documents").select(F.lit("20240101T000000Z").alias("coverage_snapshot"), F.concat(F.lit("2024-01-"), F.lpad(((F.col("doc_id") % 28) + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z")).alias("retrieved_at"), F.concat(F.lit("https://registry.example.org/"), "source").alias("registry_url"), F.when(F.col("lang") == "en", F.lit("https://wiki.example.org/en")).alias("source_url"))
    pages = table(spark, d, "benchmark").select(F.concat(F.lit("https://wiki.example.org/"), F.col("item_id").cast("string")).alias("url"), F.when(F.col("item_id") % 2 == 0, F.sha2("text", 256)).alias("checksum"))
    made = rdf.dataset_metadata(doc, quads(spark, d), [("A dataset", "en"), ("Bộ dữ liệu", "vi")], ("Ảnh chụp", "vi"), "https://creativecommons.org/licenses/by-sa/4.0/", "https://data.example.org/store", pages, 5)
    return doc, made


_SET, _SNAP = f"'{RES}dataset/main'", "20240101T000000Z"
_DATASET_ROWS = [
    (_SET, TYPE, f"'{rdf.DCAT}Dataset'", "", ""), (_SET, DCT + "title", "'A dataset'", "en", ""), (_SET, DCT + "title", "'Bộ dữ liệu'", "vi", ""), (_SET, DCT + "description", "'Ảnh chụp'", "vi", ""), (_SET, DCT + "identifier", f"'{_SNAP}'", "", ""), (_SET, DCT + "license", "'https://creativecommons.org/licenses/by-sa/4.0/'", "", ""),
    (_SET, DCT + "issued", f"'{_SNAP}'", "", XSD + "string"), (_SET, DCT + "modified", "(select max(seen) from rec)", "", XSD + "dateTime"), (_SET, PROV + "wasGeneratedBy", f"'{RES}activity/{_SNAP}'", "", ""), (_SET, PROV + "wasDerivedFrom", f"'{RES}manifest/{_SNAP}'", "", ""),
    (f"'{RES}activity/{_SNAP}'", TYPE, f"'{PROV}Activity'", "", ""), (f"'{RES}activity/{_SNAP}'", DCT + "identifier", f"'{_SNAP}'", "", ""), (f"'{RES}activity/{_SNAP}'", PROV + "startedAtTime", "(select min(seen) from rec)", "", XSD + "dateTime"), (f"'{RES}activity/{_SNAP}'", PROV + "endedAtTime", "(select max(seen) from rec)", "", XSD + "dateTime"),
    (f"'{RES}manifest/{_SNAP}'", TYPE, f"'{PROV}Entity'", "", ""), (f"'{RES}manifest/{_SNAP}'", DCT + "identifier", f"'{_SNAP}'", "", ""),
    *[x for n, g in (("ontology", "ontology"), ("asserted", "data"), ("external-links", "external-links"), ("inferred", "inferred"), ("metadata", "metadata")) for part in [f"'{RES}dataset/main/distribution/{n}'"] for x in (
        (_SET, rdf.DCAT + "distribution", part, "", ""), (part, TYPE, f"'{rdf.DCAT}Distribution'", "", ""), (part, rdf.DCAT + "mediaType", "'text/turtle'", "", ""), (part, DCT + "identifier", f"'{rdf.BASE}graph/{g}'", "", ""), (part, rdf.DCAT + "accessURL", f"'https://data.example.org/store?graph={rdf.BASE}graph/{g}'", "", ""))],
]
_EXTENTS = "select 'registry_records=' || (select count(*) from documents) as o union all select 'canonical_records=' || (select count(*) from documents) union all select 'asserted_triples=' || (select count(*) from quads where g = 'data') union all select 'inferred_closure_triples=' || (select count(*) from quads where g = 'inferred') union all select 'verified_external_links=' || (select count(*) from quads where g = 'external-links')"
_REC = "rec as (select '2024-01-' || lpad((doc_id % 28 + 1)::varchar, 2, '0') || 'T00:00:00Z' as seen, source, lang from documents)"


@query(graph_sql(
    " union all ".join(f"select {s} as s, '{p}' as p, {o} as o, '{lang}' as o_lang, '{dt}' as o_dt" for s, p, o, lang, dt in _DATASET_ROWS)
    + f" union all select {_SET}, '{DCT}source', u, '', '' from (select distinct 'https://registry.example.org/' || source as u from documents union select 'https://wiki.example.org/en' from documents where lang = 'en' union select 'https://wiki.example.org/' || item_id from benchmark)"
    + f" union all select '{RES}manifest/{_SNAP}', '{DCT}description', 'https://wiki.example.org/' || item_id || ' sha256=' || sha256(text), '', '' from benchmark where item_id % 2 = 0"
    + f" union all select {_SET}, '{DCT}extent', o, '', '' from ({_EXTENTS} union all select 'inferred_delta_triples=5')", _REC))
def dataset_metadata(spark, d):
    return _dataset(spark, d)[1].select("s", "p", "o", "o_lang", "o_dt")


@query(graph_sql(f"select '{DCT}extent' as p, o from ({_EXTENTS}) union all select '{DCT}extent', 'inferred_delta_triples=9'"))
def dataset_refreshed(spark, d):
    """The extents after a later count."""
    doc, made = _dataset(spark, d)
    old = made.unionByName(rdf.extents(doc.limit(1), quads(spark, d).limit(0)))
    return rdf.refreshed(old, rdf.extents(doc, quads(spark, d), 9)).filter(F.col("p") == DCT + "extent").select("p", "o")


@query(graph_sql("select '<' || s || '> <' || p || '> ' || case when o_kind = 'iri' then '<' || o || '>' else '\"' || replace(replace(o, '\\', '\\\\'), '\"', '\\\"') || '\"' || case when o_lang <> '' then '@' || o_lang when o_dt <> '' then '^^<' || o_dt || '>' else '' end end || ' .' as line from triples"))
def sort_triples(spark, d):
    return writers.sorted_triples(quads(spark, d))


# the ten questions and their forms


def _sparql(text: str) -> Query:
    return lambda spark, d: sparql.run(PREFIXES + text, quads(spark, d))


def _cypher(spark, d, text: str) -> DataFrame:
    nodes, edges, external = property_graph(spark, d)
    return cypher.run(text, nodes, edges, external)


def add(name: str, f: Query, sql: str | None) -> None:
    f.__name__ = name
    query(sql)(f)


def _q(p: str, alias: str, more: str = "") -> str:
    return f"(select s, o, o_lang, o_dt from triples where p = '{p}'{more}) {alias}"


_of = lambda c: f" and o = '{ONT}{c}'"
_CLASSES = ("CulturalHeritageEntity", "HeritageSite", "HistoricalPerson", "CulturalObject", "UNESCOHeritageSite", "AdministrativeArea")
add("cq01", _sparql("SELECT ?site ?label ?location WHERE { ?site a o:HeritageSite ; rdfs:label ?label ; o:locatedIn ?location . } ORDER BY ?site"), graph_sql(f"select a.s as site, b.o as label, c.o as location from {_q(TYPE, 'a', _of('HeritageSite'))} join {_q(LABEL, 'b')} on a.s = b.s join {_q(ONT + 'locatedIn', 'c')} on a.s = c.s"))
add("cq02", _sparql("SELECT ?entity ?label WHERE { ?entity a o:HeritageSite ; rdfs:label ?label . } ORDER BY ?label"), graph_sql(f"select a.s as entity, b.o as label from {_q(TYPE, 'a', _of('HeritageSite'))} join {_q(LABEL, 'b')} on a.s = b.s"))
add("cq03", _sparql("SELECT ?site ?label WHERE { ?site a o:UNESCOHeritageSite ; rdfs:label ?label . } ORDER BY ?site"), graph_sql(f"select a.s as site, b.o as label from {_q(TYPE, 'a', _of('UNESCOHeritageSite'))} join {_q(LABEL, 'b')} on a.s = b.s"))
add("cq04", _sparql("SELECT ?entity ?person ?label WHERE { ?entity o:associatedWithPerson ?person ; rdfs:label ?label . } ORDER BY ?entity ?person"), graph_sql(f"select a.s as entity, a.o as person, b.o as label from {_q(ONT + 'associatedWithPerson', 'a')} join {_q(LABEL, 'b')} on a.s = b.s"))
_TC = f"tc(a, b) as (select s, o from triples where p = '{ONT}partOf' union select tc.a, e.o from tc join {_q(ONT + 'partOf', 'e')} on tc.b = e.s)"
add("cq05", _sparql("SELECT ?part ?whole WHERE { ?part o:partOf+ ?whole . } ORDER BY ?part ?whole"), graph_sql("select a as part, b as whole from tc", _TC, True))
add("cq06", _sparql("SELECT ?class (COUNT(?entity) AS ?count) WHERE { ?entity a ?class . FILTER(?class IN (" + ", ".join(f"o:{c}" for c in _CLASSES) + f")) FILTER(STRSTARTS(STR(?entity), \"{RES}\")) }} GROUP BY ?class ORDER BY DESC(?count)"), graph_sql(f"select o as class, count(*) as count from triples where p = '{TYPE}' and o in (" + ", ".join(f"'{ONT}{c}'" for c in _CLASSES) + f") and starts_with(s, '{RES}') group by 1"))
add("cq07", _sparql("SELECT ?entity ?label ?year WHERE { ?entity rdfs:label ?label ; o:recognitionYear ?year . } ORDER BY ?year ?entity"), graph_sql(f"select a.s as entity, b.o as label, a.o as year from {_q(ONT + 'recognitionYear', 'a')} join {_q(LABEL, 'b')} on a.s = b.s"))
add("cq08", _sparql("SELECT ?entity ?label ?lat ?long WHERE { ?entity rdfs:label ?label ; geo:lat ?lat ; geo:long ?long . } ORDER BY ?entity"), graph_sql(f"select a.s as entity, b.o as label, a.o as lat, c.o as long from {_q(GEO + 'lat', 'a')} join {_q(LABEL, 'b')} on a.s = b.s join {_q(GEO + 'long', 'c')} on a.s = c.s"))
add("cq09", _sparql("SELECT ?entity ?external WHERE { ?entity owl:sameAs ?external . } ORDER BY ?entity ?external"), graph_sql(f"select s as entity, o as external from triples where p = '{SAME_AS}'"))
add("cq10", _sparql(f"SELECT ?entity ?label WHERE {{ ?entity rdfs:label ?label . FILTER(LANG(?label) = \"en\") FILTER(STRSTARTS(STR(?entity), \"{RES}\")) }} ORDER BY ?entity"), graph_sql(f"select s as entity, o as label from triples where p = '{LABEL}' and o_lang = 'en'"))
_LOC = f"lc(a, b) as (select s, o from triples where p = '{ONT}locatedIn' union select lc.a, e.o from lc join {_q(ONT + 'locatedIn', 'e')} on lc.b = e.s)"
add("spec_cq01", _sparql("SELECT DISTINCT ?site ?label WHERE { ?site a o:HeritageSite ; rdfs:label ?label ; o:locatedIn+ ?area . ?area rdfs:label \"ASIA\"@en . FILTER(LANG(?label) = \"vi\") } ORDER BY ?label"), graph_sql(f"select distinct t.s as site, l.o as label from {_q(TYPE, 't', _of('HeritageSite'))} join {_q(LABEL, 'l')} on t.s = l.s and l.o_lang = 'vi' join lc on lc.a = t.s join {_q(LABEL, 'x')} on x.s = lc.b and x.o = 'ASIA' and x.o_lang = 'en'", _LOC, True))
add("spec_cq02", _sparql("SELECT ?e ?year WHERE { ?e o:recognitionYear ?year . FILTER(?year < \"1915\"^^xsd:gYear) } ORDER BY ?year ?e"), graph_sql(f"select s as e, o as year from triples where p = '{ONT}recognitionYear' and o::int < 1915"))
add("spec_cq03", _sparql("SELECT DISTINCT ?site WHERE { ?site a o:UNESCOHeritageSite } ORDER BY ?site"), graph_sql(f"select distinct s as site from triples where p = '{TYPE}'{_of('UNESCOHeritageSite')}"))
add("spec_cq04", _sparql("SELECT ?site ?person WHERE { ?site o:builtBy ?person ; o:recognizedBy r:organization-unesco . } ORDER BY ?site"), graph_sql(f"select a.s as site, a.o as person from {_q(ONT + 'builtBy', 'a')} join {_q(ONT + 'recognizedBy', 'b')} on a.s = b.s where b.o = '{RES}organization-unesco'"))
add("spec_cq05", _sparql("SELECT DISTINCT ?e ?label WHERE { { ?e a o:UNESCOHeritageSite . } UNION { ?e a o:AdministrativeArea . } ?e rdfs:label ?label . FILTER(LANG(?label) = \"vi\" || LANG(?label) = \"en\") } ORDER BY ?label"), graph_sql(f"select distinct a.s as e, b.o as label from triples a join {_q(LABEL, 'b')} on a.s = b.s where a.p = '{TYPE}' and a.o in ('{ONT}UNESCOHeritageSite', '{ONT}AdministrativeArea')"))
add("spec_cq06", _sparql("SELECT ?area ?name (COUNT(DISTINCT ?e) AS ?n) WHERE { ?e o:locatedIn ?area . ?area rdfs:label ?name . } GROUP BY ?area ?name ORDER BY DESC(?n) ?area LIMIT 10"), graph_sql(f"select a.o as area, b.o as name, count(distinct a.s) as n from {_q(ONT + 'locatedIn', 'a')} join {_q(LABEL, 'b')} on a.o = b.s group by 1, 2 order by n desc, area limit 10"))
add("spec_cq07", _sparql("SELECT ?e (COUNT(DISTINCT ?label) AS ?n) WHERE { ?e rdfs:label ?label . } GROUP BY ?e HAVING(COUNT(DISTINCT ?label) > 1)"), graph_sql(f"select s as e, count(*) as n from triples where p = '{LABEL}' group by 1 having count(*) > 1"))
add("spec_cq08", _sparql("SELECT ?part WHERE { ?part o:partOf+ r:part-3 . } ORDER BY ?part"), graph_sql(f"select a as part from tc where b = '{RES}part-3'", _TC, True))
add("spec_cq09", _sparql("SELECT ?e ?x ?label WHERE { ?e owl:sameAs ?x ; rdfs:label ?label . } ORDER BY ?e LIMIT 50"), graph_sql(f"select a.s as e, a.o as x, b.o as label from {_q(SAME_AS, 'a')} join {_q(LABEL, 'b')} on a.s = b.s order by e limit 50"))
add("spec_cq10", _sparql("SELECT ?site ?label ?name WHERE { ?site a o:HeritageSite ; rdfs:label ?label ; o:locatedIn ?n . ?n o:locatedIn ?r . ?r rdfs:label ?name . FILTER(LANG(?label) = \"vi\") FILTER(LANG(?name) = \"en\") } ORDER BY ?site"), graph_sql(f"select t.s as site, l.o as label, y.o as name from {_q(TYPE, 't', _of('HeritageSite'))} join {_q(LABEL, 'l')} on t.s = l.s join {_q(ONT + 'locatedIn', 'a')} on a.s = t.s join {_q(ONT + 'locatedIn', 'b')} on b.s = a.o join {_q(LABEL, 'y')} on y.s = b.o"))
add("optional_multi", _sparql("SELECT ?e ?year ?en WHERE { ?e a o:CulturalObject . OPTIONAL { ?e o:recognitionYear ?year } OPTIONAL { ?e rdfs:label ?en . FILTER(LANG(?en) = \"en\") } }"), graph_sql(f"select a.s as e, b.o as year, c.o as en from {_q(TYPE, 'a', _of('CulturalObject'))} left join {_q(ONT + 'recognitionYear', 'b')} on a.s = b.s left join {_q(LABEL, 'c', chr(32) + 'and o_lang = ' + chr(39) + 'en' + chr(39))} on a.s = c.s"))
add("values_join", _sparql("SELECT ?e ?name WHERE { VALUES ?name { \"ASIA\"@en \"EUROPE\"@en } ?e rdfs:label ?name }"), graph_sql(f"select s as e, o as name from triples where p = '{LABEL}' and o_lang = 'en' and o in ('ASIA', 'EUROPE')"))
add("filter_bound", _sparql("SELECT ?e WHERE { ?e a o:HeritageSite . OPTIONAL { ?e owl:sameAs ?x } FILTER(!BOUND(?x)) }"), graph_sql(f"select a.s as e from {_q(TYPE, 'a', _of('HeritageSite'))} where a.s not in (select s from triples where p = '{SAME_AS}')"))
add("graph_union", _sparql("SELECT ?s ?x WHERE { { GRAPH <data> { ?s owl:sameAs ?x } } UNION { GRAPH <external-links> { ?s owl:sameAs ?x } } }"), graph_sql(f"select s, o as x from quads where p = '{SAME_AS}'"))
add("ask", _sparql("ASK { ?s ?p ?o }"), "select true as answer")
add("path_plus_cyclic", lambda spark, d: closure.transitive(_cyclic(spark, d)).select(F.col("a").alias("part"), F.col("b").alias("whole")), "with recursive e as (select p_partkey as a, p_partkey // 2 as b from part where p_partkey > 0 union select 2, 9), tc(a, b) as (select a, b from e union select tc.a, e.b from tc join e on tc.b = e.a) select a as part, b as whole from tc")


def _cyclic(spark, d):
    tree = table(spark, d, "part").filter("p_partkey > 0").select(F.col("p_partkey").alias("a"), F.floor(F.col("p_partkey") / 2).alias("b"))
    return tree.unionByName(spark.createDataFrame([(2, 9)], "a bigint, b bigint"))


# reasoning


def _inferred(spark, d, wanted):
    q = quads(spark, d).filter(F.col("g") == "data")
    return closure.infer(q.drop("g"), schema_quads(spark), wanted=wanted).select("s", "p", "o")


_SUB = f"sc(c, d) as (select s, o from schema_q where p = '{RDFS}subClassOf' union select s, o from schema_q where p = '{OWL}equivalentClass' union select o, s from schema_q where p = '{OWL}equivalentClass' union select sc.c, x.b from sc join (select s as a, o as b from schema_q where p = '{RDFS}subClassOf' union select s, o from schema_q where p = '{OWL}equivalentClass' union select o, s from schema_q where p = '{OWL}equivalentClass') x on sc.d = x.a)"
_DATA = "dt as (select distinct s, p, o from quads where g = 'data')"
_PART = f"pe(a, b) as (select s, o from dt where p = '{ONT}partOf' union select o, s from dt where p = '{ONT}hasMember'), pc(a, b) as (select a, b from pe union select pc.a, pe.b from pc join pe on pc.b = pe.a)"
_RULES = {
    "infer_subclass": (f"select dt.s, dt.p, sc.d as o from dt join sc on dt.p = '{TYPE}' and dt.o = sc.c", TYPE),
    "infer_subproperty": (f"select s, '{ONT}associatedWithPerson' as p, o from dt where p = '{ONT}builtBy'", ONT + "associatedWithPerson"),
    "infer_symmetric": (f"select o as s, p, s as o from dt where p = '{ONT}hasRelatedSite'", ONT + "hasRelatedSite"),
    "infer_transitive": (f"select a as s, '{ONT}partOf' as p, b as o from pc", ONT + "partOf"),
    "infer_inverse": (f"select b as s, '{ONT}hasPart' as p, a as o from pc", ONT + "hasPart"),
    "infer_schema": (f"select c as s, '{RDFS}subClassOf' as p, d as o from sc", RDFS + "subClassOf"),
}
for _name, (_body, _made) in _RULES.items():
    add(_name, lambda spark, d, p=_made: _inferred(spark, d, (p,)), graph_sql(f"select * from ({_body}) except select s, p, o from (select s, p, o from dt union select s, p, o from schema_q)", f"{_DATA}, {_SUB}, {_PART}", True))
add("infer_all", lambda spark, d: _inferred(spark, d, None), graph_sql("select * from (" + " union ".join(f"select * from ({b})" for b, _ in _RULES.values()) + ") except select s, p, o from (select s, p, o from dt union select s, p, o from schema_q)", f"{_DATA}, {_SUB}, {_PART}", True))


@query(graph_sql("select distinct s, p, o from quads where g = 'inferred' except select s, p, o from quads where g <> 'inferred'"))
def novel_inferred(spark, d):
    return closure.novel(quads(spark, d), "inferred").select("s", "p", "o")


@query(graph_sql(f"select s, '{ONT}UNESCOHeritageSite' as o from triples where p = '{ONT}recognizedBy' and o = '{RES}organization-unesco'"))
def infer_hasvalue(spark, d):
    return closure.has_value(rdf.union_graph(quads(spark, d)), ONT + "recognizedBy", RES + "organization-unesco", ONT + "HeritageSite", ONT + "UNESCOHeritageSite").select("s", "o")


@query(graph_sql(f"select a.s, a.o as a, b.o as b from {_q(TYPE, 'a')} join {_q(TYPE, 'b')} on a.s = b.s where a.o = '{ONT}HeritageSite' and b.o = '{ONT}UNESCOHeritageSite'"))
def check_disjoint(spark, d):
    pairs = spark.createDataFrame([(ONT + "HeritageSite", ONT + "UNESCOHeritageSite"), (ONT + "HistoricalPerson", ONT + "HeritageSite")], "a string, b string")
    return closure.disjoint_violations(rdf.union_graph(quads(spark, d)), pairs)


@query(graph_sql(f"select s, p, count(*) as n from triples where p in ('{LABEL}', '{ONT}recognitionYear') group by 1, 2 having count(*) > 1"))
def check_cardinality(spark, d):
    return closure.cardinality_violations(rdf.union_graph(quads(spark, d)), [LABEL, ONT + "recognitionYear"])


# shapes and contracts


PUBLIC = checks.Shape("PublicEntity", (checks.Property(TYPE, 1), checks.Property(LABEL, 1), checks.Property(DCT + "source", 1, kind="iri"), checks.Property(PROV + "wasDerivedFrom", 1, kind="iri")), subjects_of=LABEL)
LATITUDE = checks.Shape("Latitude", (checks.Property(GEO + "lat", datatype=XSD + "decimal", low=-90, high=90),), subjects_of=GEO + "lat")
LONGITUDE = checks.Shape("Longitude", (checks.Property(GEO + "long", datatype=XSD + "decimal", low=-180, high=180),), subjects_of=GEO + "long")


@query(graph_sql(f"select l.s, x.p as path from (select distinct s from triples where p = '{LABEL}') l cross join (values ('{TYPE}'), ('{DCT}source'), ('{PROV}wasDerivedFrom')) x(p) where not exists (select 1 from triples t where t.s = l.s and t.p = x.p)"))
def shacl_mincount(spark, d):
    return checks.shape_violations(rdf.union_graph(quads(spark, d)), PUBLIC).filter("rule = 'minCount'").select("s", "path")


@query(graph_sql(f"select s, 'minInclusive' as rule from triples where (p = '{GEO}lat' and o::double < -90) or (p = '{GEO}long' and o::double < -180) union all select s, 'maxInclusive' from triples where (p = '{GEO}lat' and o::double > 90) or (p = '{GEO}long' and o::double > 180)"))
def shacl_range(spark, d):
    tr = rdf.union_graph(quads(spark, d))
    return checks.shape_violations(tr, LATITUDE).unionByName(checks.shape_violations(tr, LONGITUDE)).select("s", "rule")


@query(graph_sql(f"select s, 'datatype' as rule from triples where p = '{ONT}recognitionYear'"))
def shacl_datatype(spark, d):
    shape = checks.Shape("Year", (checks.Property(ONT + "recognitionYear", datatype=XSD + "integer"),), subjects_of=ONT + "recognitionYear")
    return checks.shape_violations(rdf.union_graph(quads(spark, d)), shape).select("s", "rule")


@query(f"with {_CANON} select entity_id, 'enum:source_status' as rule from canon where item_id is null union all select entity_id, 'conditional:registry_id' from canon where lang = 'de' and item_id is not null")
def schema_violations(spark, d):
    c = _canonical(spark, d)
    broken = c.withColumn("source_status", F.when(F.col("source_status") == "registry_only", "registry").otherwise(F.col("source_status"))).withColumn("registry_id", F.when(F.col("address") != "de", F.col("registry_id")))
    return checks.violations(broken)


@query(f"select * from (values ('Dataset', '{DCT}license', 'nodeKind', 1), ('Dataset', '{rdf.DCAT}distribution', 'minCount', 4), ('Dataset', '{DCT}identifier', 'minCount', 0), ('Activity', '{PROV}startedAtTime', 'datatype', 1)) v(shape, path, rule, n)")
def shacl_dataset(spark, d):
    """A dataset's metadata is valid as it is made; then its licence is text, a distribution and the identifier are missing, and a time is no dateTime."""
    made = _dataset(spark, d)[1]
    check = lambda x: checks.shape_violations(x, checks.DATASET).unionByName(checks.shape_violations(x, checks.ACTIVITY))
    p, of_set = F.col("p"), F.col("s") == RES + "dataset/main"
    left = made.filter(~(of_set & (p == DCT + "identifier")) & ~((p == rdf.DCAT + "distribution") & F.endswith("o", F.lit("inferred"))))
    broken = left.withColumn("o_kind", F.when(p == DCT + "license", "literal").otherwise(F.col("o_kind"))).withColumn("o_dt", F.when(p == PROV + "startedAtTime", XSD + "date").otherwise(F.col("o_dt")))
    return check(broken).select("shape", "path", "rule", F.col("n").cast("int").alias("n")).unionByName(check(made).select("shape", "path", "rule", F.col("n").cast("int").alias("n")))


# one broken field for each kind of rule, by the document's number; the SQL names the rule that the contract gives each
_BROKEN = (
    ("required:entity_id", "entity_id", "null"), ("pattern:entity_id", "entity_id", "'Doc 1'"), ("required:entity_type", "entity_type", "null"), ("enum:entity_type", "entity_type", "'Castle'"), ("required:label_vi", "label_vi", "null"),
    ("minLength:label_vi", "label_vi", "''"), ("minLength:registry_id", "registry_id", "''"), ("minLength:registry_category", "registry_category", "''"), ("minLength:coverage_snapshot", "coverage_snapshot", "''"),
    ("conditional:registry_id", "registry_id", "null"), ("conditional:registry_category", "registry_category", "null"), ("conditional:registry_url", "registry_url", "null"), ("conditional:coverage_snapshot", "coverage_snapshot", "null"),
    ("required:source_status", "source_status", "null"), ("enum:source_status", "source_status", "'registry'"), ("minimum:source_page_id", "source_page_id", "0L"), ("required:retrieved_at", "retrieved_at", "null"),
    ("uniqueItems:aliases_vi", "aliases_vi", "array('a', 'b', 'a')"), ("uniqueItems:site_types", "site_types", "array('x', 'x')"), ("range:birth_year", "birth_year", "0"), ("range:end_year", "end_year", "10000"), ("range:construction_year", "construction_year", "-5"),
    ("range:coordinates", "coordinates", "named_struct('lat', 90.5D, 'lon', 0D)"), ("range:coordinates", "coordinates", "named_struct('lat', 0D, 'lon', -180.5D)"), ("required:coordinates", "coordinates", "named_struct('lat', 1D, 'lon', cast(null as double))"),
    ("required:provenance", "provenance", "null"), ("required:provenance.fields", "provenance", "named_struct('source', 'http://x', 'method', cast(null as string), 'license', 'l')"), ("enum:provenance.method", "provenance", "named_struct('source', 'http://x', 'method', 'hearsay', 'license', 'l')"),
    ("minLength:provenance.license", "provenance", "named_struct('source', 'http://x', 'method', 'fixture', 'license', '')"), ("additional:surprise", "surprise", "'here'"), ("", "source_status", "'derived'"), ("", "source_status", "'registry+wikipedia'"), ("", "source_status", "'registry_only'"),
)


@query(f"select doc_id, rule from (select doc_id, list_extract([{', '.join(repr(r) for r, _, _ in _BROKEN)}], (doc_id % {len(_BROKEN)} + 1)::int) as rule from documents) where rule <> ''")
def contract_rules(spark, d):
    whole = {
        "entity_id": "'doc-1'", "entity_type": "'Museum'", "label_vi": "'Chùa'", "registry_id": "'r'", "registry_category": "'c'", "registry_url": "'http://x'", "source_status": "'registry+enriched'", "coverage_snapshot": "'s'", "source_page_id": "1L", "retrieved_at": "'t'",
        "aliases_vi": "array('a', 'b')", "site_types": "array('x')", "birth_year": "1", "end_year": "9999", "construction_year": "1070", "coordinates": "named_struct('lat', 90D, 'lon', -180D)", "provenance": "named_struct('source', 'http://x', 'method', 'fixture', 'license', 'l')", "surprise": "cast(null as string)",
    }
    case = lambda c: "case " + " ".join(f"when doc_id % {len(_BROKEN)} = {i} then {v}" for i, (_, f, v) in enumerate(_BROKEN) if f == c) + f" else {whole[c]} end"
    rows = table(spark, d, "documents").select("doc_id", *[F.expr(case(c) if any(f == c for _, f, _ in _BROKEN) else whole[c]).alias(c) for c in whole])
    return checks.violations(rows, checks.contract(list(whole)), key="doc_id")


# linking


def _candidates(spark, d):
    """Benchmark items for documents of the same number of words in the first line: a block. Labels without other than ASCII letters: SQL's edit distance counts bytes."""
    first = F.regexp_replace(F.element_at(F.split("text", "\n"), 1), "[^\\x00-\\x7F]", "")
    block = F.size(F.split(first, " ")).alias("block")
    docs = table(spark, d, "documents").select(_d("doc_id").alias("entity_id"), first.alias("label_vi"), block, "n_chars")
    bench = table(spark, d, "benchmark").select(F.concat(F.lit("https://dbpedia.example.org/"), F.col("item_id").cast("string")).alias("uri"), first.alias("label"), block)
    pairs = linking.blocked_pairs(docs, bench, "block")
    return docs.select("entity_id", "label_vi"), pairs.select("entity_id", "uri", "label", F.lit(None).cast("double").alias("score"), F.when(F.col("n_chars") > 1000, 10.0).alias("distance_km"), F.lit(None).cast("boolean").alias("type_compatible"), F.lit("").alias("evidence"))


_KEY = "trim(regexp_replace(replace(lower(regexp_replace(string_split(text, chr(10))[1], '[^\\x00-\\x7F]', '', 'g')), 'ß', 'ss'), '[^\\p{L}\\p{N}\\s]', '', 'g'))"
_PAIRS = f"""a as (select doc_id, n_chars, {_KEY} as k, len(string_split(string_split(text, chr(10))[1], ' ')) as block from documents), b as (select item_id, {_KEY} as k, len(string_split(string_split(text, chr(10))[1], ' ')) as block from benchmark),
p as (select doc_id, item_id, n_chars, case when a.k = '' or b.k = '' then 0.0 else 1 - levenshtein(a.k, b.k)::double / greatest(length(a.k), length(b.k)) end as score from a join b using (block))"""


@query(f"with {_PAIRS} select 'doc-' || doc_id as entity_id, item_id, round(score, 9) as score, case when score >= 0.9 and n_chars <= 1000 then 'verified' when score >= 0.7 then 'manual_review' else 'rejected' end as status from p")
def link_review_status(spark, d):
    recs, cands = _candidates(spark, d)
    out = linking.candidate_links(recs, cands, exact_ratio=False)
    return out.select(F.substring_index("source_uri", "/", -1).alias("entity_id"), F.substring_index("target_uri", "/", -1).cast("bigint").alias("item_id"), F.round("score", 9).alias("score"), "status")


@query()
def link_ratio(spark, d):
    """Whole labels by the reference's ratio; every pair that reaches the review score is among them."""
    first = F.element_at(F.split("text", "\n"), 1)
    docs = table(spark, d, "documents").select(_d("doc_id").alias("entity_id"), first.alias("label"), "n_chars")
    bench = table(spark, d, "benchmark").select(F.concat(F.lit("https://dbpedia.example.org/"), F.col("item_id").cast("string")).alias("uri"), first.alias("label"))
    pairs = linking.similar_candidates(docs, bench)
    cands = pairs.select("entity_id", "uri", "label", F.col("ratio").alias("score"), F.when(F.col("n_chars") > 1000, 10.0).alias("distance_km"), F.lit(None).cast("boolean").alias("type_compatible"), F.lit("").alias("evidence"))
    return linking.candidate_links(docs.withColumnRenamed("label", "label_vi"), cands).select("source_uri", "target_uri", "score", "status")


@query(f"with {_CANON} select '{RES}' || entity_id as source_uri, 'https://www.wikidata.org/entity/' || qid as target_uri, 1.0::double as score, 'verified' as status from canon where qid is not null and qid <> 'Q0' union all select '{RES}' || entity_id, 'https://www.wikidata.org/entity/INVALID', 0.0, 'rejected' from canon where qid = 'Q0'")
def qid_links(spark, d):
    return linking.qid_links(_canonical(spark, d)).select("source_uri", "target_uri", "score", "status")


@query(f"with {_CANON} select distinct '{RES}' || entity_id as s, '{SAME_AS}' as p, 'https://www.wikidata.org/entity/' || qid as o, 'external-links' as g from canon where qid is not null and qid <> 'Q0'")
def verified_links(spark, d):
    return linking.verified_quads(linking.qid_links(_canonical(spark, d))).select("s", "p", "o", "g")


@query("select (select count(*) from orders where o_orderstatus <> 'F') as matched, (select count(*) from orders where o_orderstatus = 'P') as wikidata_linked, (select count(*) from orders where o_orderstatus = 'F') as missing, (select count(*) from orders) as total")
def enrichment_counts(spark, d):
    orders = table(spark, d, "orders")
    pages = orders.filter("o_orderstatus <> 'F'").select(F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("Q"), F.col("o_orderkey").cast("string"))).otherwise("").alias("wikidata_id"))
    return records.enrichment_counts(orders, pages, orders.filter("o_orderstatus = 'F'"))


@query("select c_custkey, case when c_custkey % 3 = 0 then null else c_mktsegment end as got, case when c_custkey % 5 <> 0 then c_mktsegment end as expected from customer where c_custkey % 3 = 0 or c_custkey % 5 = 0 and c_mktsegment is not null")
def expected_mismatches(spark, d):
    """Rows that two results, of which one lacks every third row and the other every fifth value, do not share."""
    c = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("v"))
    wrong = checks.in_order_mismatches(c.filter("c_custkey % 3 <> 0"), c.withColumn("v", F.when(F.col("c_custkey") % 5 != 0, F.col("v"))), "c_custkey")
    return wrong.select("c_custkey", F.col("got.v").alias("got"), F.col("expected.v").alias("expected"))


# property graph


def property_graph(spark, d):
    """nodes, edges and outside links from the quads."""
    tr = rdf.union_graph(quads(spark, d))
    local = lambda c: F.substr(c, F.lit(len(RES) + 1))
    p, o = F.col("p"), F.col("o")
    nodes = tr.groupBy("s").agg(
        F.sort_array(F.collect_set(F.when(p == TYPE, F.substr("o", F.lit(len(ONT) + 1))))).alias("labels"), F.min(F.when((p == LABEL) & (F.col("o_lang") == "vi"), o)).alias("label"), F.min(F.when((p == LABEL) & (F.col("o_lang") == "en"), o)).alias("labelEn"),
        F.min(F.when(p == ONT + "recognitionYear", o)).cast("int").alias("recognitionYear"), F.min(F.when(p == GEO + "lat", o)).cast("double").alias("lat"), F.min(F.when(p == GEO + "long", o)).cast("double").alias("lon"),
    ).select(local("s").alias("entityId"), F.concat(F.array(F.lit("Entity")), "labels").alias("labels"), "label", "labelEn", "recognitionYear", "lat", "lon")
    kinds = {"locatedIn": "LOCATED_IN", "partOf": "PART_OF", "associatedWithPerson": "ASSOCIATED_WITH_PERSON", "recognizedBy": "RECOGNIZED_BY", "hasMember": "HAS_MEMBER", "builtBy": "BUILT_BY", "hasRelatedSite": "HAS_RELATED_SITE"}
    kind = F.create_map(*[F.lit(x) for k, v in kinds.items() for x in (ONT + k, v)])
    relations = tr.filter(F.col("p").isin(*[ONT + k for k in kinds])).select(local("s").alias("src"), kind[F.col("p")].alias("type"), local("o").alias("dst"))
    edges, _ = lpg.edges(relations, nodes)
    return nodes, edges, tr.filter(F.col("p") == SAME_AS).select(local("s").alias("src"), F.col("o").alias("uri"))


def _relations(spark, d):
    tr = rdf.union_graph(quads(spark, d))
    local = lambda c: F.substr(c, F.lit(len(RES) + 1))
    return tr.select(local("s").alias("entityId")).distinct(), tr.filter(F.startswith("o", F.lit(RES)) & F.col("p").isin(ONT + "recognizedBy", ONT + "hasRelatedSite")).select(local("s").alias("src"), F.col("p").alias("type"), local("o").alias("dst"))


_NODE = f"node as (select distinct s from triples)"
_EDGE_P = f"p in ('{ONT}recognizedBy', '{ONT}hasRelatedSite')"


@query(graph_sql(f"select s as src, p as type, o as dst from triples where {_EDGE_P} and o in (select s from node)", _NODE).replace("select s as src, p as type, o as dst", f"select replace(s, '{RES}', '') as src, p as type, replace(o, '{RES}', '') as dst"))
def pg_edges(spark, d):
    nodes, rel = _relations(spark, d)
    return lpg.edges(rel, nodes)[0]


@query(graph_sql(f"select replace(s, '{RES}', '') as src, p as type, replace(o, '{RES}', '') as dst from triples where {_EDGE_P} and o not in (select s from node)", _NODE))
def pg_dangling(spark, d):
    nodes, rel = _relations(spark, d)
    return lpg.edges(rel, nodes)[1]


@query(f"with {_CANON} select entity_id as \"entityId\", label_vi as label, case when true then 'Entity,HeritageSite,CulturalHeritageEntity' end as labels, year::int as \"recognitionYear\" from canon union all select 'organization-unesco', 'UNESCO', 'Entity,Organization', null")
def pg_nodes(spark, d):
    return lpg.nodes(_canonical(spark, d)).select("entityId", "label", F.array_join("labels", ",").alias("labels"), "recognitionYear")


@query(f"with {_CANON} select entity_id as src, 'LOCATED_IN' as type, 'area-' || lang as dst from canon")
def pg_relations(spark, d):
    return lpg.relation_edges(_canonical(spark, d))


@query(graph_sql(f"select replace(o, '{ONT}', '') as label, count(*) as n from triples where p = '{TYPE}' group by 1 union all select 'Entity', count(distinct s) from triples"))
def pg_labels_count(spark, d):
    return lpg.label_counts(property_graph(spark, d)[0])


@query(f"with {_CANON} select entity_id as src, 'https://www.wikidata.org/entity/' || qid as uri from canon where qid is not null union select entity_id, 'https://www.wikidata.org/entity/INVALID' from canon where false")
def pg_same_as(spark, d):
    c = _canonical(spark, d)
    return lpg.same_as(c, linking.qid_links(c), RES)


_local = lambda c: f"replace({c}, '{RES}', '')"
add("cypher_cq01", lambda spark, d: _cypher(spark, d, "MATCH (site:HeritageSite)-[:LOCATED_IN]->(location) RETURN site.entityId AS entity, site.label AS label, location.entityId AS location ORDER BY entity"), graph_sql(f"select {_local('a.s')} as entity, b.o as label, {_local('c.o')} as location from {_q(TYPE, 'a', _of('HeritageSite'))} join {_q(LABEL, 'b')} on a.s = b.s join {_q(ONT + 'locatedIn', 'c')} on a.s = c.s"))
add("cypher_cq02", lambda spark, d: _cypher(spark, d, "MATCH (entity:HeritageSite) RETURN entity.entityId AS entity, entity.label AS label ORDER BY label"), graph_sql(f"select {_local('a.s')} as entity, b.o as label from {_q(TYPE, 'a', _of('HeritageSite'))} join {_q(LABEL, 'b')} on a.s = b.s"))
add("cypher_cq03", lambda spark, d: _cypher(spark, d, "MATCH (site:UNESCOHeritageSite) RETURN site.entityId AS site, site.label AS label ORDER BY site"), graph_sql(f"select {_local('a.s')} as site, b.o as label from {_q(TYPE, 'a', _of('UNESCOHeritageSite'))} join {_q(LABEL, 'b')} on a.s = b.s"))
add("cypher_cq04", lambda spark, d: _cypher(spark, d, "MATCH (entity)-[:ASSOCIATED_WITH_PERSON]->(person) RETURN entity.entityId AS entity, person.entityId AS person, entity.label AS label ORDER BY entity"), graph_sql(f"select {_local('a.s')} as entity, {_local('a.o')} as person, b.o as label from {_q(ONT + 'associatedWithPerson', 'a')} join {_q(LABEL, 'b')} on a.s = b.s where a.o in (select s from triples)"))
add("cypher_cq08", lambda spark, d: _cypher(spark, d, "MATCH (entity:Entity) WHERE entity.lat IS NOT NULL AND entity.lon IS NOT NULL RETURN entity.entityId AS entity, entity.label AS label, entity.lat AS lat, entity.lon AS lon ORDER BY entity"), graph_sql(f"select {_local('a.s')} as entity, b.o as label, a.o::double as lat, c.o::double as lon from {_q(GEO + 'lat', 'a')} join {_q(LABEL, 'b')} on a.s = b.s and b.o_lang = 'vi' join {_q(GEO + 'long', 'c')} on a.s = c.s"))
add("cypher_cq10", lambda spark, d: _cypher(spark, d, "MATCH (entity:Entity) WHERE entity.labelEn IS NOT NULL RETURN entity.entityId AS entity, entity.labelEn AS label ORDER BY entity"), graph_sql(f"select {_local('s')} as entity, o as label from triples where p = '{LABEL}' and o_lang = 'en'"))
add("cypher_cq05", lambda spark, d: _cypher(spark, d, "MATCH (part)-[:PART_OF*1..]->(whole) RETURN part.entityId AS part, whole.entityId AS whole ORDER BY part, whole"), graph_sql(f"select {_local('a')} as part, {_local('b')} as whole from tc", _TC, True))
add("cypher_cq06", lambda spark, d: _cypher(spark, d, "MATCH (entity:Entity) UNWIND labels(entity) AS class WITH class, count(entity) AS count WHERE class IN ['HeritageSite', 'UNESCOHeritageSite', 'CulturalObject'] RETURN class, count ORDER BY count DESC"), graph_sql(f"select {_local('o').replace(RES, ONT)} as class, count(*) as count from triples where p = '{TYPE}' and o in ('{ONT}HeritageSite', '{ONT}UNESCOHeritageSite', '{ONT}CulturalObject') group by 1"))
add("cypher_cq07", lambda spark, d: _cypher(spark, d, "MATCH (e:Entity) WHERE e.recognitionYear IS NOT NULL RETURN e.entityId AS entity, e.label AS label, e.recognitionYear AS year ORDER BY year, entity"), graph_sql(f"select {_local('a.s')} as entity, b.o as label, a.o::int as year from {_q(ONT + 'recognitionYear', 'a')} join {_q(LABEL, 'b')} on a.s = b.s and b.o_lang = 'vi'"))
add("cypher_cq09", lambda spark, d: _cypher(spark, d, "MATCH (entity)-[:SAME_AS]->(x:External) RETURN entity.entityId AS entity, x.uri AS external ORDER BY entity"), graph_sql(f"select {_local('s')} as entity, o as external from triples where p = '{SAME_AS}'"))
add("parity_diff", lambda spark, d: checks.parity(*[x.select(*[t.parity_value(F.col(c), rdf.BASE).alias(c) for c in ("entity", "location")]) for x in (sparql.run(PREFIXES + "SELECT ?entity ?location WHERE { ?entity a o:HeritageSite ; o:locatedIn ?location }", quads(spark, d)), _cypher(spark, d, "MATCH (a:UNESCOHeritageSite)-[:LOCATED_IN]->(b) RETURN a.entityId AS entity, b.entityId AS location"))]), graph_sql(f"select {_local('a.s')} as entity, {_local('c.o')} as location, 'left' as side from {_q(TYPE, 'a', _of('HeritageSite'))} join {_q(ONT + 'locatedIn', 'c')} on a.s = c.s where a.s not in (select s from triples where p = '{TYPE}'{_of('UNESCOHeritageSite')})"))


# the service


def _entities(spark, d):
    return service.entities(rdf.union_graph(quads(spark, d)))


_ENT = f"lab as (select s, min({{'value': o, 'lang': o_lang}}) as l from triples where p = '{LABEL}' group by 1), ent as (select s, l.value as label, l.lang as lang from lab)"


@query(graph_sql(f"select s, label from ent where contains(lower(label), 'green') or s in (select s from triples where p = '{ONT}address' and contains(lower(o), 'street 1'))", _ENT))
def search_text(spark, d):
    e = _entities(spark, d)
    found = e.filter(service.conditions({"q": "GREEN"})[0] | service.conditions({"location": "street 1"})[0])
    return found.select("s", F.col("label.value").alias("label"))


@query(graph_sql(f"select (select count(*) from ent where s in (select s from triples where p = '{TYPE}'{_of('CulturalObject')}) and s in (select s from triples where p = '{ONT}recognitionYear' and o = '1910')) as total", _ENT))
def search_filters(spark, d):
    return service.search(_entities(spark, d), {"entity_type": "CulturalObject", "year": "1910"})[0]


@query(graph_sql(f"select s as id, label as value from ent where s in (select s from triples where p = '{TYPE}'{_of('HeritageSite')}) order by lower(label), s limit 25 offset 25", _ENT))
def search_page(spark, d):
    return service.search(_entities(spark, d), {"entity_type": "HeritageSite", "page": "2"})[1].select("id", "value")


@query(graph_sql(f"select s as id, (select string_agg(distinct o, '|' order by o) from triples t where t.s = ent.s and p = '{TYPE}') as types, (select string_agg(distinct o, '|' order by o) from triples t where t.s = ent.s and p = '{SAME_AS}') as links from ent", _ENT))
def search_grouped(spark, d):
    return _entities(spark, d).select(F.col("s").alias("id"), F.array_join("types", "|").alias("types"), F.nullif(F.array_join("external_links", "|"), F.lit("")).alias("links"))


@query(graph_sql(f"select (select count(distinct s) from triples where p = '{TYPE}'{_of('CulturalHeritageEntity')} and s in (select s from triples where p = '{LABEL}')) as total, (select count(*) from triples where p = '{SAME_AS}') as links"))
def stats_totals(spark, d):
    s = service.stats(rdf.union_graph(quads(spark, d)))
    return s["total"].crossJoin(s["links"].withColumnRenamed("count", "links"))  # one row each


@query(graph_sql(f"select o as type, count(distinct s) as count from triples where p = '{TYPE}' and s in (select s from triples where p = '{LABEL}') group by 1"))
def stats_by_class(spark, d):
    return service.stats(rdf.union_graph(quads(spark, d)))["classes"]


@query(graph_sql(f"select o as category, count(distinct s) as count from triples where p = '{DCT}subject' group by 1"))
def stats_by_category(spark, d):
    return service.stats(rdf.union_graph(quads(spark, d)))["categories"]


@query(graph_sql(f"select p, string_agg(distinct o, '|' order by o) as vals from triples where s = '{RES}site-1' group by 1"))
def entity_detail(spark, d):
    return service.entity(quads(spark, d), "site-1")["fields"].select("p", F.array_join(F.array_distinct("values"), "|").alias("vals"))


@query(graph_sql(f"select s, count(*) as n from triples where s = '{RES}site-1' group by 1"))
def entity_json_ld(spark, d):
    doc = writers.json_ld(rdf.union_graph(quads(spark, d)), RES + "site-1")
    return doc.select("s", F.regexp_count("json", F.lit('"@(?:value|id)":')).cast("bigint").alias("n")).withColumn("n", F.col("n") - 1)


@query("select count(*) as n, count(*) filter (ok) as passed, bool_and(ok) as ok from (select count(*) > 0 as ok from documents union all select count(*) > 0 from pages union all select false)")
def final_gate(spark, d):
    one = lambda n: table(spark, d, n).agg((F.count("*") > 0).alias("ok")).select(F.lit(n).alias("name"), "ok")
    return checks.gate(one("documents").unionByName(one("pages")).unionByName(spark.createDataFrame([("no", False)], "name string, ok boolean")))
