"""Readers: JSON lines, HTML tables and links, wiki pages, Turtle and N-Triples, manifests."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as t

RAW = "registry_id string, registry_category string, label_vi string, registry_url string, source_status string, coverage_snapshot string, retrieved_at string, registry_fields map<string,string>, page_id bigint, title string, source_url string, wikidata_id string, aliases_vi array<string>, coordinates struct<lat:string,lon:string>, _corrupt string"
WIKI = "query struct<pages:array<struct<pageid:bigint,title:string,missing:boolean,pageprops:struct<wikibase_item:string>,coordinates:array<struct<lat:double,lon:double>>,categories:array<struct<title:string>>,links:array<struct<title:string>>,extract:string,revisions:array<struct<revid:bigint,slots:struct<main:struct<content:string>>>>>>,redirects:array<struct<`from`:string,`to`:string>>>"
QUAD = T.StructType([T.StructField(c, T.StringType()) for c in ("s", "s_kind", "p", "o", "o_kind", "o_lang", "o_dt", "g")])


def json_lines(spark: SparkSession, path, schema: str = RAW) -> DataFrame:
    """Records of JSON lines; blank lines are none, unreadable ones come with _corrupt set."""
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(path)


class _Rows(HTMLParser):
    """Cells and links of the rows of tables' bodies; a cell's text is all text below it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[list[str], list[str]]] = []
        self.body = self.cell = 0
        self.row: tuple[list[str], list[str]] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tbody":
            self.body += 1
        elif tag == "tr" and self.body:
            self.row = ([], [])
            self.rows.append(self.row)
            self.cell = 0
        elif tag in ("td", "th") and self.row is not None:
            self.row[0].append("")
            self.cell = 1
        elif tag == "a" and self.row is not None:
            self.row[1].extend(v or "" for k, v in attrs if k == "href")

    def handle_endtag(self, tag):
        if tag == "tbody":
            self.body -= 1
        elif tag == "tr":
            self.row, self.cell = None, 0
        elif tag in ("td", "th"):
            self.cell = 0

    def handle_data(self, data):
        if self.cell and self.row is not None:
            self.row[0][-1] += data


class _Links(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.links: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links += [v for k, v in attrs if k == "href" and v is not None]


def _parsed(kind: type[HTMLParser], page: str | None):
    p = kind()
    p.feed(page or "")
    p.close()
    return p


def table_rows(pages: DataFrame, html_col: str, footer: list[str]) -> DataFrame:
    """A row for each table row: the other columns, at (place in its page), cells, hrefs. Empty, footer and header rows are left out."""
    kept = [f for f in pages.schema if f.name != html_col]
    schema = T.StructType([*kept, T.StructField("at", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType())), T.StructField("hrefs", T.ArrayType(T.StringType()))])

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for i, page in enumerate(f[html_col]):
                out += [(i, at, cells, hrefs) for at, (cells, hrefs) in enumerate(_parsed(_Rows, page).rows)]
            got = pd.DataFrame(out, columns=["_i", "at", "cells", "hrefs"])
            yield pd.concat([f.drop(columns=[html_col]).iloc[got["_i"].astype(int)].reset_index(drop=True), got.drop(columns=["_i"])], axis=1)

    cells = F.transform("cells", lambda c: t.collapsed(c))
    out = pages.mapInPandas(rows, schema).withColumn("cells", cells)
    is_footer = F.exists("cells", lambda c: c.rlike("(?i)" + "|".join(f"(?:{p})" for p in footer))) if footer else F.lit(False)
    return out.filter((F.size("cells") > 0) & F.exists("cells", lambda c: c != "") & ~is_footer & ~t.is_header(F.col("cells")))


def links(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, at, href of each link of a page."""
    kind = pages.schema[id_col].dataType

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([(i, at, h) for i, page in zip(f[id_col], f[html_col], strict=True) for at, h in enumerate(_parsed(_Links, page).links)], columns=[id_col, "at", "href"])

    return pages.select(id_col, html_col).mapInPandas(rows, T.StructType([T.StructField(id_col, kind), T.StructField("at", T.IntegerType()), T.StructField("href", T.StringType())]))


def row_records(rows: DataFrame, columns: dict[str, int], base_url: str, key: str, url: str, snapshot: str, retrieved_at: str) -> DataFrame:
    """Records of table rows by a category's column numbers; rows without a label are left out."""
    at = lambda i: F.try_element_at(F.col("cells"), F.lit(i + 1))
    fields = F.map_filter(F.map_from_arrays(F.array(*[F.lit(k) for k in columns]), F.array(*[at(i) for i in columns.values()])), lambda k, v: v.isNotNull())
    part = lambda n: F.col("registry_fields")[n]
    out = rows.withColumn("registry_fields", fields).withColumn("label_vi", at(columns["label_vi"])).filter("label_vi <> ''")
    out = out.withColumn("registry_url", t.valid_url(t.joined_url(F.lit(base_url), F.coalesce(F.try_element_at(F.col("hrefs"), F.lit(1)), F.lit(""))), F.lit(url)))
    identity = t.identity_parts(F.col("label_vi"), part("ordinal"), part("recognition_text"), part("location"))
    return out.select(
        t.registry_id(F.lit(None).cast("string"), F.col("registry_url"), F.lit(key), identity).alias("registry_id"), F.lit(key).alias("registry_category"), "label_vi", "registry_url",
        F.lit("registry_only").alias("source_status"), F.lit(snapshot).alias("coverage_snapshot"), F.lit(retrieved_at).alias("retrieved_at"), "registry_fields",
    )


def wiki_pages(responses: DataFrame, json_col: str, retrieved_at: str, base_url: str) -> DataFrame:
    """A row for each page of API responses that is not missing, and the title asked for where a redirect led to it."""
    got = responses.select(F.from_json(json_col, WIKI).alias("r"))
    # not explode: Spark would read the JSON once more, to leave out what has no pages before
    got = got.select(F.posexplode_outer("r.query.pages").alias("at", "p"), F.col("r.query.redirects").alias("redirects")).filter("at is not null")
    p = F.col("p")
    came = F.filter("redirects", lambda r: r["to"] == F.col("p.title"))
    content = F.try_element_at(p["revisions"], F.lit(1))["slots"]["main"]["content"]
    first = F.try_element_at(p["coordinates"], F.lit(1))
    return got.filter(~F.coalesce(p["missing"], F.lit(False))).select(
        p["pageid"].alias("page_id"), p["title"].alias("title"), F.coalesce(F.try_element_at(came, F.lit(1))["from"], p["title"]).alias("requested_title"),
        p["pageprops"]["wikibase_item"].alias("wikidata_id"), F.when(first.isNotNull(), F.struct(first["lat"].alias("lat"), first["lon"].alias("lon"))).alias("coordinates"),
        infobox(content).alias("infobox"), F.transform(p["categories"], lambda c: t.category(c["title"])).alias("categories"), F.transform(p["links"], lambda c: c["title"]).alias("links"),
        p["extract"].alias("abstract"), F.try_element_at(p["revisions"], F.lit(1))["revid"].alias("revision_id"), t.page_url(base_url, p["title"]).alias("source_url"), F.lit(retrieved_at).alias("retrieved_at"),
    )


def _with(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value) for an `of` that names it more than once: a lambda's variable is computed once, an expression inside of one each time it is met."""
    return F.element_at(F.transform(F.array(value), of), 1)


def infobox(wikitext: Column) -> Column:
    """Keys and values of the first innermost template whose name has "infobox"; values split at every bar, so a bar inside a link ends one."""
    templates = F.regexp_extract_all(wikitext, F.lit(r"\{\{([^{}]*)\}\}"), F.lit(1))
    box = F.try_element_at(F.filter(templates, lambda x: F.contains(F.lower(F.substring_index(x, "|", 1)), F.lit("infobox"))), F.lit(1))
    pairs = _with(F.split(box, r"\|"), lambda x: F.filter(F.slice(x, F.lit(2), F.size(x)), lambda y: F.contains(y, F.lit("="))))
    entries = F.transform(pairs, lambda x: F.struct(F.replace(F.lower(F.trim(F.substring_index(x, "=", 1))), F.lit(" "), F.lit("_")).alias("k"), F.trim(F.regexp_replace(F.regexp_extract(x, r"(?s)^[^=]*=(.*)$", 1), r"\s+", " ")).alias("v")))
    last = _with(entries, lambda x: F.filter(x, lambda e, i: ~F.exists(F.slice(x, i + 2, F.size(x)), lambda y: y["k"] == e["k"])))
    return F.coalesce(F.map_from_entries(last), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def api_params(titles: list[str], properties: str = "pageprops|coordinates|categories|links|extracts|revisions") -> dict[str, str]:
    """Parameters of one batch request."""
    return {"action": "query", "format": "json", "formatversion": "2", "redirects": "1", "prop": properties, "rvprop": "ids|content", "rvslots": "main", "exintro": "1", "explaintext": "1", "titles": "|".join(titles)}


def batches(labels: DataFrame, order: str, size: int = 50) -> DataFrame:
    """Labels with a batch number, in order. Numbers come from counts of ranges, not from one sorted task."""
    from ..operators.records import numbered

    return numbered(labels, order, "n").withColumn("batch", F.floor((F.col("n") - 1) / size))


NTRIPLE = r'^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(?:<([^>]*)>|(_:\S+)|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z-]+)|\^\^<([^>]*)>)?)\s*\.\s*$'


def n_triples(spark: SparkSession, path: str, graph: str) -> DataFrame:
    """Quads of N-Triples files; comments and blank lines are none, any other unreadable line fails."""
    line = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(#.*)?$"))
    part = lambda i: F.regexp_extract("value", NTRIPLE, i)
    checked = line.withColumn("value", F.when(F.col("value").rlike(NTRIPLE), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no triple: "), "value"))))
    literal = (part(3) == "") & (part(4) == "")
    plain = F.replace(F.replace(F.replace(F.replace(part(5), F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t")), F.lit("\\\\"), F.lit("\\"))
    return checked.select(
        F.regexp_replace(part(1), "[<>]", "").alias("s"), F.when(F.startswith(part(1), F.lit("_:")), "bnode").otherwise("iri").alias("s_kind"), part(2).alias("p"),
        F.when(literal, plain).when(part(3) != "", part(3)).otherwise(part(4)).alias("o"), F.when(literal, "literal").when(part(3) != "", "iri").otherwise("bnode").alias("o_kind"),
        part(6).alias("o_lang"), part(7).alias("o_dt"), F.lit(graph).alias("g"),
    )


_TURTLE = re.compile(r'\s+|#[^\n]*|(?P<iri><[^>]*>)|(?P<string>"""(?:[^\\]|\\.)*?"""|"(?:[^"\\\n]|\\.)*")|(?P<lang>@[A-Za-z-]+)|(?P<type>\^\^)|(?P<number>[+-]?[0-9]+(?:\.[0-9]+)?)|(?P<bnode>_:\w+)|(?P<name>[\w-]*:[\w.-]*\w|[\w-]+:|a\b|true\b|false\b|@?prefix\b)|(?P<mark>[.;,\[\]()])', re.S)
RDF_NS, XSD_NS = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2001/XMLSchema#"


def turtle(text: str, graph: str) -> list[tuple]:
    """Quads of a small Turtle text (prefixes, predicate and object lists, blank nodes, collections): ontologies and shapes, on the driver."""
    tokens: list[tuple[str, str]] = []
    at = 0
    while at < len(text):
        m = _TURTLE.match(text, at)
        if not m:
            raise ValueError(f"no Turtle at {text[at : at + 40]!r}")
        if m.lastgroup:
            tokens.append((m.lastgroup, m[0]))
        at = m.end()
    tokens = [("mark", "@prefix") if k == "lang" and v == "@prefix" else (k, v) for k, v in tokens]
    prefix: dict[str, str] = {}
    out: list[tuple] = []
    i = n_blank = 0

    def blank() -> tuple[str, str, str, str]:
        nonlocal n_blank
        n_blank += 1
        return (f"_:{graph}{n_blank}", "bnode", "", "")

    def iri(value: str) -> str:
        if value[0] == "<":
            return value[1:-1]
        if value == "a":
            return RDF_NS + "type"
        p, _, local = value.partition(":")
        return prefix[p] + local

    def node() -> tuple[str, str, str, str]:
        nonlocal i
        kind, value = tokens[i]
        i += 1
        if kind in ("iri", "name") and value not in ("true", "false"):
            return (iri(value), "iri", "", "")
        if kind == "bnode":
            return (value, "bnode", "", "")
        if kind == "number":
            return (value, "literal", "", XSD_NS + ("decimal" if "." in value else "integer"))
        if kind == "name":
            return (value, "literal", "", XSD_NS + "boolean")
        if kind == "string":
            body = value[3:-3] if value.startswith('"""') else value[1:-1]
            body = re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), body)
            if i < len(tokens) and tokens[i][0] == "lang":
                i += 1
                return (body, "literal", tokens[i - 1][1][1:], "")
            if i < len(tokens) and tokens[i][0] == "type":
                i += 2
                return (body, "literal", "", iri(tokens[i - 1][1]))
            return (body, "literal", "", "")
        if value == "[":
            b = blank()
            predicates(b, "]")
            i += 1
            return b
        if value == "(":
            items = []
            while tokens[i][1] != ")":
                items.append(node())
            i += 1
            head = rest = (RDF_NS + "nil", "iri", "", "")
            for item in reversed(items):
                head = blank()
                out.append((head[0], head[1], RDF_NS + "first", *item, graph))
                out.append((head[0], head[1], RDF_NS + "rest", *rest, graph))
                rest = head
            return head
        raise ValueError(f"no term: {value}")

    def predicates(subject: tuple, end: str) -> None:
        nonlocal i
        while tokens[i][1] != end:
            p = node()[0]
            while True:
                o = node()
                out.append((subject[0], subject[1], p, *o, graph))
                if tokens[i][1] != ",":
                    break
                i += 1
            while tokens[i][1] == ";":
                i += 1

    while i < len(tokens):
        if tokens[i][1] in ("@prefix", "prefix", "PREFIX"):
            prefix[tokens[i + 1][1].rstrip(":")] = tokens[i + 2][1][1:-1]
            i += 3
            if i < len(tokens) and tokens[i][1] == ".":
                i += 1
            continue
        predicates(node(), ".")
        i += 1
    return out


def turtle_quads(spark: SparkSession, text: str, graph: str) -> DataFrame:
    return spark.createDataFrame(turtle(text, graph), QUAD)


def first_wins(rows: DataFrame, key: str, value: str, rank: list[str]) -> DataFrame:
    """key and the value of its first row by rank, of rows that have both."""
    return rows.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.min_by(value, F.struct(*rank)).alias(value))


def last_wins(rows: DataFrame, key: str, value: str, rank: list[str]) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(value, F.struct(*rank)).alias(value))


def latest_file(spark: SparkSession, pattern: str) -> DataFrame:
    """path, modificationTime and content of the newest file that matches."""
    return spark.read.format("binaryFile").load(pattern).orderBy(F.desc("modificationTime"), F.desc("path")).limit(1)


def text_files(spark: SparkSession, pattern: str, expected: int | None = None) -> DataFrame:
    """name, text, sha256 of files; with `expected`, another number of them fails."""
    got = spark.read.text(pattern, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), F.col("value").alias("text"), F.sha2("value", 256).alias("sha256"))
    if expected is not None and (n := got.count()) != expected:
        raise ValueError(f"{n} query files, {expected} expected")
    return got


def categories(spark: SparkSession, config: dict) -> DataFrame:
    """Source categories with defaults filled in; a wrong configuration fails."""
    if not {"base_url", "categories"} <= config.keys():
        raise ValueError("CONFIG_INVALID: base_url and categories are needed")
    base, default, rows = config["base_url"], config.get("defaults", {}), []
    for n, c in enumerate(config["categories"]):
        if not {"key", "url", "entity_type", "columns"} <= c.keys() or not c["url"].startswith(base) or "label_vi" not in c["columns"]:
            raise ValueError(f"CONFIG_INVALID: category {c.get('key')}")
        rows.append((n, c["key"], c["url"], c["entity_type"], c.get("subclass"), {k: int(v) for k, v in c["columns"].items()}, c.get("footer_patterns", default.get("footer_patterns", []))))
    return spark.createDataFrame(rows, "ordinal int, key string, url string, entity_type string, subclass string, columns map<string,int>, footer_patterns array<string>")
