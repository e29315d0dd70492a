"""Readers, writers and the stream that no query of the catalogue goes through."""

import os
import time

from pyspark.sql import functions as F

from loomgraph.sources import readers, writers
from loomgraph.streaming import ingest


def test_json_lines_blank_and_unreadable_ones(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"registry_id": "a", "label_vi": "Huế"}\n\n   \n{"registry_id": \n', encoding="utf-8")
    got = readers.json_lines(spark, str(tmp_path / "in.jsonl")).cache()
    assert sorted((x.registry_id or "", x.label_vi, x._corrupt is not None) for x in got.collect()) == [("", None, True), ("a", "Huế", False)]
    writers.json_lines(got.filter("_corrupt IS NULL").select("registry_id", "label_vi"), str(tmp_path / "out"), ["registry_id"])
    assert "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("*.json")) == '{"registry_id":"a","label_vi":"Huế"}\n'


def test_files(spark, tmp_path):
    for i, name in enumerate(("CQ01.rq", "CQ02.rq")):
        (tmp_path / name).write_text(f"ASK {{}} # {i}")
        os.utime(tmp_path / name, (time.time() - i * 1000,) * 2)
    assert readers.latest_file(spark, f"{tmp_path}/*.rq").first().path.endswith("CQ01.rq")
    got = readers.text_files(spark, f"{tmp_path}/*.rq", 2)
    assert sorted(x.name for x in got.collect()) == ["CQ01.rq", "CQ02.rq"] and all(len(x.sha256) == 64 for x in got.collect())
    try:
        readers.text_files(spark, f"{tmp_path}/*.rq", 10)
        raise AssertionError("a wrong number of files passed")
    except ValueError:
        pass
    assert readers.api_params(["A", "B"])["titles"] == "A|B"


def test_graphs_are_replaced_one_by_one(spark, tmp_path):
    to = str(tmp_path / "store")
    q = spark.createDataFrame([("s", "p", "1", "a"), ("s", "p", "2", "b")], "s string, p string, o string, g string")
    writers.replace_graphs(q, to)
    writers.replace_graphs(q.filter("g = 'b'").withColumn("o", F.lit("3")), to)
    assert sorted((x.g, x.o) for x in spark.read.parquet(to).collect()) == [("a", "1"), ("b", "3")]


def test_manifest_stream_upserts_and_resumes(spark, tmp_path):
    schema, source, target, at = "key string, v int", tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "at")
    source.mkdir()
    run = lambda: ingest.manifest_stream(spark, str(source), schema, "key", target, at).awaitTermination(120)
    now = lambda: sorted((x.key, x.v) for x in ingest.current(spark, target, schema).collect())
    assert now() == []
    (source / "1.json").write_text('{"key": "a", "v": 1}\n{"key": "b", "v": 1}\n{"v": 9}\n')
    assert run() and now() == [("a", 1), ("b", 1)]
    (source / "2.json").write_text('{"key": "b", "v": 2}\n{"key": "c", "v": 2}\n')
    assert run() and now() == [("a", 1), ("b", 2), ("c", 2)]
    assert run() and now() == [("a", 1), ("b", 2), ("c", 2)]


def test_wiki_pages_read_their_json_once(spark):
    """Null pages, responses without pages and redirects as before; the plan parses once, and an infobox of many entries is no slower for each of them."""
    import json

    page = {"pageid": 1, "title": "A", "coordinates": [{"lat": 1.0, "lon": 2.0}], "categories": [{"title": "Category:X"}], "revisions": [{"revid": 5, "slots": {"main": {"content": "{{Infobox q| A b = 1 |a=2|A b = x  y|z}}"}}}]}
    got = [{"query": {"pages": [page, None, {"title": "B", "missing": True}], "redirects": [{"from": "a", "to": "A"}]}}, {"query": {"pages": []}}, {"query": None}, {}]
    df = spark.createDataFrame([(json.dumps(x),) for x in got] + [("no JSON",), (None,)], "j string")
    out = readers.wiki_pages(df, "j", "t", "http://w/")
    rows = sorted(out.select("page_id", "requested_title", "infobox", "categories", "source_url").collect(), key=str)
    assert [tuple(r) for r in rows] == [(1, "a", {"a_b": "x y", "a": "2"}, ["X"], "http://w/A"), (None, None, {}, None, None)]
    plan = out.select("page_id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    text = "{{Infobox big|" + "|".join(f"k{i} = {'v' * 50}" for i in range(400)) + "}} " + "word " * 50_000
    began = time.time()
    assert spark.createDataFrame([(text,)] * 4, "x string").select(readers.infobox("x").alias("b")).selectExpr("sum(size(b))").first()[0] == 1600
    assert time.time() - began < 30
