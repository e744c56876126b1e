"""Readers, sinks and streams on files."""

import json

import pytest
from pyspark.sql import functions as F

from edicta.sources import formats, sinks
from edicta.streaming import upserts


def test_csv_with_mark(spark, tmp_path):
    df = spark.createDataFrame([("Ñuñoa", "13"), ('a "b", c', None)], "comuna string, region string")
    assert sinks.write_small_csv(df, str(tmp_path / "x.csv")) == 2
    assert (tmp_path / "x.csv").read_bytes()[:3] == b"\xef\xbb\xbf"
    back = formats.read_csv(spark, str(tmp_path / "x.csv"), "comuna string, region string").collect()
    assert back[0].comuna == "Ñuñoa" and back[1].region is None
    with pytest.raises(ValueError):
        sinks.write_small_csv(df, str(tmp_path / "y.csv"), limit=1)
    sinks.write_csv(df, str(tmp_path / "parts"))
    assert spark.read.csv(str(tmp_path / "parts"), header=True).count() == 2


def test_missing_path_gives_default(spark, tmp_path):
    assert formats.read_default(spark, str(tmp_path / "no"), "a string").count() == 0
    (tmp_path / "yes.json").write_text('{"a": "1"}')
    assert formats.read_default(spark, str(tmp_path / "yes.json"), "a string").first().a == "1"


def test_envelope_contract(spark):
    good, bad = json.dumps({"count": 1, "records": [{"a": "x"}]}), json.dumps({"count": 2, "records": [{"a": "x"}]})
    rec = "struct<a: string>"
    df = lambda j: spark.createDataFrame([(j,)], "j string").select(formats.envelopes(F.col("j"), rec).alias("e"))
    assert formats.checked_records(df(good), "e").first().a == "x"
    with pytest.raises(Exception, match="declared count"):
        formats.checked_records(df(bad), "e").collect()


def test_markdown_files(spark, tmp_path):
    d = tmp_path / "01" / "x"
    d.mkdir(parents=True)
    (d / "a.md").write_text('---\nid: "1"\ntitulo: "dice \\"hola\\""\nnum: 5\n---\n\nCuerpo\n---\nfin')
    (d / "b.txt").write_text("no")
    rows = formats.read_markdown(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and rows[0].meta == {"id": "1", "titulo": 'dice "hola"', "num": "5"} and rows[0].body == "Cuerpo\n---\nfin"


def test_pdf_magic(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.bin").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "y.pdf").write_bytes(b"<html>")
    assert [r.path.rsplit("/", 1)[1] for r in formats.read_pdfs(spark, str(tmp_path)).collect()] == ["x.bin"]


def test_html(spark):
    page = "<table><tr><td>MZ1<td><a href='u1'>N &amp; M</a> <i>x</i><tr><td>MZ2</table><iframe src='f.pdf'></iframe><option value=\"7\"> Siete </option>"
    df = spark.createDataFrame([(page,), (None,), ("",), ("<td>solo",)], "h string")
    rows = [r.t for r in df.select(formats.table_rows(F.col("h")).alias("t")).collect()]
    assert [[c.text for c in r] for r in rows[0]] == [["MZ1", "N & M x"], ["MZ2"]] and rows[0][0][1].href == "u1" and rows[1] is None and rows[2] == [] and rows[3][0][0].text == "solo"
    r = df.select(formats.frames(F.col("h")).alias("f"), formats.options(F.col("h")).alias("o"), formats.strip_tags(F.col("h")).alias("s")).first()
    assert r.f == ["f.pdf"] and (r.o[0].code, r.o[0].name) == ("7", "Siete") and r.s.startswith("MZ1 N & M x MZ2")


def test_js_and_bindings(spark):
    df = spark.createDataFrame([('window.X.y = {"a": 1};\n', '{"results": {"bindings": [{"u": {"value": "v"}}, {}]}}')], "js string, b string")
    r = df.select(formats.unwrapped_js(F.col("js")).alias("j"), formats.bindings(F.col("b"), ["u"]).alias("b")).first()
    assert json.loads(r.j) == {"a": 1} and [x.u for x in r.b] == ["v", None]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "13", "t|1"), ("b", "05", None)], "id string, region string, t string")
    sinks.write_partitioned_text(df.fillna(""), "t", ["region"], str(tmp_path / "p"))
    assert (tmp_path / "p" / "region=13").exists()
    assert df.select(sinks.table_lines(["id", "t"]).alias("l")).first().l == "| a | t\\|1 |"
    html = spark.createDataFrame([("<b id='n'>0</b> x",), ("<i>z</i>",)], "h string").select(sinks.replaced_element(F.col("h"), "n", F.lit("7")).alias("h")).collect()
    assert [r.h for r in html] == ["<b id='n'>7</b> x", "<i>z</i>"]
    assert json.loads(sinks.envelope(df, "id").first().value)["count"] == 2


def test_stream_upserts_each_file_once(spark, tmp_path):
    schema, inc = "k string, v long, t long", tmp_path / "in"
    put = lambda n, rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(inc))
    run = lambda: upserts.ingest_available(spark, str(inc), schema, str(tmp_path / "t"), str(tmp_path / "c"), ["k"], "t")
    put(1, [("a", 1, 1), ("a", 2, 2), ("b", 1, 1)])
    run()
    put(2, [("b", 9, 0), ("c", 3, 1)])
    run()
    run()  # nothing new
    assert {(r.k, r.v) for r in upserts.current(spark, str(tmp_path / "t")).collect()} == {("a", 2), ("b", 1), ("c", 3)}


def test_windowed_counts_on_a_table(spark, sf_dir):
    n = upserts.windowed_counts(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts")
    assert n.agg(F.sum("n")).first()[0] == spark.read.parquet(f"{sf_dir}/events.parquet").count()
