"""Ladders, rule sets, merges, ratios and parts: defined cases on small tables, and brute force."""

import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from edicta.functions import ladders, rule_sets, text
from edicta.operators import dedup, matching, setops


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_rule_sets(spark):
    c, schema = F.lower("t"), "t string"
    rows = [("Ordenanza de ruidos y derechos",), ("Derechos por concesion",), ("Plan  regulador",), ("Otra cosa",), (None,), ("",)]
    assert one(spark, rows, schema, rule_sets.first_list(c, rule_sets.AXES, rule_sets.DEFAULT_AXIS, True)) == [("convivencia_ruidos",), ("derechos_tarifas",), ("obras_espacio_publico",), ("organizacion_participacion",), ("organizacion_participacion",), ("organizacion_participacion",)]
    assert one(spark, [("tránsito",), ("vehiculo",), ("parquímetro",)], schema, rule_sets.first_list(c, rule_sets.FOLDERS, "x")) == [("transito_transporte",), ("x",), ("transito_transporte",)]


def test_basket(spark):
    rows = [("aseo y derechos", None, None), ("cambio de nombre de calles", None, "convivencia_ruidos"), ("otra", None, "convivencia_ruidos"), ("otra", "mascotas", None), ("otra", "mascotas", "aseo_residuos"), (None, None, None), ("aseosos", "", ""), ("bolsas plasticas", None, None), ("concesiones, permisos y servicios", None, None)]
    got = one(spark, rows, "t string, m string, d string", F.array_join(rule_sets.basket(F.col("t"), F.col("m"), F.col("d")), ","))
    assert [x[0] for x in got] == ["aseo_ambiente,derechos", "", "seguridad_ruidos", "mascotas", "aseo_ambiente,mascotas", "", "", "aseo_ambiente", "derechos"]


def test_ascii_folded(spark):
    rows = [("Ñandú, º ª ²",), ("Ｒｕｉｄｏ ﬁno № 5…",), ("Рaz",), ("  á  ",), (None,), ("",)]
    assert [x[0] for x in one(spark, rows, "t string", text.ascii_folded(F.col("t")))] == ["nandu, o a 2", "ruido fino no 5...", "az", "a", None, ""]


def test_date_and_number_ladders(spark):
    steps, default = ladders.DATES["post"]
    rows = [("publicado 5 de marzo de 2020", ""), ("5 de nada de 2020 en /uploads/2019/07/", ""), ("", "https://a/2018-x"), (None, None)]
    assert [x[0] for x in one(spark, rows, "t string, u string", ladders.climbed(steps, default, {"text": F.col("t"), "url": F.col("u")}))] == ["2020-03-05", "2019-07-01", "2018", "S/F"]
    rows = [("2026-01-01", "", "DA-1-18062024.pdf"), ("2026-01-01", "", "x-2024-13-31.pdf"), ("2031", "https://a/2021/04/x", "x.pdf"), ("2020-05-01", "https://a/2021/04/x", "x.pdf"), ("2020-01-01", "", ""), (None, "", ""), ("1999-01-01", "", "acta 2015.pdf")]
    assert [x[0] for x in one(spark, rows, "d string, u string, f string", ladders.recovered_date(F.col("d"), F.col("u"), F.col("f")))] == ["2024-06-18", "", "2021-04", "2020-05-01", "", None, "2015"]
    rows = [("12-3f8a", "x", "a"), ("DOC-ABC", "x", "a"), ("2020", "x", "da_77.pdf"), ("2021", "Decreto exento N° 55", "b"), ("7", "x", "2016-5939.pdf"), (None, None, None), ("9", "Compilado de normas", "b")]
    assert [x[0] for x in one(spark, rows, "n string, t string, f string", ladders.repaired_number(F.col("n"), F.col("t"), F.lit("https://a/x"), F.col("f")))] == ["12", "S/N", "77", "55", "5939", "S/N", "Compilado"]


def test_title_repairs(spark):
    rows = [("Ordenanza de aseo ordenanza de aseo", "b.pdf"), ("Descargar", "norma-de_aseo.pdf"), ("untitled_1", "DA+1678.2023+Aprueba+Ordenanza+sobre+Ruidos.pdf"), ("Enlace 2016 Decreto Exento ordenanza de alumbrado 5939 28-12-2016 Enlace", "x.pdf"), ("Documento", "uso-de-mascarilla.pdf"), ("Compilado", "x"), (None, None), ("Ordenanza 5", None)]
    got = one(spark, rows, "t string, f string", ladders.repaired_title(F.col("t"), F.lit("Villa Alta"), F.lit(None).cast("string"), F.col("f")))
    assert [x[0] for x in got] == ["Ordenanza de aseo", "Ordenanza Municipal de Villa Alta — norma de aseo", "Ordenanza sobre Ruidos", "Ordenanza de alumbrado", "Ordenanza Municipal de Villa Alta — uso de mascarilla", "Compilado de Ordenanzas Municipales — Villa Alta", "", "Ordenanza 5"]


def test_merge_of_shards(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, "b", 2), (3, "c", 3)], "s int, k string, v int")
    assert {r.finding: r.n for r in setops.merge_findings(df, "s", "k", 4).collect()} == {"rows": 3, "rows without key": 0, "keys in several shards": 0, "missing shards": 1}
    with pytest.raises(ValueError, match="1 missing shards"):
        setops.merged(df, "s", "k", 4)
    with pytest.raises(ValueError, match="keys in several shards"):
        setops.merged(df.unionByName(spark.createDataFrame([(2, "a", 9)], df.schema)), "s", "k", 4)
    assert setops.merged(df.unionByName(spark.createDataFrame([(2, "d", 9)], df.schema)), "s", "k", 4).columns == ["k", "v"]
    assert setops.merge_findings(df.limit(0), "s", "k", 0).where("finding = 'rows'").first().n == 0


def test_best_ratio_is_that_of_all_pairs(spark):
    rng = random.Random(2)
    names = ["san pedro", "san pedro de la paz", "arica", "lota", "talca", "talcahuano", "pica", "chepica", "ab", "io"]
    typed = ["arica", "zzzz", "", None, "oi", "a b"]
    for _ in range(150):
        w = list(rng.choice(names))
        for _ in range(rng.randint(1, 4)):
            w.insert(rng.randrange(len(w) + 1), rng.choice("aeiouxz "))
            if rng.random() < 0.6:
                w.pop(rng.randrange(len(w)))
        typed.append("".join(w))
    got = {r.t: (r.n, round(r.ratio, 6)) for r in matching.best_ratio(spark.createDataFrame([(x,) for x in typed], "t string"), "t", spark.createDataFrame([(x,) for x in [*names, None, ""]], "n string"), "n").collect()}
    want = {}
    for t in {x for x in typed if x and x.strip()}:
        r, n = min((-SequenceMatcher(None, t, n).ratio(), n) for n in names)
        if -r >= 0.72:
            want[t] = (n, round(-r, 6))
    assert got == want and len(want) > 60


def test_replace_partition_with_nulls(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v int, p string")
    new = spark.createDataFrame([(4, "a"), (5, None)], "v int, p string")
    assert sorted(r.v for r in dedup.replace_partition(old, new, "p").collect()) == [2, 3, 4, 5]


def test_stream_rewrites_only_what_a_batch_touches(spark, tmp_path):
    from edicta.streaming import upserts

    schema, inc = "k string, v int, t int", tmp_path / "in"
    run = lambda: upserts.ingest_available(spark, str(inc), schema, str(tmp_path / "t"), str(tmp_path / "c"), ["k"], "t")
    spark.createDataFrame([(f"k{i}", i, 1) for i in range(300)], schema).coalesce(1).write.parquet(str(inc), mode="append")
    run()
    for n in (2, 3, 4):
        spark.createDataFrame([("k7", 100 + n, n), (f"new{n}", n, n)], schema).coalesce(1).write.parquet(str(inc), mode="append")
        run()
    rows = {r.k: r.v for r in upserts.current(spark, str(tmp_path / "t")).collect()}
    assert len(rows) == 303 and rows["k7"] == 104 and rows["k8"] == 8 and rows["new3"] == 3
    touched = [d for d in (tmp_path / "t" / "v00000003").iterdir() if d.name.startswith("_part=")]
    assert 1 <= len(touched) <= 2


def test_a_folder_of_the_machine_serves_local_sessions_only(spark, monkeypatch):
    from edicta import session

    class Far:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://far:7077"

            class getConf:
                get = staticmethod(lambda *a: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Far)
    kept = session.cut(spark.range(3), "kept")
    assert kept.count() == 3 and session.discard(spark) >= 1 and session.discard(spark) == 0


def test_contained_in_finds_every_text(spark):
    rng = random.Random(5)
    wholes = ["".join(rng.choice("abc ") for _ in range(rng.randint(3, 30))) for _ in range(80)] + ["", None]
    parts = ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 6))) for _ in range(200)] + [None, "", "x" * 5000, "ab"]
    got = {r.p: r.w for r in matching.contained_in(spark.createDataFrame([(x,) for x in parts], "p string"), "p", spark.createDataFrame([(x,) for x in wholes], "w string"), "w").collect()}
    want = {p: min(w for w in wholes if w and p in w) for p in parts if p and len(p) >= 3 and any(w and p in w for w in wholes)}
    assert got == want and want


def test_exploded_texts_are_never_broadcast(spark):
    """However small Spark takes the exploded texts for, only what was asked is sent to all tasks."""
    from edicta import session

    parts = spark.createDataFrame([("aseo",), ("ruidos",), ("zzz",)], "p string")
    wholes = session.cut(spark.createDataFrame([(f"ordenanza de {x} {i}",) for i in range(50) for x in ("aseo", "ruidos")], "w string"), "wholes")
    got = matching.contained_in(parts, "p", wholes, "w")
    plan = got._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert [x for x in re.findall(r"\) BroadcastExchange\nInput \[\d+\]: \[([^\]]*)", plan) if "_b#" in x] == []
    assert {r.p: r.w for r in got.collect()} == {"aseo": "ordenanza de aseo 0", "ruidos": "ordenanza de ruidos 0"}
