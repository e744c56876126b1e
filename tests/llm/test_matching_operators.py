"""Canonical names, subjects, deduplication, linkage, mixing: defined cases on small tables, and brute force."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from edicta.llm import acts, canonical, incremental, linkage, mixture, subjects

NAMES = ["San Pedro", "San Pedro del Mar", "Ñuñomar", "Villa Alta", "Los Lonmapulli", "Colotucahue"]


# -- canonical names (problem 7)


@pytest.mark.parametrize(
    ("typed", "name"),
    [("SAN PEDRO", "San Pedro"), ("san-pedro-del-mar", "San Pedro del Mar"), ("I. Municipalidad de Nunomar", "Ñuñomar"), ("ÑuÃ±omar", "Ñuñomar"), ("Los L0nmapu1li", "Los Lonmapulli"), ("LosLonmapulli", "Los Lonmapulli"), ("Villa Alta, Región del Sur", "Villa Alta"),
     ("oClotucahe", "Colotucahue"), ("Sn. Pedro", "San Pedro"), ("Gobierno Regional", ""), ("-", ""), ("", ""), ("???", ""), ("Springfield", ""), ("x" * 100_000, ""), ("Соlоtuсаhuе", "Colotucahue")],
)
def test_resolved(typed, name):
    assert canonical.Resolver(dict.fromkeys(NAMES, 1)).resolve(typed) == name


def test_ties_go_to_the_frequent_name():
    r = canonical.Resolver({"Malvano": 1, "Malveno": 9})
    assert r.resolve("Malvino") == "Malveno"
    assert canonical.Resolver({"Malvano": 1, "Malveno": 1}).resolve("Malvino") == "Malvano"


def test_symmetric_deletes_find_what_brute_force_finds():
    rng = random.Random(5)
    r = canonical.Resolver(dict.fromkeys(NAMES, 1))
    for _ in range(300):
        w = list(canonical.key(rng.choice(NAMES)))
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(w))
            rng.choice([lambda: w.pop(i), lambda: w.insert(i, "q"), lambda: w.__setitem__(i, "q")])()
        k = "".join(w)
        best = min((canonical.weighted_distance(k, c, 2), c) for c in r.by_key)
        want = "" if best[0] > min(2, max(1, len(k) // 4)) else best[1]
        assert canonical.key(r.resolve(k)) == want or k in r.by_key


def test_resolve_column(spark):
    df = spark.createDataFrame([(1, "SAN PEDRO"), (2, None), (3, "San Pedro"), (4, "nada"), (1, "SAN PEDRO")], "id long, c string").withColumn("name", F.lit("clash"))
    ref = spark.createDataFrame([(n,) for n in NAMES] + [(None,), ("San Pedro",)], "comuna_nombre string")
    counts = canonical.reference_counts(ref, "comuna_nombre", (df, "c"))
    assert counts["San Pedro"] == 1 and len(counts) == len(NAMES)
    rows = [(r.id, r.canonical) for r in canonical.resolve_column(canonical.not_exact(df, "c", counts), "c", counts).collect()]
    assert sorted(rows) == [(1, "San Pedro"), (1, "San Pedro"), (4, "")]
    assert canonical.resolve_column(df.limit(0), "c", counts).count() == 0
    assert [r.canonical for r in canonical.resolve_column(df, "c", {}).where("id = 2").collect()] == [None]


def test_joined_gives_what_the_dictionary_gives(spark, monkeypatch):
    """A reference over the limit takes the way of joins by itself, in every function that takes names."""
    long = "Aguas " * 30 + "Claras"
    typed = ["SAN PEDRO", None, "San Pedro", "nada", "oClotucahe", "Los L0nmapu1li", "", "Ñuñomr", "San Pedro", "villa-alta", "x" * 5000, long[:-1], long.replace("C", "K")]
    df = spark.createDataFrame(list(enumerate(typed)), "id long, c string").withColumn("d", F.lit("clash")).withColumn("v", F.lit(0))
    ref = spark.createDataFrame([(n,) for n in NAMES] + [(None,), (long,)], "comuna_nombre string")
    small = canonical.reference_counts(ref, "comuna_nombre", (df, "c"))
    monkeypatch.setattr(canonical, "MAX_REFERENCE", 3)
    large = canonical.reference_counts(ref, "comuna_nombre", (df, "c"))
    assert isinstance(small, dict) and {r.name: r.times for r in large.collect()} == small
    for run in (lambda n: canonical.resolve_column(df, "c", n), lambda n: canonical.resolve_column(canonical.not_exact(df, "c", n), "c", n), lambda n: acts.with_commune(df, "c", n, "canonical")):
        a, b = ({r.id: r.canonical for r in run(n).collect()} for n in (small, large))
        assert a == b
    assert {r.id: r.canonical for r in canonical.resolve_column(df, "c", large).collect()}[11] == long


# -- attributes of acts


def test_act_attributes(spark):
    df = spark.createDataFrame([("Nº12", "2020-03-05"), ("0012", "5/3/2020"), ("12/2018", "2020/03"), ("1.078", "año 1999"), ("S/N", "S/F"), (None, None), ("", "")], "n string, d string")
    rows = df.select(acts.number(F.col("n")).alias("n"), acts.date_parts(F.col("d")).alias("d")).collect()
    assert [r.n for r in rows] == [12, 12, 12, 1078, None, None, None]
    assert [(r.d.day, r.d.month, r.d.year) for r in rows] == [("2020-03-05", "2020-03", 2020), ("2020-03-05", "2020-03", 2020), (None, "2020-03", 2020), (None, None, 1999), (None, None, None), (None, None, None), (None, None, None)]


def test_canonical_url(spark):
    same = ["https://a.example/x/y.pdf", "HTTP://www.A.example:443//x/./y.pdf/?utm_source=b#p", "https://a.example/x/y.pdf?download=1"]
    df = spark.createDataFrame([(u,) for u in [*same, "https://a.example/listado/101/1/2008?m=0", None, "", "%%%"]], "u string")
    got = [r[0] for r in df.select(incremental.canonical_url(F.col("u"))).collect()]
    assert set(got[:3]) == {"a.example/x/y.pdf"} and got[3:] == [None, None, None, None]


# -- incremental deduplication (problem 4)

DUP = "record_id long, lote int, comuna string, numero string, fecha string, fecha_publicidad string, titulo string, sha256 string, target_url string"
T = "Ordenanza N° 5: Regula materias de ferias libres y chacareras"


def records(spark, rows):
    return spark.createDataFrame(rows, DUP).withColumn("a", F.lit("clash")).withColumn("num", F.lit("clash"))


def found(df):
    return {(r.record_id, r.dup_record_id) for r in incremental.duplicates(df, "lote", {"San Pedro": 1, "Villa Alta": 1}).collect()}


def test_duplicates(spark):
    h = "a" * 64
    rows = [
        (1, 1, "San Pedro", "5", "2020-01-02", None, T, h, "https://a.example/d/1"),
        (2, 1, "SAN PEDRO", "Nº5", "02-01-2020", None, T + ".", h, "https://b.example/d/9"),  # the same file elsewhere
        (3, 2, "San Pedro", "5", "2020-01-02", None, "ORDENANZA N° 5: REGULA MATERIAS DE FERIAS LIBRES E INCLUYE CHACARERAS", "b" * 64, "https://c.example/z"),  # another file
        (4, 2, "San Pedro", "6", "2020-01-02", None, "Ordenanza N° 6: Regula materias de ferias libres y chacareras", h, "https://a.example/d/1"),  # another number
        (5, 2, "San Pedro", None, "2020-01-02", None, T, None, "https://www.a.example/d/1/"),  # no number
        (6, 3, "Villa Alta", "5", "2020-01-02", None, T, "c" * 64, "https://d.example/d/1"),  # another commune
        (7, 3, "San Pedro", "5", "2021-01-02", None, T, "d" * 64, "https://e.example/d/1"),  # another year
        (8, 3, None, None, None, None, None, "", None), (9, 3, None, None, None, None, None, "", None), (10, 3, "San Pedro", "S/N", "S/F", "", "", None, ""),
        (11, 3, "San Pedro", "9", None, None, "x" * 20_000, None, "https://e.example/d/7"), (12, 3, "San Pedro", "9", None, None, "x" * 20_000, None, "https://e.example/d/7"),
    ]
    assert found(records(spark, rows)) == {(1, 2), (1, 3), (1, 5), (11, 12)}


def test_duplicates_chain_over_batches_and_empty(spark):
    rows = [(i, i, "San Pedro", "5", "2020-01-02", None, T, f"{i // 2:064d}", f"https://a.example/d/{(i + 1) // 2}") for i in range(1, 8)]
    assert found(records(spark, rows)) == {(1, i) for i in range(2, 8)}
    assert found(records(spark, [])) == set()


def test_order_of_arrival_decides_not_ids(spark):
    rows = [(10, 1, "San Pedro", "5", "2020-01-02", None, T, "a" * 64, "https://a.example/d/1"), (5, 2, "San Pedro", "5", "2020-01-02", None, T, "a" * 64, "https://a.example/d/1"), (7, None, "San Pedro", "5", "2020-01-02", None, T, None, None)]
    assert found(records(spark, rows)) == {(10, 5), (10, 7)}


def test_a_record_that_joins_two_acts_moves_the_later_one(spark, tmp_path):
    """Batch by batch, the history opened anew for each: r3 shows r1 and r2, too far apart by themselves, to be one act."""
    t1, t3, t2 = T, T + "abcd", T + "abcdefgh"
    rows = [(1, 1, "Villa Alta", "9", "2020-01-02", None, "Regula materias de aseo", None, None)] + [(i, n, "San Pedro", "5", "2020-01-02", None, t, None, None) for i, n, t in ((11, 2, t1), (12, 3, t2), (14, 4, t2), (13, 5, t3))]
    df, out = records(spark, rows), []
    for n in range(1, 6):
        history = incremental.History(spark, f"file://{tmp_path}/h", {"San Pedro": 1, "Villa Alta": 1})
        out.append({tuple(r) for r in history.ingest(df.where(f"lote = {n}")).collect()})
        history.close()
    assert out == [set(), set(), set(), {(12, 14)}, {(11, 12), (11, 13), (11, 14)}]
    assert {tuple(r) for r in incremental.History(spark, f"file://{tmp_path}/h", {}).duplicates().collect()} == {(11, 12), (11, 13), (11, 14)}


def test_records_without_title_meet_by_number(spark):
    h = "b" * 64
    rows = [(1, 1, "San Pedro", "5", "2020-01-02", None, T, h, None), (2, 2, "San Pedro", "5", None, None, None, h, None), (3, 2, "San Pedro", "5", "2020-03-02", None, "", None, None), (4, 3, "San Pedro", None, None, None, None, h, None), (5, 3, "San Pedro", "6", None, None, None, h, None), (6, 4, "San Pedro", "5", "2020-01-02", None, T, None, None)]
    assert found(records(spark, rows)) == {(1, 2), (1, 3), (1, 6)}


def test_pivot_pruning_loses_nothing(spark):
    rng = random.Random(3)
    rows, ids = [], rng.sample(range(1000), 120)  # ids that say nothing of the order
    for i in range(120):
        t = list(T if i % 2 else T.replace("ferias libres", "ruidos molestos"))
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(10, len(t))] = rng.choice("aeiou")
        rows.append((ids[i], 1 + i // 40, "San Pedro", str(5 + i % 3), "2020-01-02", None, "".join(t), None, None))
    df = records(spark, rows).drop("a", "num")
    base = incremental.prepared(df, {"San Pedro": 1}).collect()
    spark_pairs = found(df)
    # brute force: link every two records of one number whose titles are near, take components
    turn = {i: (n // 40, i) for n, i in enumerate(ids)}
    near = spark.createDataFrame([(a.rid, b.rid, a.tk, b.tk) for a in base for b in base if a.rid < b.rid and a.num == b.num], "a long, b long, x string, y string")
    edges = {(r.a, r.b) for r in near.where(F.levenshtein("x", "y") <= incremental.R).collect()}
    first = dict(turn)
    for _ in range(120):
        for a, b in edges:
            first[a] = first[b] = min(first[a], first[b])
    assert spark_pairs == {(v[1], k) for k, v in first.items() if v[1] != k}


# -- linkage (problem 5)


def test_linkage(spark):
    names = {"San Pedro": 1, "Villa Alta": 1}
    left = spark.createDataFrame(
        [(1, "San Pedro", "5", "Ordenanza sobre ferias libres, sector El Boldo", "2020-01-20"), (2, "San Pedro", None, "ORDENANZA LOCAL DE RUIDOS MOLESTOS EN LAS PALMAS", "2020-02-01"), (3, "Villa Alta", "7", "Ordenanza N° 7 de Villa Alta", "2019-05-05"), (4, None, None, None, None), (1, "San Pedro", "5", "Ordenanza sobre ferias libres, sector El Boldo", "2020-01-20")],
        "id long, comuna_nombre string, numero string, titulo string, fecha string",
    )
    right = spark.createDataFrame(
        [(11, "san pedro", "Nº5", "Ordenanza N° 5: Aprueba ordenanza sobre ferias libres en el sector El Boldo", "2020-01-02", None), (12, "San Pedro", "6", "Ordenanza N° 6: Aprueba ordenanza sobre ferias libres en el sector El Boldo", "2020-01-02", None), (13, "San Pedro", "S/N", "Regula materias de ruidos molestos, sector Las Palmas", "2020-01-25", None), (14, "Villa Alta", "7", "Decreto N° 7: Regula materias de aseo", "2019-05-01", None), (15, "San Pedro", "5", "Ordenanza N° 5: Aprueba ordenanza sobre ferias libres en el sector El Boldo", "2014-01-02", None), (16, None, None, None, None, None)]
        + [(100 + i, "Villa Alta", str(200 + i), f"Regula materias de asunto número {i} cualquiera", f"20{10 + i % 10}-03-04", None) for i in range(40)],
        "record_id long, comuna string, numero string, titulo string, fecha string, fecha_publicidad string",
    )
    a = linkage.attributes(left, "id", "comuna_nombre", "numero", "titulo", ["fecha"], names)
    b = linkage.attributes(right, "record_id", "comuna", "numero", "titulo", ["fecha", "fecha_publicidad"], names)
    got = sorted((r.id, r.rid) for r in linkage.linked(a, b).collect())
    assert sorted(set(got)) == [(1, 11), (2, 13), (3, 14)]
    assert all(0.5 <= r.confidence <= 1 for r in linkage.linked(a, b).collect())
    assert linkage.linked(a.limit(0), b).count() == 0


def test_linkage_over_the_turn_of_the_year(spark):
    """Every pair that compared() finds near is proposed, the year of either side aside."""
    names = {"San Pedro": 1}
    days = ["2018-12-30", "2018-12-31", "2019-01-02", "2019-03-15", "2019-08-04", "2019-10-20", "2019-12-31"]
    left = spark.createDataFrame([(i, "San Pedro", "5", "Ordenanza sobre ferias libres, sector El Boldo", d) for i, d in enumerate(days)], "id long, comuna_nombre string, numero string, titulo string, fecha string")
    other = ["2018-12-31", "2019-01-02", "2019-01-03", "2019-03-20", "2019-05-29", "2020-01-02", "2020-05-28"]
    dated = [(100 + i, "San Pedro", "5", "Ordenanza N° 5: Regula materias de ferias libres, sector El Boldo", d, None) for i, d in enumerate(other)]
    right = spark.createDataFrame(dated + [(r[0] + 100, *r[1:4], None, r[4]) for r in dated], "record_id long, comuna string, numero string, titulo string, fecha string, fecha_publicidad string")
    a = linkage.attributes(left, "id", "comuna_nombre", "numero", "titulo", ["fecha"], names)
    b = linkage.attributes(right, "record_id", "comuna", "numero", "titulo", ["fecha", "fecha_publicidad"], names)
    gap = lambda x, y: (datetime.date.fromisoformat(x) - datetime.date.fromisoformat(y)).days
    want = {(i, r + late * 100) for i, x in enumerate(days) for r, y in enumerate(other, 100) for late in (0, 1) if (-150 if late else -2) <= gap(x, y) <= 75}
    assert {(r.id, r.rid) for r in linkage.compared(a, b).where("date = 'near'").collect()} == want
    # without a number the yearly keys of the title's ends serve
    assert {(r.id, r.rid) for r in linkage.compared(a.withColumn("num", F.lit(None).cast("int")), b).where("date = 'near'").collect()} == want


def test_linkage_in_a_crowded_commune(spark):
    """However many pairs agree by chance, acts with equal numbers and titles, and titles alone where dates say it, are found."""
    rng = random.Random(11)
    left, right, want = [], [], {"equal": set(), "missing": set()}
    for i in range(1200):
        day = datetime.date(2018, 1, 1) + datetime.timedelta(rng.randrange(1400))
        late = day + datetime.timedelta(rng.randrange(12))
        num, s = rng.randint(1, 30), f"{rng.choice(['ferias libres', 'ruidos molestos', 'aseo ornato', 'tenencia mascotas'])} boldo palmas {rng.choice(['norte', 'sur', 'oriente', 'poniente', 'centro', 'laguna', 'quebrada', 'estero', 'puerto', 'bosque', 'molino', 'cantera'])}"
        lone = rng.random() < 0.3
        row = lambda key, n, d, s: (key, "A", n, str(d), str(d)[:7], d.year, False, s)
        left.append(row(i, num, late, s if rng.random() < 0.8 else ""))
        right.append(row(10_000 + i, None if lone else num, day, s))
        if left[-1][-1]:
            want["missing" if lone else "equal"].add((i, 10_000 + i))
    schema = "id long, commune string, num int, day string, month string, year int, late boolean, s string"
    rows = linkage.linked(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).collect()
    got = {(r.id, r.rid) for r in rows}
    assert len(want["equal"] & got) >= 0.99 * len(want["equal"])
    assert len(want["missing"] & got) >= 0.95 * len(want["missing"])
    assert len((want["equal"] | want["missing"]) & got) >= 0.5 * len(got)


def test_em_separates_patterns():
    match, other = {"number": "equal", "date": "near", "title": "same", "commune": "equal"}, {"number": "differ", "date": "conflict", "title": "differ", "commune": "equal"}
    share, m, u = linkage.estimate([(match, 300), (other, 700)])
    assert abs(share - 0.3) < 0.02 and linkage.posterior(match, share, m, u) > 0.99 and linkage.posterior(other, share, m, u) < 0.01
    assert linkage.estimate([])[0] > 0


# -- subjects (problem 3)


def test_candidates_are_pairs_of_numbers(spark):
    """Similar clauses are those of brute force, and their candidates are shuffled without their texts."""
    texts = ["ferias libres", "ferias libre", "feriaas libres", "ruidos molestos", "ruidos molestos nocturnos", "aseo"]
    nodes = spark.createDataFrame([(x,) for x in texts], "clause string")
    got = subjects.similar(nodes, nodes)
    assert "keys=[clause#" not in got._jdf.queryExecution().executedPlan().toString()
    tri = lambda x: {f" {x} "[i : i + 3] for i in range(len(x))}
    assert {(r.clause, r.near) for r in got.collect()} == {(x, y) for x in texts for y in texts if x != y and len(tri(x) & tri(y)) >= subjects.SIMILAR * len(tri(y))}


def test_subjects(spark):
    areas = spark.createDataFrame([("ruido",), ("aseo",)], "area string")
    rows = [(i, "ordenanza n° 5: regula materias de ruidos molestos y emisiones sonoras", None, ["ruido"] if i % 5 else ["aseo"]) for i in range(10)]
    rows += [(20 + i, "regula materias de recoleccion de residuos", None, ["aseo"]) for i in range(10)]
    rows += [(40 + i, "regula materias de bolsas y envases, sector los pinos", None, ["Limpieza"]) for i in range(4)] + [(50 + i, "regula materias de recoleccion de residuos", None, ["Limpieza"]) for i in range(6)]
    rows += [(60, "regula materias de ruidos molestos y emisiones sonoras y recoleccion de residuos", None, ["ruido"]), (61, "regula materias de recolecion de residuos", None, []), (62, "ordenanza n° 7 de los pinos", "los pinos", ["aseo"]), (63, None, None, ["Varias"]), (64, "", None, []), (65, "zzz " * 3000, None, ["ruido"])]
    df = spark.createDataFrame(rows, "key long, title string, place string, declared array<string>").withColumn("clause", F.lit("clash"))
    got = {}
    for r in subjects.subjects(df, areas).collect():
        got.setdefault(r.key, set()).add(r.area)
    assert got[0] == {"ruido"} and got[20] == {"aseo"} and got[60] == {"ruido", "aseo"} and got[61] == {"aseo"} and got[62] == {"aseo"} and got[40] == {"aseo"} and got[65] == {"ruido"}
    assert 63 not in got and 64 not in got
    assert subjects.subjects(df.limit(0), areas).count() == 0


def test_labels_go_on_over_unlabelled_clauses(spark):
    """Chains of any length, against reachability by brute force; a seed of two areas passes both on; scattered votes give none."""
    chain = ["control de ruidos molestos", "control de ruidoz molestos", "control de ruidoz molextos", "controf de ruidoz molextos", "controf de ruidoz mplextos"]
    scattered = [("esta comuna", f"area{i}", 3) for i in range(4)]
    votes = spark.createDataFrame([(chain[0], "aseo", 5), ("bailes y ferias libres", "ruido", 30), ("bailes y ferias libres", "comercio", 25), ("bailes y ferias libres", "aseo", 3), *scattered], "clause string, area string, n long")
    clauses = [*chain, "bailes y ferias libres", "bailes y ferias libress", "esta comuna", "nada parecido"]
    got = {}
    for r in subjects.propagated(votes, spark.createDataFrame([(c,) for c in clauses], "clause string")).collect():
        got.setdefault(r.clause, set()).add(r.area)

    def tri(c):
        return {f" {c} "[i : i + 3] for i in range(len(c))}

    reached, hops = {chain[0]}, 0
    while more := {c for c in chain for x in reached if c not in reached and len(tri(c) & tri(x)) / len(tri(x)) >= subjects.SIMILAR and set(c.split()) & set(x.split()) - {"de"}}:
        reached, hops = reached | more, hops + 1
    assert hops >= 2 and {c for c in chain if "aseo" in got.get(c, ())} == reached == set(chain)
    assert got["bailes y ferias libres"] == got["bailes y ferias libress"] == {"ruido", "comercio"}
    assert "esta comuna" not in got and "nada parecido" not in got


# -- mixing (problem 9)


def test_mixture(spark):
    docs = spark.createDataFrame([(i, "big", 10 + i % 7) for i in range(3000)] + [(10_000 + i, "small", 10) for i in range(20)] + [(20_000, None, 5), (20_001, "unlisted", 5), (20_002, "big", 0), (20_003, "big", None)], "doc_id long, source string, n_tokens long").withColumn("rank", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.8, 1), ("small", 0.1, 3), ("none", 0.1, 2), (None, None, None)], "source string, target_share double, max_repeats int")
    drawn, plan = mixture.mixture(docs, targets, seed=7, total=20_000)
    rows = drawn.collect()
    per = {}
    for r in rows:
        per.setdefault(r.source, []).append(r)
    small = {}
    for r in per["small"]:
        small[r.doc_id] = max(small.get(r.doc_id, 0), r.copy_no)
    assert len(small) == 20 and set(small.values()) == {3}  # capped
    assert max(r.copy_no for r in per["big"]) == 1
    want = {r.source: r.wanted_tokens for r in plan.collect()}
    assert abs(sum(r.n_tokens for r in per["big"]) - want["big"]) < 40 and want["none"] == 0
    assert {(r.doc_id, r.copy_no) for r in mixture.mixture(docs, targets, seed=7, total=20_000)[0].collect()} == {(r.doc_id, r.copy_no) for r in rows}
    report = {r.source: r for r in mixture.shares(docs, targets, seed=7, total=20_000).collect()}
    assert report["none"].drawn_tokens == 0 and report["small"].most_copies == 3 and abs(sum(r.share for r in report.values()) - 1) < 1e-5
    assert mixture.mixture(docs.limit(0), targets)[0].count() == 0


def test_systematic_sampling_is_exact_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixture, "BUCKET_ROWS", 100)
    docs = spark.createDataFrame([(i, "s", 10) for i in range(1000)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("s", 1.0, 3)], "source string, target_share double, max_repeats int")
    n = mixture.mixture(docs, targets, total=17_230)[0].count()
    assert n in (1723, 1724)
    copies = {r["count"] for r in mixture.mixture(docs, targets, total=17_230)[0].groupBy("doc_id").count().collect()}
    assert copies == {1, 2}
