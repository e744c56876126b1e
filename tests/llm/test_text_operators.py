"""Residue, look-alikes, scan noise, truncation, encoding: defined cases on small tables, and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from edicta.llm import encoding, lookalikes, residue, scan_noise, truncation


# -- residue (problem 1)


def residue_ids(spark, titles, source="a.example"):
    df = spark.createDataFrame([(i, t, source, "x") for i, t in enumerate(titles)], "record_id long, titulo string, text string, hash string")
    return {r.id for r in residue.residue(df, "record_id", "titulo", F.col("text")).collect()}


def test_residue_kinds(spark):
    bad = ["{{titulo}}", "Ordenanza N° ____ de fecha ____, que aprueba (materia)", "Decreto 5: regula materias de <?= $fecha ?>", "ERROR 404 - Página no encontrada | Portal de actos", "Lorem ipsum dolor sit amet", "Please enable JavaScript to continue", "[object Object]", "aaaaaaaa", "Su sesión ha expirado, vuelva a ingresar · ref. 89f77b", "Ｅｒｒｏｒ ５０３", "  NaN  "]
    good = ["Otorga beca para curso de programación en JavaScript", "Subvención al club deportivo Ipsum y Lorenzo", "Aprueba plantilla tipo de contrato a honorarios", "Ordenanza N° 5 <copia>", "Regula ferias libres {segunda parte}", "Deja sin efecto acto publicado por error, por no existir el cargo", "", "   ", None, "Aprueba ordenanza " + "sobre aseo " * 5000]
    assert residue_ids(spark, bad + good) == set(range(len(bad)))


def test_residue_repeats_and_misspellings(spark):
    rows = [(i, "Su navegador no soporta scripts o están desactivados", f"h{i % 4}") for i in range(8)] + [(8, "Su navegadr no soporta scripts o están desactivados", "h9"), (9, "Regula navegadores de scripts", "h1")]
    df = spark.createDataFrame(rows, "id long, t string, s string")
    found = [r.id for r in residue.residue(df, "id", "t", F.col("s")).collect()]
    assert sorted(found) == list(range(9))
    assert residue.residue(df.limit(0), "id", "t", F.col("s")).count() == 0
    assert residue.without_residue(df, "id", "t", F.col("s")).collect() == [(9, "Regula navegadores de scripts", "h1")]


def test_recurrence_decides_on_what_no_rule_knows(spark):
    """An unlisted message over many hosts is found, a title that recurs as often is not, nor the message where it occurs once."""
    hosts = [f"h{i}.example" for i in range(5)]
    acts = [(i, f"Regula materias de {x} y {y}", hosts[i % 5]) for i, (x, y) in enumerate([(a, b) for a in ("ferias libres", "ruidos molestos", "aseo comunal", "mascotas", "tenencia responsable") for b in ("comercio ambulante", "áreas verdes", "tránsito", "alcoholes")])]
    odd = "El contenedor remoto se cayó, avise al administrador"
    rows = acts + [(1000 + i, odd, hosts[i % 5]) for i in range(200)] + [(2000 + i, "Ferias libres y comercio ambulante", hosts[i % 5]) for i in range(200)] + [(3000 + i, "Ordenanza N° 5 de San Pedro", hosts[i % 5]) for i in range(50)]
    rows += [(4000, "El contenedor remoto se cayo, avise al administradr", "h1"), (4001, "El repositorio distante cayó", "h1"), (4002, "x", "h1")]
    df = spark.createDataFrame(rows, "id long, t string, s string")
    found = {r.id: r.kind for r in residue.residue(df, "id", "t", F.col("s")).collect()}
    assert found == {**{1000 + i: "recurring" for i in range(200)}, 4000: "misspelt"}


def test_misspelt_are_those_within_two_edits(spark):
    """Against brute force: every text within the bound of a recurring message, edits anywhere, whatever the lengths."""
    rng = random.Random(8)
    messages = ["acceso denegado", "error 0 pagina no encontrada", "ups! no encontramos lo que busca " + "por favor " * 20 + "x"]
    texts = []
    for m in messages:
        for _ in range(60):
            w = list(m)
            for _ in range(rng.randint(1, 4)):
                i = rng.randrange(len(w))
                rng.choice([lambda w=w, i=i: w.pop(i), lambda w=w, i=i: w.insert(i, "q"), lambda w=w, i=i: w.__setitem__(i, "q")])()
            texts.append("".join(w))
    known = spark.createDataFrame([(f"m{i}", m, m, 5, 3, "message") for i, m in enumerate(messages)] + [(f"t{i}", t, t, 1, 1, None) for i, t in enumerate(texts)], "hash string, text string, core string, times long, sources long, kind string")
    got = {r.hash for r in residue.with_misspelt(known).where("kind = 'misspelt'").collect()}
    near = known.where("kind is null").alias("a").crossJoin(known.where("kind = 'message'").alias("b")).where("levenshtein(a.core, b.core) <= least(2, floor(length(b.core) / 8) + 1)")
    assert got == {r.hash for r in near.select("a.hash").collect()} and len(got) > 60


def test_long_placeholders(spark):
    assert residue_ids(spark, ["{{ " + "a" * 70 + " }}", "<?= " + "b" * 500 + " ?>", "Acceso denegado | " + "portal " * 20]) == {0, 1, 2}


# -- look-alikes (problem 6)


def test_lookalikes(spark):
    base = [(i, "Ordenanza N° 5, regula la señalización y el tránsito fino", None) for i in range(100, 140)]
    odd = [
        (1, "Оrdеnanza", "a"), (2, "Ｒegula", None), (3, "señalización", ""), (4, "tránsito​", None), (5, "N° 5", None), (6, "№ 5", None), (7, "taller «Жизнь»", None),
        (8, "m² 1ª … “x” – y", None), (9, "ﬁno", "ﬁno"), (10, None, None), (11, "", ""), (12, "x" * 200_000 + " ", None), (13, "Νº 7", None), (1, "Оrdеnanza", "a"),
    ]
    df = spark.createDataFrame(base + odd, "record_id long, titulo string, descripcion string").withColumn("id", F.lit("clash")).withColumn("new", F.lit(0))
    got = lookalikes.rewrite(df, "record_id", ["titulo", "descripcion"]).collect()
    new = {(r.id, r.field): r.new for r in got}
    assert {k[0] for k in new} == {1, 2, 3, 4, 6, 9, 12, 13}
    assert new[1, "titulo"] == "Ordenanza" and new[2, "titulo"] == "Regula" and new[3, "titulo"] == "señalización" and new[6, "titulo"] == "N° 5" and new[9, "descripcion"] == "fino" and new[13, "titulo"] == "N° 7"
    assert sum(r.id == 1 for r in got) == 2  # repeated rows each come out
    assert len(new[12, "titulo"]) == 200_001
    assert lookalikes.rewrite(df.limit(0), "record_id", ["titulo", "descripcion"]).count() == 0


def test_lookalike_classes_are_transitive():
    counts = {"a": 100, "а": 3, "ａ": 2, "á": 50, "́": 4, "á": 4, " ": 80, " ": 9, "​": 5}
    c = lookalikes.Classes(counts)
    assert c.rewrites["а"] == c.rewrites["ａ"] == "a" and c.rewrites["á"] == "á" and c.rewrites[" "] == " " and c.rewrites["​"] == ""
    to = lookalikes.Rewriter(c.rewrites)
    assert to("аａá​ ") == "aaá " and to("") == "" and to("Привет а") == "Привет a"


def test_unified(spark):
    df = spark.createDataFrame([(1, "pаz", "x"), (2, "paz", None), (3, None, "a b")] + [(i, "paz a b", "") for i in range(9, 30)], "id long, t string, d string")
    rows = {r.id: r for r in lookalikes.unified(df, "id", ["t", "d"]).collect()}
    assert rows[1].t == "paz" and rows[1].changed_fields == ["t"] and rows[2].changed_fields == [] and rows[3].d == "a b" and rows[3].t is None


# -- scan noise (problem 2)

SCAN = """MUNICIPALIDAD DE PRUEBA
La Dirección de Obras llevará un registro actua-
lizado, que estará a disposición del públic0 en
la oficina de partes. El permiso tendrá una
- 1 -
MUNICIPALIDAD DE PRUEBA
vigencia de un año y se renovará síempre que se
acredite el pago de la rnulta. El incumplirniento
será sancionado por la Dirección de Obras.
- 2 -"""


def scan_frame(spark, extra=()):
    clean = "La Dirección de Obras llevará un registro actualizado que estará a disposición del público. El permiso se renovará siempre que se acredite el pago de la multa. El incumplimiento será sancionado."
    return spark.createDataFrame([(i, clean) for i in range(100, 160)] + [(1, SCAN), (2, None), (3, ""), (4, "  \n "), (5, "1\n2\n3"), *extra], "id long, texto string").withColumn("kind", F.lit("clash"))


def test_scan_noise(spark):
    got = {(r.id, r.line_no, r.kind) for r in scan_noise.noise(scan_frame(spark), "id", "texto").collect()}
    assert got == {(1, 1, "header"), (1, 6, "header"), (1, 5, "page_number"), (1, 10, "page_number"), (1, 2, "hyphen"), (1, 3, "ocr"), (1, 8, "ocr")}


def test_scan_repaired(spark):
    text = {r.id: r.text for r in scan_noise.repaired(scan_frame(spark), "id", "texto").collect()}
    assert text[1].startswith("La Dirección de Obras llevará un registro actualizado, que estará a disposición del público en la oficina de partes. El permiso tendrá una vigencia de un año")
    assert "multa. El incumplimiento será" in text[1] and "MUNICIPALIDAD" not in text[1] and "- 1 -" not in text[1]
    assert 2 not in text and text[3] == "" and text[5] == "1\n2\n3"


def test_scan_empty_and_long(spark):
    df = scan_frame(spark)
    assert scan_noise.noise(df.limit(0), "id", "texto").count() == 0
    long = "\n".join([SCAN] * 400)
    found = scan_noise.noise(scan_frame(spark, [(9, long)]), "id", "texto").where("id = 9 and kind = 'page_number'").count()
    assert found == 800


def test_one_long_line_switches_nothing_off(spark):
    rows = "TABLA " + "x y z " * 40
    want = {(1, 1, "header"), (1, 6, "header"), (1, 5, "page_number"), (1, 10, "page_number"), (1, 2, "hyphen"), (1, 3, "ocr"), (1, 8, "ocr")}
    df = scan_frame(spark, [(7, SCAN + "\n" + rows)])
    got = {(r.line_no, r.kind) for r in scan_noise.noise(df, "id", "texto").where("id = 7").collect()}
    assert {(n, k) for _, n, k in want} <= got
    assert not scan_noise.scanned([("Un texto digital en párrafos largos, " * 5).strip()] * 6 + ["una lista sin punto al final de la línea", "que sigue abajo"])


def test_many_header_like_lines_take_no_square_time():
    import time

    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("ABDEGHJKMNPQRSTVXZ") for _ in range(n))
    for lines in ([f"MUNICIPALIDAD DE PRUEBA {i}" for i in range(10_000)], [f"{word(8)} {word(9)} {word(8)}" for _ in range(5_000)], [str(1 + i // 2) if i % 2 else "texto que sigue" for i in range(20_000)]):
        began = time.time()
        mixed = [x for line in lines for x in (line, "y una línea de texto corriente que no termina aquí")]
        scan_noise.headers(mixed, scan_noise.page_numbers(mixed))
        assert time.time() - began < 30


def test_groups_are_those_of_pairwise_comparison():
    """Every line lies with a line it is alike to, against comparison of all pairs; equal lines always together."""
    rng = random.Random(6)
    base = ["municipalidad de villa alta", "boletin comunal, ano #", "direccion de obras — hoja #", "secretaria municipal de san pedro"]
    looks = {}
    for i in range(400):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice("aeioulm")
        looks[i] = "".join(w)
    groups = scan_noise.grouped(looks)
    for i in looks:
        assert i in groups[i] and all(looks[j] != looks[i] or j in groups[i] for j in looks)
        alike = [j for j in looks if j != i and scan_noise._alike(looks[i], looks[j])]
        assert not alike or len(groups[i]) > 1


def test_page_chains_are_the_longest():
    rng = random.Random(9)
    for _ in range(60):
        lines = [str(rng.randint(1, 12)) if rng.random() < 0.4 else "texto corrido" for _ in range(40)]
        alone = [(i, int(x)) for i, x in enumerate(lines) if x.isdigit() and not (i and lines[i - 1].isdigit()) and not (i + 1 < len(lines) and lines[i + 1].isdigit())]
        best = {}
        for i, n in alone:  # brute force over all predecessors
            best[i] = 1 + max((best[j] for j, m in alone if j < i and 1 <= n - m <= 4), default=0)
        longest = max(best.values(), default=0)
        if longest > 1:
            assert len(scan_noise.page_numbers(lines)) == longest


def test_confusions_are_estimated(spark):
    """Ten in a thousand m read as rn, none of u as n: the estimate follows, whatever it started from; codes are learnt."""
    good = "la multa mayor del municipio y la suma menor del monto"
    bad = good.replace("multa", "rnulta")
    rows = [(i, bad if i % 100 == 0 else good) for i in range(2000)] + [(5000 + i, f"expediente exp{i} de la suma") for i in range(50)]
    model = scan_noise.language_model(spark.createDataFrame(rows, "id long, texto string"), "texto")
    assert 0.001 < model.odds["rn", "m"] < 0.004 and model.odds["n", "u"] < 0.001  # 20 of about 12,000 m
    assert model.codes == {"exp"} and not scan_noise._odd("exp1", model.codes) and scan_noise._odd("públic0", model.codes)
    own = 20 * 20 * scan_noise.OWN / (1980 * model.odds["rn", "m"] + 20 * scan_noise.OWN)
    assert abs(model.words["rnulta"] - own) < 1e-9 and own < 10 and model.words["multa"] == 1980


def test_viterbi_is_the_best_path():
    words = {"la": 500, "multa": 60, "rnulta": 0.2, "del": 300, "público": 50, "sala": 40, "saia": 0.2}
    ch = scan_noise.Channel(scan_noise.Model(2000, words, {("la", "multa"): 50, ("del", "público"): 40}))
    assert ch.decode(["la", "rnulta"]) == ["la", "multa"] and ch.decode(["del", "públic0"]) == ["del", "público"] and ch.decode([]) == []
    rng = random.Random(1)
    for _ in range(30):  # brute force over all paths
        line = [rng.choice(["la", "rnulta", "saia", "públic0", "del", "sala"]) for _ in range(4)]
        paths = [((), 0.0)]
        for w in line:
            paths = [((*p, v), s + c + ch._likely(p[-1] if p else "", v)) for p, s in paths for v, c in ch.candidates(w)]
        assert tuple(ch.decode(line)) == max(paths, key=lambda x: x[1])[0]


# -- truncation (problem 10)


def test_truncation(spark):
    whole = "El permiso tendrá una vigencia de un año y se renovará siempre que se acredite el pago correspondiente en la tesorería comunal."
    rows = [(i, "web", whole[: 40 + i % 60].rsplit(" ", 1)[0] + " fin del asunto.") for i in range(400)]
    rows += [(1000 + i, "web", (f"{i} " + whole * 3)[:200]) for i in range(60)]
    rows += [(2000, "web", "El permiso tendrá una vig�"), (2001, "web", whole + "\nSecretario Municipal"), (2002, "web", whole + "\n\nTramo 1: 2 UTM"), (2003, None, None), (2004, "web", ""), (2005, "web", " \n"), (2006, "web", "El permiso se renovará siempre que se ac…"), (2007, None, whole)]
    rows += [(3000 + i, "web", whole + f"\nSecretario Municipal\nTramo {i}: 3 UTM") for i in range(12)] + [(4000 + i, "web", whole + "\nSecretario Municipal") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("length", F.lit("clash"))
    got = {r.id: r for r in truncation.truncated(df).collect()}
    assert {i for i in got if i < 2000} == set(range(1000, 1060)) and all(got[i].at_limit for i in range(1000, 1060))
    assert {i for i in got if i >= 2000} == {2000, 2006}
    likeliest = min(truncation.significant_lengths(df).collect(), key=lambda r: r.p)
    assert (likeliest.source, likeliest.length) == ("web", 200)
    assert truncation.truncated(df.limit(0)).count() == 0
    rates = {r.source: r for r in truncation.rates(df).collect()}
    assert rates["web"].truncated == 62 and rates[None].truncated == 0


# -- encoding (problem 8)


def test_encoding_is_the_tokenizers(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(encoding.TOKENIZER)
    t.encode_special_tokens = True
    texts = ["Artículo 5°: ¿cuánto?  dos  espacios\n\n\tfin ", "it's we'll I'd", "", None, "   ", "ñandú 🙏🏽 <|endoftext|>  x", "a" * 30_000, "x\r\ny z  ", "Ｆ① ½ 12.345,6", "Ñ" + "́" * 3, "Artículo 5°: ¿cuánto?  dos  espacios\n\n\tfin "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("ids", F.lit(2))
    got = {r.doc_id: list(r.ids) for r in encoding.encode(df).collect()}
    assert got == {i: (t.encode(x, add_special_tokens=False).ids if x else []) for i, x in enumerate(texts)}
    back = {r.doc_id: r.text for r in encoding.decode(encoding.encode(df)).collect()}
    assert back == {i: x for i, x in enumerate(texts) if x}
    counts = {r.doc_id: r.n_tokens for r in encoding.token_counts(df).collect()}
    assert counts == {i: len(x) for i, x in got.items() if x}
    assert encoding.encode(df.limit(0)).count() == 0
