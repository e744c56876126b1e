"""Rule sets at work: the axes, subjects, topics and natures of acts, and the basket of topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicta.functions import rule_sets as sets
from edicta.functions import text
from edicta.plans.registry import Tables, query

_WIDE = "".join(text.FULLWIDTH), "".join(text.FULLWIDTH.values()).replace("'", "''")


def ascii_sql(c: str) -> str:
    """text.ascii_folded in SQL: full-width forms, spaces and ligatures undone by name, accents stripped, the rest left out."""
    spaces = "".join(text.SPACES)
    c = f"translate({c}, '{_WIDE[0]}{spaces}', '{_WIDE[1]}{' ' * len(spaces)}')"
    for a, b in (("№", "No"), ("…", "..."), ("ﬁ", "fi"), ("ﬂ", "fl"), ("º", "o"), ("ª", "a"), ("²", "2"), ("³", "3")):
        c = f"replace({c}, '{a}', '{b}')"
    return f"trim(lower(regexp_replace(strip_accents({c}), '[^\\x00-\\x7F]', '', 'g')))"


#: text.without_marks in SQL.
UNMARKED = "regexp_replace(lower(strip_accents({0})), '^" + text.WHITE.replace("{", "{{").replace("}", "}}") + "|" + text.WHITE.replace("{", "{{").replace("}", "}}") + "$', '', 'g')"


_CASES = " ".join(f"when materia = '{k}' then '{v}'" for k, v in sets.AXIS_OF_LABEL.items())


@query("c1_axes", f"select id, case {_CASES} else {sets.first_list_sql('lower(titulo)', sets.AXES, repr(sets.DEFAULT_AXIS), True)} end as axis from ordenanzas")
def axes(t: Tables) -> DataFrame:
    """Nine axes: by the declared subject where the table knows it, else by the title."""
    table = F.create_map(*(F.lit(x) for pair in sets.AXIS_OF_LABEL.items() for x in pair))
    return t.ordenanzas.select("id", F.coalesce(F.element_at(table, F.coalesce("materia", F.lit(""))), sets.first_list(F.lower("titulo"), sets.AXES, sets.DEFAULT_AXIS, True)).alias("axis"))


@query("c2_later_axes", f"select record_id, {sets.first_list_sql('lower(titulo)', [*sets.AXES, sets.LAST_AXIS], repr(sets.DEFAULT_AXIS), True)} as axis from providencia_records")
def later_axes(t: Tables) -> DataFrame:
    return t.providencia_records.select("record_id", sets.first_list(F.lower("titulo"), [*sets.AXES, sets.LAST_AXIS], sets.DEFAULT_AXIS, True).alias("axis"))


_WITH_URL = "lower(concat(coalesce(titulo, ''), ' ', coalesce(verification.resolved_url, '')))"


@query("c3_general_subjects", f"select record_id, {sets.first_list_sql(_WITH_URL, sets.GENERAL, repr('general'))} as subject from providencia_records")
def general_subjects(t: Tables) -> DataFrame:
    c = F.lower(F.concat(F.coalesce("titulo", F.lit("")), F.lit(" "), F.coalesce("verification.resolved_url", F.lit(""))))
    return t.providencia_records.select("record_id", sets.first_list(c, sets.GENERAL, "general").alias("subject"))


_IN_FOLDER = "lower(concat(coalesce(tabla_nombre, ''), ' ', coalesce(titulo, ''), ' ', coalesce(descripcion, '')))"
_FOLDER = "case categoria_carpeta " + " ".join(f"when '{k}' then '{v}'" for k, v in sets.FOLDER_SUBJECT.items()) + " else 'normativa_general' end"


@query("c4_folder_subjects", f"select record_id, {sets.first_list_sql(_IN_FOLDER, sets.FOLDERS, _FOLDER)} as subject from providencia_records")
def folder_subjects(t: Tables) -> DataFrame:
    """By the words of table, title and description; where none decides, by the folder."""
    c = F.lower(F.concat_ws(" ", *(F.coalesce(x, F.lit("")) for x in ("tabla_nombre", "titulo", "descripcion"))))
    table = F.create_map(*(F.lit(x) for pair in sets.FOLDER_SUBJECT.items() for x in pair))
    return t.providencia_records.select("record_id", sets.first_list(c, sets.FOLDERS, F.coalesce(F.element_at(table, F.coalesce("categoria_carpeta", F.lit(""))), F.lit("normativa_general"))).alias("subject"))


_TITLED = "lower(concat(coalesce(titulo, ''), ' ', coalesce(descripcion, '')))"


def _topics(name: str, lists: list[tuple[str, str]]):
    @query(name, f"select record_id, {sets.first_list_sql(_TITLED, lists, repr('derechos_tarifas'))} as topic from providencia_records")
    def topics(t: Tables) -> DataFrame:
        c = F.lower(F.concat_ws(" ", F.coalesce("titulo", F.lit("")), F.coalesce("descripcion", F.lit(""))))
        return t.providencia_records.select("record_id", sets.first_list(c, lists, "derechos_tarifas").alias("topic"))

    return topics


_topics("c5_topics", sets.TOPICS_A)
_topics("c6_topics", sets.TOPICS_B)
_topics("c7_topics", sets.TOPICS_C)


@query("c8_refined", f"select id, {sets.first_list_sql('lower(titulo)', sets.REFINED, repr('derechos_tarifas'))} as axis from ordenanzas where not coalesce({' or '.join(f'contains(lower(titulo), {w!r})' for w in sets.listed(sets.NOT_REFINED))}, false)")
def refined(t: Tables) -> DataFrame:
    """Titles that are forms, reviews or grants leave the catalog; the others get an axis."""
    c = F.lower("titulo")
    return t.ordenanzas.where(~F.coalesce(c.rlike(sets.pattern(sets.NOT_REFINED)), F.lit(False))).select("id", sets.first_list(c, sets.REFINED, "derechos_tarifas").alias("axis"))


def basket_acts(t: Tables) -> DataFrame:
    """(key, comuna, fecha, topics): every act of both tables with its topics of the basket."""
    o = t.ordenanzas.select(F.col("id").alias("key"), F.col("comuna_nombre").alias("comuna"), F.col("fecha_publicacion").alias("fecha"), "titulo", "materia", F.lit(None).cast("string").alias("materia_id"))
    p = t.providencia_records.select(F.col("record_id").alias("key"), "comuna", "fecha", "titulo", "materia", "materia_id")
    return o.unionAll(p).select("key", "comuna", "fecha", sets.basket(text.ascii_folded(F.col("titulo")), text.ascii_folded(F.col("materia")), F.col("materia_id")).alias("topics"))


_BOTH = f"""(select id as key, comuna_nombre as comuna, fecha_publicacion as fecha, {ascii_sql("titulo")} as t, {ascii_sql("materia")} as m, null::varchar as d from ordenanzas
 union all select record_id, comuna, fecha, {ascii_sql("titulo")}, {ascii_sql("materia")}, materia_id from providencia_records)"""
TOPICS = [b[0] for b in sets.BASKET]
#: (key, comuna, fecha, topics) in SQL.
BASKET_SQL = "(select key, comuna, fecha, list_sort(list_filter([" + ", ".join(f"case when {sets.basket_sql('t', 'm', 'd', x)} then '{x}' end" for x in TOPICS) + f"], lambda x: x is not null)) as topics from {_BOTH})"


@query("c9_basket", f"select key, array_to_string(topics, ', ') as topics from {BASKET_SQL}")
def basket(t: Tables) -> DataFrame:
    """The topics of every act of both tables."""
    return basket_acts(t).select("key", F.array_join("topics", ", ").alias("topics"))


_KEY = f"trim(regexp_replace({ascii_sql('titulo')}, '[^a-z0-9]+', ' ', 'g'))"


@query("c10_relations", f"""
select record_id, case when coalesce(k, '') = '' then 'documento_indice' when contains(k, 'reglamento') and contains(k, 'ordenanza') then 'acto_relacionado'
 when contains(k, 'ordenanza') and (regexp_matches(k, 'modifica|agrega un nuevo texto|aprueba nuevo texto|nuevo derecho ordenanza') or starts_with(k, 'decreto')) then 'modificacion'
 when starts_with(k, 'ordenanza') or starts_with(k, 'texto refundido ordenanza') then 'ordenanza' when contains(k, 'ordenanza') then 'acto_relacionado' else 'otro' end as relation from (select record_id, {_KEY} as k from providencia_records)""")
def relations(t: Tables) -> DataFrame:
    """What a title says of an act's relation to an ordinance."""
    k = F.coalesce(F.trim(F.regexp_replace(text.ascii_folded(F.col("titulo")), "[^a-z0-9]+", " ")), F.lit(""))
    ordinance = F.contains(k, F.lit("ordenanza"))
    changes = k.rlike("modifica|agrega un nuevo texto|aprueba nuevo texto|nuevo derecho ordenanza") | k.startswith("decreto")
    kind = F.when(k == "", "documento_indice").when(ordinance & F.contains(k, F.lit("reglamento")), "acto_relacionado").when(ordinance & changes, "modificacion")
    kind = kind.when(k.startswith("ordenanza") | k.startswith("texto refundido ordenanza"), "ordenanza").when(ordinance, "acto_relacionado").otherwise("otro")
    return t.providencia_records.select("record_id", kind.alias("relation"))


@query("c10_natures", f"select record_id, {sets.first_list_sql(_TITLED, sets.NATURES, repr('ordenanza_base'))} as nature, case when contains(lower(titulo), 'ordenanza') then 'Ordenanza' when contains(lower(titulo), 'reglamento') then 'Reglamento' else 'Decreto Alcaldicio' end as kind, case when regexp_matches({_TITLED}, 'modifica|reemplaza|incorpora') then 'modificacion' when contains({_TITLED}, 'ordenanza') then 'ordenanza' else 'acto_relacionado' end as preliminary from providencia_records")
def natures(t: Tables) -> DataFrame:
    """Nature by title and description, kind by title, and the first guess at a listing."""
    c, title = F.lower(F.concat_ws(" ", F.coalesce("titulo", F.lit("")), F.coalesce("descripcion", F.lit("")))), F.coalesce(F.lower("titulo"), F.lit(""))
    kind = F.when(F.contains(title, F.lit("ordenanza")), "Ordenanza").when(F.contains(title, F.lit("reglamento")), "Reglamento").otherwise("Decreto Alcaldicio")
    guess = F.when(c.rlike("modifica|reemplaza|incorpora"), "modificacion").when(F.contains(c, F.lit("ordenanza")), "ordenanza").otherwise("acto_relacionado")
    return t.providencia_records.select("record_id", sets.first_list(c, sets.NATURES, "ordenanza_base").alias("nature"), kind.alias("kind"), guess.alias("preliminary"))


@query("f6_ascii_names", f"select id, {ascii_sql('comuna_nombre')} as plain, {UNMARKED.format('comuna_nombre')} as unmarked from ordenanzas where comuna_nombre is not null")
def ascii_names(t: Tables) -> DataFrame:
    """Typed names in ASCII, and without accents only."""
    c = F.col("comuna_nombre")
    return t.ordenanzas.where(c.isNotNull()).select("id", text.ascii_folded(c).alias("plain"), text.without_marks(c).alias("unmarked"))


@query("f5_search_keys", f"select record_id, {_KEY} as k from providencia_records where titulo is not null")
def search_keys(t: Tables) -> DataFrame:
    return t.providencia_records.where("titulo is not null").select("record_id", F.trim(F.regexp_replace(text.ascii_folded(F.col("titulo")), "[^a-z0-9]+", " ")).alias("k"))
