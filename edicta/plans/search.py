"""Questions answered from the catalog: territory by the longest name in the text, then its latest acts; titles by subject word."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edicta.functions import text as texts
from edicta.operators import matching
from edicta.plans.classifiers import UNMARKED
from edicta.plans.registry import Tables, query

_T = r"(select doc_id, ' ' || trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) || ' ' as t from documents where source in ('consultas_vecinales', 'prensa_local', 'actas_concejo') and text is not null)"
_N = r"(select comuna_nombre, trim(regexp_replace(lower(comuna_nombre), '[^\p{L}\p{N}]+', ' ', 'g')) as k from communes_master)"
_HITS = f"(select doc_id, arg_max(comuna_nombre, (length(k), k)) as comuna from {_T} x, {_N} n where contains(x.t, ' ' || n.k || ' ') group by 1)"


def territories(t: Tables) -> DataFrame:
    """(doc_id, comuna): the territory each text names."""
    d = t.documents.where(F.col("source").isin("consultas_vecinales", "prensa_local", "actas_concejo") & F.col("text").isNotNull())
    return matching.longest_contained(d, "doc_id", "text", t.communes_master.select(F.col("comuna_nombre").alias("comuna")), "comuna")


@query("c17_named_territories", f"select comuna, count(*) as texts from {_HITS} group by 1")
def named_territories(t: Tables) -> DataFrame:
    return territories(t).groupBy("comuna").agg(F.count(F.lit(1)).alias("texts"))


@query("c17_search_latest", f"""
select h.doc_id, a.record_id, a.place from {_HITS} h join (select comuna, record_id, (row_number() over (partition by comuna order by capturado_en desc, record_id))::int as place from providencia_records where comuna is not null) a on a.comuna = h.comuna and a.place <= 4""")
def search_latest(t: Tables) -> DataFrame:
    """The four latest acts of the territory that a text names. Acts are ranked once per territory, before they meet the texts."""
    w = Window.partitionBy("comuna").orderBy(F.desc("capturado_en"), "record_id")
    top = t.providencia_records.where("comuna is not null").select("comuna", "record_id", F.row_number().over(w).alias("place")).where("place <= 4")
    return territories(t).join(top, "comuna").select("doc_id", "record_id", "place")


@query("c17_territory_profile", f"""
select h.comuna, count(p.record_id) as acts, coalesce(bool_or(p.materia_id = 'medio_ambiente'), false) as environment, coalesce(bool_or(p.materia_id = 'convivencia_ruidos'), false) as noise
from (select distinct comuna from {_HITS}) h left join providencia_records p on p.comuna = h.comuna group by 1""")
def territory_profile(t: Tables) -> DataFrame:
    """Counts and presence of subjects for the territories that texts ask about."""
    asked = territories(t).select("comuna").distinct()
    has = lambda a: F.bool_or(F.coalesce(F.col("materia_id") == a, F.lit(False)))
    per = t.providencia_records.groupBy("comuna").agg(F.count(F.lit(1)).alias("n"), has("medio_ambiente").alias("e"), has("convivencia_ruidos").alias("r"))
    out = asked.join(per, "comuna", "left")
    return out.select("comuna", F.coalesce("n", F.lit(0)).alias("acts"), F.coalesce("e", F.lit(False)).alias("environment"), F.coalesce("r", F.lit(False)).alias("noise"))


#: The routes of questions by words in them, in order; ' + ' joins words that must come together.
KNOWN = [
    ("plans", ["placma", "plan + medio ambiente", "scam"]),
    ("duties", ["obligatoria", "obligacion", "por ley", "cuales son las 6", "deben tener", "mandato legal", "mandato", "marco legal", "exigid"]),
    ("fines", ["multa", "jpl", "juzgado", "sancion", "utm"]),
]
SUBJECTS = [("wetlands", ["humedal"]), ("noise", ["ruido", "seguridad"])]


def _routed(c, rules):
    out = None
    for name, words in rules:
        hit = F.lit(False)
        for w in words:
            both = F.lit(True)
            for x in w.split(" + "):
                both &= F.contains(c, F.lit(x))
            hit |= both
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def _routed_sql(rules) -> str:
    return " ".join("when " + " or ".join("(" + " and ".join(f"contains(d.q, '{x}')" for x in w.split(" + ")) + ")" for w in words) + f" then '{name}'" for name, words in rules)


@query("c17_routes", rf"""
with d as (select doc_id, {UNMARKED.format('text')} as q, ' ' || trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' ' as t from documents where source = 'consultas_vecinales' and text is not null),
n as (select comuna_nombre, trim(regexp_replace(lower(comuna_nombre), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) as k from communes_master),
h as (select doc_id, arg_max(comuna_nombre, (length(k), k)) as comuna from d, n where contains(t, ' ' || k || ' ') group by 1),
x as (select distinct {UNMARKED.format('titulo')} as titulo from providencia_records where titulo is not null),
s as (select distinct q from d where length(q) >= 3 and exists (select 1 from x where contains(x.titulo, d.q)))
select d.doc_id, case {_routed_sql(KNOWN)} when h.comuna is not null then 'territory' {_routed_sql(SUBJECTS)} when s.q is not null then 'titles' else 'none' end as route, h.comuna from d left join h on h.doc_id = d.doc_id left join s on s.q = d.q""")
def routes(t: Tables) -> DataFrame:
    """Where each resident's question goes: what is known of plans, duties and fines, then the territory it names, then two subjects, then
    titles that hold it, then nowhere."""
    d = t.documents.where("source = 'consultas_vecinales' and text is not null").select("doc_id", "text", texts.without_marks(F.col("text")).alias("q"))
    named = matching.longest_contained(d, "doc_id", "text", t.communes_master.select(F.col("comuna_nombre").alias("comuna")), "comuna")
    titles = t.providencia_records.select(texts.without_marks(F.col("titulo")).alias("whole"))
    asked = d.join(named, "doc_id", "left").withColumn("route", F.coalesce(_routed(F.col("q"), KNOWN), F.when(F.col("comuna").isNotNull(), "territory"), _routed(F.col("q"), SUBJECTS)))
    held = matching.contained_in(asked.where("route is null"), "q", titles, "whole")
    return asked.join(held, "q", "left").select("doc_id", F.coalesce("route", F.when(F.col("whole").isNotNull(), "titles"), F.lit("none")).alias("route"), "comuna")
