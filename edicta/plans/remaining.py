"""Smaller operators: page security scans, context predicates, state ladders, web sentinels, families of sites, value heads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicta.functions import rules, text, urls
from edicta.plans.registry import Tables, query
from edicta.sources import formats, sinks

SCANS = [("local_path", r"file:///|[A-Z]:\\\\"), ("blank_target", "target=.?_blank"), ("secret", "(?i)(api[_-]?key|secret|password) ?[=:]"), ("eval", r"\beval\("), ("mail", r"[\w.]+@[\w.]+\.\w+")]


@query("pred4_projection", "select record_id, titulo || ' [' || coalesce(numero, 'S/N') || ']' as label, fuente from providencia_records where titulo is not null")
def projection(t: Tables) -> DataFrame:
    return t.providencia_records.where("titulo is not null").select("record_id", F.concat("titulo", F.lit(" ["), F.coalesce("numero", F.lit("S/N")), F.lit("]")).alias("label"), "fuente")


@query("pred15_page_security", "select " + ", ".join(f"count(*) filter (regexp_matches(text, '{p}')) as {n}" for n, p in SCANS) + " from documents")
def page_security(t: Tables) -> DataFrame:
    """Hits of each scan over all texts, in one pass."""
    return t.documents.agg(*(F.count_if(F.col("text").rlike(p)).alias(n) for n, p in SCANS))


@query("pred19_context", "select id from ordenanzas where regexp_matches(strip_accents(lower(titulo)), '\\b(ordenanza|reglamento)\\b') and not regexp_matches(strip_accents(lower(titulo)), 'pagina|siguiente|anterior')")
def context(t: Tables) -> DataFrame:
    c = text.fold(F.col("titulo"))
    return t.ordenanzas.where(c.rlike(r"\b(ordenanza|reglamento)\b") & ~c.rlike("pagina|siguiente|anterior")).select("id")


@query("f11_element_text", "select lote, count(*)::varchar as total from providencia_records group by 1")
def element_text(t: Tables) -> DataFrame:
    """The text of an element by its id, read from the page it was written to."""
    page = t.providencia_records.groupBy("lote").agg(F.count(F.lit(1)).alias("n")).select("lote", sinks.replaced_element(F.lit("<div><span class='a' id='t'>?</span></div>"), "t", F.col("n").cast("string")).alias("h"))
    return page.select("lote", formats.element_text(F.col("h"), "t").alias("total"))


@query("f21_value_heads", "select record_id, coalesce(nullif(regexp_extract(trim(numero), '^([0-9]+)', 1), ''), trim(numero)) as head from providencia_records where numero is not null")
def value_heads(t: Tables) -> DataFrame:
    c = F.trim("numero")
    return t.providencia_records.where("numero is not null").select("record_id", F.coalesce(F.nullif(F.regexp_extract(c, "^([0-9]+)", 1), F.lit("")), c).alias("head"))


@query("f39_web_sentinels", "select comuna_nombre, case when web_municipal is null or lower(trim(web_municipal)) in ('', '-', 's/i', 'no', 'no tiene') then null when regexp_matches(web_municipal, '^https?://') then rtrim(web_municipal, '/') else 'http://' || rtrim(web_municipal, '/') end as web from communes_master")
def web_sentinels(t: Tables) -> DataFrame:
    """Addresses typed by hand: words for none are null, a scheme is supplied."""
    return t.communes_master.select("comuna_nombre", urls.typed_web(F.col("web_municipal")).alias("web"))


FAMILIES = [rules.Rule(1, "viewer", r"\.php"), rules.Rule(2, "uploads", "/documentos/"), rules.Rule(3, "archive", "(?i)archivos"), rules.Rule(4, "signature", "/firma/")]


@query("f40_site_families", "select case when regexp_matches(target_url, '\\.php') then 'viewer' when regexp_matches(target_url, '/documentos/') then 'uploads' when regexp_matches(target_url, '(?i)archivos') then 'archive' when regexp_matches(target_url, '/firma/') then 'signature' else 'unknown' end as family, count(*) as n from providencia_records group by 1")
def site_families(t: Tables) -> DataFrame:
    return t.providencia_records.groupBy(rules.first_label(F.col("target_url"), FAMILIES, "unknown").alias("family")).agg(F.count(F.lit(1)).alias("n"))


@query("c12_state_ladder", """
select cplt_code, case when r.n is null then 'no records' when r.v = 0 then 'unverified' when r.v < r.n then 'partly verified' when r.n < 5 then 'verified, few' else 'verified' end as state
from organisms o left join (select cplt_code as c, count(*) as n, count(*) filter (verification.status = 'verified') as v from providencia_records group by 1) r on r.c = o.cplt_code""")
def state_ladder(t: Tables) -> DataFrame:
    """Mutually exclusive states in order."""
    r = t.providencia_records.groupBy(F.col("cplt_code").alias("c")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("verification.status") == "verified").alias("v"))
    state = F.when(F.col("n").isNull(), "no records").when(F.col("v") == 0, "unverified").when(F.col("v") < F.col("n"), "partly verified").when(F.col("n") < 5, "verified, few").otherwise("verified")
    return t.organisms.join(r, F.col("c") == F.col("cplt_code"), "left").select("cplt_code", state.alias("state"))


@query("m1_windowed_counts", "select time_bucket(interval 1 hour, ts)::varchar as hour, event_type, count(*) as n from events group by 1, 2")
def windowed_counts(t: Tables) -> DataFrame:
    """The streaming plan over a table at rest."""
    from edicta.streaming.upserts import windowed_counts as counts

    return counts(t.events, "ts").select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type", "n")


@query("o2_two_key_order", "select region_id, comuna_nombre, (rank() over (partition by region_id order by comuna_nombre))::int as place from communes_master")
def two_key_order(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    return t.communes_master.select("region_id", "comuna_nombre", F.rank().over(Window.partitionBy("region_id").orderBy("comuna_nombre")).alias("place"))


@query("o5_groups_by_size", "select tabla_nombre, n from (select tabla_nombre, count(*) as n from providencia_records group by 1) order by n desc, tabla_nombre limit 10")
def groups_by_size(t: Tables) -> DataFrame:
    """A top-k report."""
    return t.providencia_records.groupBy("tabla_nombre").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tabla_nombre").limit(10)
