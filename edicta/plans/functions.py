"""Scalar functions and predicates at work over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicta.functions import dates, rules, text, urls
from edicta.plans.registry import Tables, query

K = "trim(regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', ' ', 'g'))"
HOST = r"regexp_extract(target_url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)"


@query("f1_normalized_names", f"select cplt_code, {K.format('organism_name')} as k, replace({K.format('organism_name')}, ' ', '') as tight, coalesce(nullif(replace({K.format('organism_name')}, ' ', '_'), ''), 's_n') as slug from organisms")
def normalized_names(t: Tables) -> DataFrame:
    c = F.col("organism_name")
    return t.organisms.select("cplt_code", text.normalize_key(c).alias("k"), text.normalize_key(c, "").alias("tight"), text.slugify(c).alias("slug"))


@query("f4_collapsed", r"select record_id, length(regexp_replace(trim(regexp_replace(comuna, '[\s\x{a0}]+', ' ', 'g')), '[\x{200b}\x{ad}]', '', 'g'))::int as n from providencia_records where comuna is not null")
def collapsed(t: Tables) -> DataFrame:
    return t.providencia_records.where("comuna is not null").select("record_id", F.length(text.collapse(F.col("comuna"))).alias("n"))


@query("f12_prefix_stripped", f"select cplt_code, regexp_replace({K.format('organism_name')}, '^(ilustre )?municipalidad (de )?', '') as name from organisms")
def prefix_stripped(t: Tables) -> DataFrame:
    return t.organisms.select("cplt_code", F.regexp_replace(text.normalize_key(F.col("organism_name")), "^(ilustre )?municipalidad (de )?", "").alias("name"))


STOP = ["de", "la", "las", "los", "el", "del", "san", "santa", "villa"]


@query("f13_name_tokens", f"select comuna_nombre, string_agg(w, ' ' order by p) as tokens from (select comuna_nombre, unnest(string_split({K.format('comuna_nombre')}, ' ')) as w, generate_subscripts(string_split({K.format('comuna_nombre')}, ' '), 1) as p from communes_master) where length(w) >= 3 and w not in ({', '.join(repr(x) for x in STOP)}) group by 1")
def name_tokens(t: Tables) -> DataFrame:
    w = F.filter(F.split(text.normalize_key(F.col("comuna_nombre")), " "), lambda x: (F.length(x) >= 3) & ~x.isin(STOP))
    return t.communes_master.select("comuna_nombre", F.array_join(w, " ").alias("tokens")).where("tokens != ''")


@query("f15_dotted_counts", "select lote, replace(format('{:,}', count(*) * 1000), ',', '.') as n from providencia_records group by 1")
def dotted_counts(t: Tables) -> DataFrame:
    return t.providencia_records.groupBy("lote").agg(F.replace(F.format_number(F.count(F.lit(1)) * 1000, 0), F.lit(","), F.lit(".")).alias("n"))


@query("f17_repeated_titles", "select count(*) as halves from ordenanzas where length(titulo) % 2 = 1 and lower(left(titulo, length(titulo) // 2)) = lower(right(titulo, length(titulo) // 2)) and substring(titulo, length(titulo) // 2 + 1, 1) = ' '")
def repeated_titles(t: Tables) -> DataFrame:
    """Titles that say everything twice, by a back reference."""
    return t.ordenanzas.agg(F.count_if(F.col("titulo").rlike(r"(?i)^(.+) \1$")).alias("halves"))


@query("f18_cleaned_titles", r"select record_id, case when titulo is null or length(titulo) < 8 or length(titulo) > 300 or regexp_matches(lower(titulo), '\.pdf|descargar') then coalesce(nullif(regexp_replace(replace(regexp_extract(regexp_extract(target_url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), '%20', ' '), '\.pdf$', ''), ''), 'Sin título') else titulo end as titulo from providencia_records")
def cleaned_titles(t: Tables) -> DataFrame:
    """Titles, or the name of the file where they are none."""
    bad = F.col("titulo").isNull() | (F.length("titulo") < 8) | (F.length("titulo") > 300) | F.lower("titulo").rlike(r"\.pdf|descargar")
    name = F.coalesce(F.nullif(F.regexp_replace(urls.file_name(F.col("target_url")), r"\.pdf$", ""), F.lit("")), F.lit("Sin título"))
    return t.providencia_records.select("record_id", F.when(bad, name).otherwise(F.col("titulo")).alias("titulo"))


@query("f24_act_ids", f"select record_id, concat_ws('_', 'act', replace({K.format('categoria_carpeta')}, ' ', '_'), coalesce(nullif(trim(numero), ''), 's_n'), coalesce(fecha, 's_f')) as act_id from providencia_records where categoria_carpeta is not null")
def act_ids(t: Tables) -> DataFrame:
    p = t.providencia_records.where("categoria_carpeta is not null")
    return p.select("record_id", F.concat_ws("_", F.lit("act"), text.slugify(F.col("categoria_carpeta")), F.coalesce(F.nullif(F.trim("numero"), F.lit("")), F.lit("s_n")), F.coalesce("fecha", F.lit("s_f"))).alias("act_id"))


@query("f30_url_parts", rf"""select record_id, lower({HOST}) as host, regexp_replace(lower({HOST}), '^www\.', '') as root, coalesce(regexp_matches(target_url, '(?i)\.pdf'), false) as pdf from providencia_records where target_url not like '%:%:%'""")
def url_parts(t: Tables) -> DataFrame:
    return parts(t.providencia_records.where("target_url not like '%:%:%'"))


@query("f30_url_parts_all", rf"""select record_id, host, regexp_replace(host, '^www\.', '') as root, pdf from (select record_id, regexp_replace(lower({HOST}), ':[0-9]+$', '') as host, coalesce(regexp_matches(target_url, '(?i)\.pdf'), false) as pdf from providencia_records where target_url is not null)""")
def url_parts_all(t: Tables) -> DataFrame:
    """f30_url_parts over all addresses, also those with a port or a colon in the path."""
    return parts(t.providencia_records.where("target_url is not null"))


def parts(p: DataFrame) -> DataFrame:
    u = F.col("target_url")
    return p.select("record_id", urls.host(u).alias("host"), urls.root_host(u).alias("root"), F.coalesce(u.rlike(r"(?i)\.pdf"), F.lit(False)).alias("pdf"))


@query("f30_normalized_urls", r"""with u as (select record_id, case when regexp_matches(target_url, '^[a-zA-Z][a-zA-Z0-9+.-]*://') then target_url else 'https://' || target_url end as f from providencia_records where target_url is not null)
select record_id, lower(regexp_extract(f, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1)) || '://' || lower(regexp_extract(f, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)) || regexp_replace(regexp_extract(f, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/{2,}', '/', 'g') || case when regexp_extract(f, '\?([^#]*)', 1) <> '' then '?' || regexp_extract(f, '\?([^#]*)', 1) else '' end as url from u""")
def normalized_urls(t: Tables) -> DataFrame:
    return t.providencia_records.where("target_url is not null").select("record_id", urls.normalized_url(F.col("target_url")).alias("url"))


@query("f34_unquoted", "select record_id, url_decode(target_url) as url from providencia_records where contains(target_url, '%20')")
def unquoted(t: Tables) -> DataFrame:
    return t.providencia_records.where(F.contains("target_url", F.lit("%20"))).select("record_id", urls.unquoted(F.col("target_url")).alias("url"))


@query("f36_parameters", r"select record_id, nullif(regexp_extract(regexp_extract(target_url, '\?([^#]*)', 1), '(?:^|&)id=([^&]*)', 1), '') as id, coalesce(nullif(regexp_extract(source_listing_url, '[?&](?:page|p|m)=(\d+)', 1), ''), '1')::int as page from providencia_records where target_url is not null and source_listing_url is not null and not regexp_matches(source_listing_url, '/(page|pagina)/')")
def parameters(t: Tables) -> DataFrame:
    p = t.providencia_records.where(F.col("target_url").isNotNull() & F.col("source_listing_url").isNotNull() & ~F.col("source_listing_url").rlike("/(page|pagina)/"))
    return p.select("record_id", urls.parameter(F.col("target_url"), "id").alias("id"), urls.page_number(F.col("source_listing_url")).alias("page"))


LEGAL = r"""case when regexp_matches(fecha, '\d{4}[-/]\d{1,2}[-/]\d{1,2}') then regexp_extract(fecha, '(\d{4})[-/]', 1) || '-' || lpad(regexp_extract(fecha, '\d{4}[-/](\d{1,2})', 1), 2, '0') || '-' || lpad(regexp_extract(fecha, '\d{4}[-/]\d{1,2}[-/](\d{1,2})', 1), 2, '0')
 when regexp_matches(fecha, '\d{1,2}[-/]\d{1,2}[-/]\d{4}') then regexp_extract(fecha, '[-/](\d{4})', 1) || '-' || lpad(regexp_extract(fecha, '\d{1,2}[-/](\d{1,2})', 1), 2, '0') || '-' || lpad(regexp_extract(fecha, '(\d{1,2})[-/]', 1), 2, '0')
 when regexp_matches(fecha, '\d{4}[-/](0?[1-9]|1[0-2])(\D|$)') then regexp_extract(fecha, '(\d{4})[-/]', 1) || '-' || lpad(regexp_extract(fecha, '\d{4}[-/](\d{1,2})', 1), 2, '0')
 when try_cast(regexp_extract(fecha, '((?:19|20)\d{2})', 1) as int) between 1980 and 2026 then regexp_extract(fecha, '((?:19|20)\d{2})', 1) else 'S/F' end"""


@query("f50_legal_dates", f"select record_id, d as legal, case when d = 'S/F' then 'none' when length(d) = 10 then 'day' when length(d) = 7 then 'month' else 'year' end as precision from (select record_id, {LEGAL} as d from providencia_records)")
def legal_dates(t: Tables) -> DataFrame:
    d = dates.legal_date(F.col("fecha"))
    return t.providencia_records.select("record_id", d.alias("legal")).withColumn("precision", dates.precision(F.col("legal")))


_MONTH_CASE = "case lower(regexp_extract(texto_completo, '(?i)\\d{1,2} de (" + "|".join(dates.MONTHS) + ") del? (?:19|20)\\d{2}', 1)) " + " ".join(f"when '{m}' then '{n}'" for m, n in dates.MONTHS.items()) + " end"


@query("f51_long_dates", "select id, regexp_extract(texto_completo, '(?i)\\d{1,2} de (?:" + "|".join(dates.MONTHS) + ") del? ((?:19|20)\\d{2})', 1) || '-' || " + _MONTH_CASE + " || '-' || lpad(regexp_extract(texto_completo, '(?i)(\\d{1,2}) de (?:" + "|".join(dates.MONTHS) + ") del? (?:19|20)\\d{2}', 1), 2, '0') as stated from ordenanzas where regexp_matches(texto_completo, '(?i)\\d{1,2} de (" + "|".join(dates.MONTHS) + ") del? (?:19|20)\\d{2}')")
def long_dates(t: Tables) -> DataFrame:
    """The first date spelt out in each text."""
    return t.ordenanzas.select("id", dates.long_date(F.col("texto_completo")).alias("stated")).where("stated is not null")


@query("f52_recovered_dates", r"select record_id, case when (fecha like '%-01-01' or try_cast(regexp_extract(fecha, '((?:19|20)\d{2})', 1) as int) > 2029) and regexp_matches(target_url, '/(?:19|20)\d{2}/(0[1-9]|1[0-2])/') then regexp_extract(target_url, '/((?:19|20)\d{2})/(?:0[1-9]|1[0-2])/', 1) || '-' || regexp_extract(target_url, '/(?:19|20)\d{2}/(0[1-9]|1[0-2])/', 1) else fecha end as fecha from providencia_records")
def recovered_dates(t: Tables) -> DataFrame:
    return t.providencia_records.select("record_id", dates.recovered_date(F.col("fecha"), F.col("target_url")).alias("fecha"))


@query("f56_act_numbers", r"select record_id, coalesce(nullif(regexp_replace(regexp_replace(replace(regexp_extract(numero, '(\d{1,3}(?:\.\d{3})+|\d+)', 1), '.', ''), '^0+', ''), '^$', case when regexp_matches(numero, '\d') then '0' else '' end), ''), 'S/N') as num from providencia_records")
def act_numbers(t: Tables) -> DataFrame:
    return t.providencia_records.select("record_id", dates.act_number(F.col("numero")).alias("num"))


TITLE_RULES = [rules.Rule(1, "ruidos", "ruido|sonor"), rules.Rule(2, "residuos", "residuo|basura|recicla"), rules.Rule(3, "transito", "transito|vehicul|estacionamiento"), rules.Rule(4, "derechos", "derechos|tarifa|cobro|arancel"), rules.Rule(5, "ambiente", "humedal|arbolado|mascota|animal")]


@query("c1_first_label", "select id, case " + " ".join(f"when regexp_matches(strip_accents(lower(titulo)), '{r.pattern}') then '{r.label}'" for r in TITLE_RULES) + " else 'otros' end as label from ordenanzas")
def first_label(t: Tables) -> DataFrame:
    """A rule set as data, compiled to one CASE: the first match gives the label."""
    return t.ordenanzas.select("id", rules.first_label(text.fold(F.col("titulo")), TITLE_RULES, "otros").alias("label"))


@query("c17_intents", "select doc_id, case when regexp_matches(strip_accents(lower(text)), 'cuanto|pagar|cobr') then 'fees' when regexp_matches(strip_accents(lower(text)), 'ruido|musica') then 'noise' when contains(text, '?') then 'question' else 'other' end as intent from documents where source = 'consultas_vecinales' and text is not null")
def intents(t: Tables) -> DataFrame:
    """Residents' questions routed by the first intent that matches."""
    d = t.documents.where("source = 'consultas_vecinales' and text is not null")
    intent = [rules.Rule(1, "fees", "cuanto|pagar|cobr"), rules.Rule(2, "noise", "ruido|musica"), rules.Rule(3, "question", r"\?")]
    return d.select("doc_id", rules.first_label(text.fold(F.col("text")), intent, "other").alias("intent"))


CONTRACT = [("status", "coalesce(verification.status = 'verified', false)"), ("http", "coalesce(verification.http_status < 400, false)"), ("hash", "coalesce(length(verification.sha256) = 64, false)"), ("bytes", "coalesce(verification.bytes > 0, false)"), ("target_https", "coalesce(starts_with(target_url, 'https://'), false)"), ("listing_https", "coalesce(starts_with(source_listing_url, 'https://'), false)"), ("source", "coalesce(fuente is not null, false)")]


@query("pred7_contract", "select violation, count(*) as records from (" + " union all ".join(f"select '{n}' as violation from providencia_records where not ({p})" for n, p in CONTRACT) + ") group by 1")
def contract(t: Tables) -> DataFrame:
    """Every predicate of a row contract checked in one pass; a record counts for each it fails."""
    fails = F.array_compact(F.array(*(F.when(~F.expr(p.replace("starts_with", "startswith")), n) for n, p in CONTRACT)))
    return t.providencia_records.select(F.explode(fails).alias("violation")).groupBy("violation").agg(F.count(F.lit(1)).alias("records"))


@query("pred10_first_reason", "select coalesce(case when titulo is null then 'no title' when length(titulo) < 12 then 'short' when regexp_matches(titulo, '(?i)manual|formulario') then 'form' when regexp_matches(titulo, '(?i)copia') then 'copy' end, 'kept') as reason, count(*) as n from providencia_records group by 1")
def first_reason(t: Tables) -> DataFrame:
    """Ordered rules: the first that matches is the reason of quarantine."""
    c = F.col("titulo")
    reason = F.when(c.isNull(), "no title").when(F.length(c) < 12, "short").when(c.rlike("(?i)manual|formulario"), "form").when(c.rlike("(?i)copia"), "copy").otherwise("kept")
    return t.providencia_records.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("pred11_recency_variants", r"""select count(*) filter (regexp_matches(fecha, '^202[1-6]')) as by_prefix, count(*) filter (try_cast(nullif(regexp_extract(fecha, '((?:19|20)\d{2})', 1), '') as int) between 2021 and 2026) as by_year, count(*) filter (fecha >= '2021-01-01') as by_text from providencia_records""")
def recency_variants(t: Tables) -> DataFrame:
    """Three readings of 'recent': only the year's is sound where dates are text of any precision."""
    c = F.col("fecha")
    return t.providencia_records.agg(F.count_if(c.rlike("^202[1-6]")).alias("by_prefix"), F.count_if(dates.recent(c)).alias("by_year"), F.count_if(c >= "2021-01-01").alias("by_text"))


@query("pred12_composite_gap", """
with g as (select comuna_nombre as c, count(*) as national from ordenanzas group by 1), p as (select comuna as c, count(*) as municipal, count(*) filter (try_cast(nullif(regexp_extract(fecha, '((?:19|20)[0-9]{2})', 1), '') as int) between 2021 and 2026) as recent from providencia_records group by 1)
select g.c as comuna from g left join p on p.c = g.c where g.national >= 15 and coalesce(p.municipal, 0) <= 60 and coalesce(p.recent, 0) <= 20""")
def composite_gap(t: Tables) -> DataFrame:
    g = t.ordenanzas.groupBy(F.col("comuna_nombre").alias("comuna")).agg(F.count(F.lit(1)).alias("national"))
    p = t.providencia_records.groupBy("comuna").agg(F.count(F.lit(1)).alias("municipal"), F.count_if(dates.recent(F.col("fecha"))).alias("recent"))
    return g.join(p, "comuna", "left").where("national >= 15 and coalesce(municipal, 0) <= 60 and coalesce(recent, 0) <= 20").select("comuna")


@query("pred13_synthetic_dates", r"select record_id from providencia_records where fecha like '%-01-01' or try_cast(nullif(regexp_extract(fecha, '((?:19|20)\d{2})', 1), '') as int) > 2029")
def synthetic_dates(t: Tables) -> DataFrame:
    return t.providencia_records.where(dates.synthetic(F.col("fecha"))).select("record_id")


@query("pred14_integrity", r"""select count(*) filter (starts_with(target_url, 'http://')) as plain_http, count(*) filter (not regexp_matches(verification.sha256, '^[0-9a-f]{64}$')) as bad_hash, count(*) filter (regexp_matches(titulo, '[\w.]+@[\w.]+\.\w+')) as mail, count(*) filter (contains(target_url, ' ')) as spaces from providencia_records""")
def integrity(t: Tables) -> DataFrame:
    p = t.providencia_records
    return p.agg(F.count_if(F.startswith("target_url", F.lit("http://"))).alias("plain_http"), F.count_if(~F.col("verification.sha256").rlike("^[0-9a-f]{64}$")).alias("bad_hash"), F.count_if(F.col("titulo").rlike(r"[\w.]+@[\w.]+\.\w+")).alias("mail"), F.count_if(F.contains("target_url", F.lit(" "))).alias("spaces"))


@query("pred20_identity_gate", r"""
with x as (select p.record_id, list_filter(string_split(trim(regexp_replace(strip_accents(lower(p.comuna)), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= 4) as w, strip_accents(lower(p.titulo || ' ' || coalesce(p.descripcion, ''))) as t from providencia_records p where comuna is not null and titulo is not null)
select record_id from x where len(w) > 0 and len(list_filter(w, lambda v: not contains(t, v))) = 0""")
def identity_gate(t: Tables) -> DataFrame:
    """Records whose text names all significant words of their territory."""
    w = F.filter(F.split(text.normalize_key(F.col("comuna")), " "), lambda x: F.length(x) >= 4)
    p = t.providencia_records.where("comuna is not null and titulo is not null").select("record_id", w.alias("w"), F.translate(F.lower(F.concat_ws(" ", "titulo", F.coalesce("descripcion", F.lit("")))), "áéíóúüñ", "aeiouun").alias("t"))
    return p.where((F.size("w") > 0) & F.forall("w", lambda v: F.contains(F.col("t"), v))).select("record_id")


@query("pred21_shards", "select (record_id % 7)::int as shard, count(*) as n, sum(record_id)::bigint as checksum from providencia_records group by 1")
def shards(t: Tables) -> DataFrame:
    """Rows by shard, as a modulo of the id would send them."""
    return t.providencia_records.groupBy(F.pmod("record_id", F.lit(7)).cast("int").alias("shard")).agg(F.count(F.lit(1)).alias("n"), F.sum("record_id").alias("checksum"))


@query("pred23_portal_types", "select record_id, case when contains(target_url, '/firma/') then 'signature' when contains(target_url, 'ver.php') then 'viewer' when contains(target_url, '/documentos/') then 'folder' when contains(target_url, 'Archivos') then 'archive' else 'other' end as portal from providencia_records")
def portal_types(t: Tables) -> DataFrame:
    c = F.col("target_url")
    portal = F.when(c.contains("/firma/"), "signature").when(c.contains("ver.php"), "viewer").when(c.contains("/documentos/"), "folder").when(c.contains("Archivos"), "archive").otherwise("other")
    return t.providencia_records.select("record_id", portal.alias("portal"))


@query("pred26_https", "select record_id, regexp_replace(target_url, '^http://', 'https://') as url from providencia_records where starts_with(target_url, 'http://')")
def https(t: Tables) -> DataFrame:
    p = t.providencia_records.where(F.startswith("target_url", F.lit("http://")))
    return p.select("record_id", urls.to_https(F.col("target_url")).alias("url"))


@query("f71_hashes", "select doc_id, sha256(text) as sha, left(sha256(text), 16) as store from documents where text is not null")
def hashes(t: Tables) -> DataFrame:
    d = t.documents.where("text is not null").select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("sha"))
    return d.withColumn("store", F.substring("sha", 1, 16))


@query("f72_marker_size", "select comuna_nombre, least(round(5 + sqrt(count(*)) * 0.8, 6), 14)::double as radius from ordenanzas where comuna_nombre is not null group by 1")
def marker_size(t: Tables) -> DataFrame:
    g = t.ordenanzas.where("comuna_nombre is not null").groupBy("comuna_nombre").agg(F.count(F.lit(1)).alias("n"))
    return g.select("comuna_nombre", F.least(F.round(5 + F.sqrt("n") * 0.8, 6), F.lit(14.0)).alias("radius"))


@query("f73_json_events", "select event_type, count(*) as n, sum(coalesce(try_cast(json_extract_string(props, '$.k') as int), 0))::bigint as k from events group by 1")
def json_events(t: Tables) -> DataFrame:
    """A value taken out of JSON text and aggregated."""
    k = F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(0))
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("k"))
