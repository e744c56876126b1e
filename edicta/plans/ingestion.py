"""Ingestion: unnesting, contracts, scopes, candidates, completeness; the remaining readers and field ladders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edicta.functions import dates, rules, text, urls
from edicta.operators import dedup
from edicta.operators import matching
from edicta.plans.registry import Tables, query
from edicta.sources import formats, sinks

HOST = r"regexp_replace(lower(regexp_extract({0}, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), ':[0-9]+$', '')"


def nested(t: Tables) -> DataFrame:
    """Records as evidence arrives: one row for each listing and batch, its documents in an array."""
    p = t.providencia_records
    doc = F.struct("record_id", F.col("target_url").alias("url"), F.col("verification.status").alias("status"))
    # ids are unique, so a part holds at most a thousand documents, however large the listing
    return p.groupBy("tabla_id", "source_listing_url", F.floor(F.col("record_id") / 1000).alias("part")).agg(F.collect_list(doc).alias("documents"))


@query("pred1_unnest", "select record_id, coalesce(tabla_id, '') as tabla_id, coalesce(target_url, '') as url from providencia_records")
def unnest(t: Tables) -> DataFrame:
    rows = nested(t).select("tabla_id", F.explode_outer("documents").alias("d"))
    return rows.select("d.record_id", F.coalesce("tabla_id", F.lit("")).alias("tabla_id"), F.coalesce("d.url", F.lit("")).alias("url"))


@query("pred2_two_level_unnest", "select tabla_id, record_id, verification.status as status from providencia_records where tabla_id is not null")
def two_level_unnest(t: Tables) -> DataFrame:
    """table -> listings -> documents, unnested twice."""
    two = nested(t).where("tabla_id is not null").groupBy("tabla_id", "part").agg(F.collect_list(F.struct("source_listing_url", "documents")).alias("sources"))
    docs = two.select("tabla_id", F.explode("sources").alias("s")).select("tabla_id", F.explode("s.documents").alias("d"))
    return docs.select("tabla_id", "d.record_id", "d.status")


@query("pred3_defaults", "select record_id, coalesce(nullif(fuente, ''), 'Municipalidad') as fuente, coalesce(nullif(tipo_norma_clasif, ''), 'sin clasificar') as tipo from providencia_records")
def defaults(t: Tables) -> DataFrame:
    some = lambda c, d: F.coalesce(F.nullif(c, F.lit("")), F.lit(d))
    return t.providencia_records.select("record_id", some("fuente", "Municipalidad").alias("fuente"), some("tipo_norma_clasif", "sin clasificar").alias("tipo"))


@query("pred5_polymorphic", "select id as row_key, titulo, pdf_url as url from ordenanzas union all select record_id, titulo, target_url from providencia_records")
def polymorphic(t: Tables) -> DataFrame:
    """Flat and nested inputs brought to one schema."""
    schema = t.spark.createDataFrame([], "row_key long, titulo string, url string").schema
    a = t.ordenanzas.withColumns({"row_key": F.col("id"), "url": F.col("pdf_url")})
    b = t.providencia_records.withColumns({"row_key": F.col("record_id"), "url": F.col("target_url")})
    return formats.with_schema(a, schema).unionByName(formats.with_schema(b, schema))


@query("pred6_sources", "select record_id from providencia_records where fuente in ('Municipalidad', 'Transparencia')")
def sources(t: Tables) -> DataFrame:
    return t.providencia_records.where(F.col("fuente").isin("Municipalidad", "Transparencia")).select("record_id")


@query("pred8_required_term", r"select id from ordenanzas where contains(strip_accents(lower(titulo)), 'ordenanza') and try_cast(nullif(regexp_extract(fecha_publicacion, '((?:19|20)\d{2})', 1), '') as int) between 2010 and 2020")
def required_term(t: Tables) -> DataFrame:
    o = t.ordenanzas
    return o.where(F.contains(text.fold(F.col("titulo")), F.lit("ordenanza")) & dates.recent(F.col("fecha_publicacion"), 2010, 2020)).select("id")


@query("pred9_keywords", "select id from ordenanzas where regexp_matches(strip_accents(lower(titulo)), 'ruido|residuo|transito') and not regexp_matches(strip_accents(lower(titulo)), 'escolar|playa')")
def keywords(t: Tables) -> DataFrame:
    c = text.fold(F.col("titulo"))
    return t.ordenanzas.where(c.rlike("ruido|residuo|transito") & ~c.rlike("escolar|playa")).select("id")


@query("pred16_scope", rf"""select record_id, {HOST.format('target_url')} = {HOST.format('source_listing_url')} as same_host, coalesce(regexp_matches(target_url, '/documentos/|/firma/'), false) as in_family from providencia_records where target_url is not null and source_listing_url is not null""")
def scope(t: Tables) -> DataFrame:
    """Whether a link stays within its source."""
    p = t.providencia_records.where("target_url is not null and source_listing_url is not null")
    return p.select("record_id", (urls.host(F.col("target_url")) == urls.host(F.col("source_listing_url"))).alias("same_host"), F.col("target_url").rlike("/documentos/|/firma/").alias("in_family"))


@query("pred17_sites", r"""with x as (select distinct regexp_replace(regexp_replace(lower(regexp_extract(target_url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), ':[0-9]+$', ''), '^www\.', '') as h from providencia_records where target_url is not null),
m as (select regexp_replace(lower(regexp_extract(web_municipal, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '') as h from communes_master where web_municipal is not null)
select count(*) as hosts, count(*) filter (h in (select h from m)) as official from x""")
def sites(t: Tables) -> DataFrame:
    x = t.providencia_records.where("target_url is not null").select(urls.root_host(F.col("target_url")).alias("h")).distinct()
    m = t.communes_master.where("web_municipal is not null").select(urls.root_host(F.col("web_municipal")).alias("h")).distinct().withColumn("o", F.lit(True))
    return x.join(m, "h", "left").agg(F.count(F.lit(1)).alias("hosts"), F.count_if(F.coalesce("o", F.lit(False))).alias("official"))


@query("pred18_documents", r"select record_id from providencia_records where regexp_matches(lower(regexp_extract(target_url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)), '\.pdf$|/(firma|ver|bajar)') or regexp_matches(lower(regexp_extract(target_url, '^[^#]*?\?([^#]*)', 1)), '\.pdf|(^|&)(doc|file|pdf|documento)=')")
def documents(t: Tables) -> DataFrame:
    return t.providencia_records.where(urls.pdf_like(F.col("target_url"))).select("record_id")


@query("pred22_allow_list", "select record_id from providencia_records where cplt_code in (select cplt_code from organisms where ta_status = 'activo')")
def allow_list(t: Tables) -> DataFrame:
    return t.providencia_records.join(matching.sized(t.organisms.where("ta_status = 'activo'").select("cplt_code")), "cplt_code", "left_semi").select("record_id")


@query("pred24_year_candidates", r"select record_id from providencia_records where regexp_matches(target_url, '/20(19|2[0-4])/') and regexp_matches(lower(tipo_acto), 'ordenanza|reglamento')")
def year_candidates(t: Tables) -> DataFrame:
    return t.providencia_records.where(F.col("target_url").rlike("/20(19|2[0-4])/") & F.lower("tipo_acto").rlike("ordenanza|reglamento")).select("record_id")


@query("pred25_key_guard", r"select count(*) filter (numero is not null and not regexp_matches(numero, '(?i)^\s*(s/?n)?\s*$') and regexp_matches(fecha, '^\d{4}-\d{2}-\d{2}$')) as keyed, count(*) as all_ from providencia_records")
def key_guard(t: Tables) -> DataFrame:
    ok = F.col("numero").isNotNull() & ~F.col("numero").rlike(r"(?i)^\s*(s/?n)?\s*$") & (dates.precision(F.col("fecha")) == "day")
    return t.providencia_records.agg(F.count_if(ok).alias("keyed"), F.count(F.lit(1)).alias("all_"))


@query("s3_missing_is_empty", "select 0::bigint as n")
def missing_is_empty(t: Tables) -> DataFrame:
    """A table that is not there reads as an empty one of the given schema."""
    return formats.read_default(t.spark, f"{t._path}/not_there.json", "a string").agg(F.count(F.lit(1)).alias("n"))


@query("s16_flat_fallback", "select cplt_code, organism_name from organisms")
def flat_fallback(t: Tables) -> DataFrame:
    """Codes and what follows them in a page whose markup is broken, by pattern alone."""
    html = t.organisms.select(F.concat(F.lit("<li>"), "cplt_code", F.lit("</b> : "), "organism_name", F.lit(" <br")).alias("h"))
    return html.select(F.regexp_extract("h", r"(?<![A-Z])(MZ\d+)(?!\d)", 1).alias("cplt_code"), F.regexp_extract("h", r"MZ\d+</b> : (.*?) <", 1).alias("organism_name"))


@query("s17_directory_merge", "select cplt_code, coalesce(sai_link, directory_url, '-') as link from organisms")
def directory_merge(t: Tables) -> DataFrame:
    """A primary listing filled up from a fallback by key."""
    a = t.organisms.where("sai_link is not null").select("cplt_code", F.col("sai_link").alias("link"))
    b = t.organisms.select("cplt_code", F.coalesce("directory_url", F.lit("-")).alias("link"))
    return a.unionByName(b.join(a, "cplt_code", "left_anti"))


@query("s19_frames", "select norma_uri as src, count(*) as n from ordenanzas where norma_uri is not null group by 1")
def frames(t: Tables) -> DataFrame:
    html = t.ordenanzas.where("norma_uri is not null").select(F.concat(F.lit('<div><IFRAME width="9" src="'), "norma_uri", F.lit('"></IFRAME></div>')).alias("h"))
    return html.select(F.explode(formats.frames(F.col("h"))).alias("src")).groupBy("src").agg(F.count(F.lit(1)).alias("n"))


@query("s24_label_values", "select cplt_code, coalesce(sai_link, '') as web from organisms")
def label_values(t: Tables) -> DataFrame:
    """A value beside its label, by ladders over the page's text."""
    page = t.organisms.select("cplt_code", F.concat(F.lit("<p>Código</p><td>Sitio&nbsp;web</td><td>"), F.coalesce("sai_link", F.lit("")), F.lit("</td>")).alias("h"))
    plain = formats.strip_tags(F.col("h"))
    return page.select("cplt_code", F.coalesce(F.nullif(F.regexp_extract(plain, r"Sitio web:? (https?://\S+)", 1), F.lit("")), F.lit("")).alias("web"))


@query("s25_columns_by_position", "select record_id, case when tabla_id in ('101', '104') then numero else fecha end as second from providencia_records where tabla_id is not null")
def columns_by_position(t: Tables) -> DataFrame:
    """Cells named by position, the positions depending on the table."""
    cells = F.array(F.col("record_id").cast("string"), "numero", "fecha")
    p = t.providencia_records.where("tabla_id is not null").select("tabla_id", cells.alias("c"))
    return p.select(F.col("c")[0].cast("long").alias("record_id"), F.when(F.col("tabla_id").isin("101", "104"), F.col("c")[1]).otherwise(F.col("c")[2]).alias("second"))


@query("s29_verified_status", "select case when verification.bytes is null then 'empty' when verification.bytes > 4000000 then 'too_large' when verification.content_type <> 'application/pdf' or verification.content_type is null then 'not_pdf' else 'ok' end as outcome, count(*) as n from providencia_records group by 1")
def verified_status(t: Tables) -> DataFrame:
    v = t.providencia_records.select("verification.*")
    out = F.when(F.col("bytes").isNull(), "empty").when(F.col("bytes") > 4_000_000, "too_large").when((F.col("content_type") != "application/pdf") | F.col("content_type").isNull(), "not_pdf").otherwise("ok")
    return v.groupBy(out.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("s30_first_success", "select id, coalesce(pdf_url, rdf_json_url, rdf_xml_url, norma_uri) as url, case when pdf_url is not null then 1 when rdf_json_url is not null then 2 when rdf_xml_url is not null then 3 else 4 end as choice from ordenanzas")
def first_success(t: Tables) -> DataFrame:
    """The first address of a list that is there, and which it was."""
    names = ["pdf_url", "rdf_json_url", "rdf_xml_url", "norma_uri"]
    tries = F.filter(F.array(*(F.struct(F.col(n).alias("u"), F.lit(i + 1).alias("i")) for i, n in enumerate(names))), lambda x: x["u"].isNotNull() | (x["i"] == 4))
    return t.ordenanzas.select("id", tries[0]["u"].alias("url"), tries[0]["i"].alias("choice"))


@query("s34_cached_results", "select p.record_id, coalesce(c.status, 'new') as status from providencia_records p left join (select target_url, min(verification.status) as status from providencia_records where lote = 1 group by 1) c on c.target_url = p.target_url where p.lote > 1")
def cached_results(t: Tables) -> DataFrame:
    """Verifications of an earlier run taken over by address."""
    c = t.providencia_records.where("lote = 1 and target_url is not null").groupBy("target_url").agg(F.min("verification.status").alias("s"))
    p = t.providencia_records.where("lote > 1").select("record_id", "target_url")
    return p.join(c, "target_url", "left").select("record_id", F.coalesce("s", F.lit("new")).alias("status"))


@query("f9_cleaned_text", "select doc_id, length(trim(regexp_replace(replace(replace(text, '&amp;', '&'), '&nbsp;', ' '), '[ \\t\\n\\r]+', ' ', 'g')))::int as n from documents where text is not null and not regexp_matches(text, '[\\x{80}-\\x{ff}][\\x{0085}\\x{00a0}]|[\\x{0b}\\x{0c}\\x{85}\\x{a0}\\x{2000}-\\x{206f}\\x{3000}\\x{feff}]')")
def cleaned_text(t: Tables) -> DataFrame:
    plain = t.documents.where(F.col("text").isNotNull() & ~F.col("text").rlike(r"[\x{0b}\x{0c}\x{85}\x{a0}\x{2000}-\x{206f}\x{3000}\x{feff}]"))
    c = F.replace(F.replace(F.col("text"), F.lit("&amp;"), F.lit("&")), F.lit("&nbsp;"), F.lit(" "))
    return plain.select("doc_id", F.length(F.trim(F.regexp_replace(c, r"[ \t\n\r]+", " "))).alias("n"))


@query("f14_slug_names", "select id, array_to_string(list_transform(string_split(replace(regexp_replace(municipalidad_slug, '^municipalidad-de-', ''), '-', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') as name from ordenanzas where regexp_matches(municipalidad_slug, '^[a-z-]+$')")
def slug_names(t: Tables) -> DataFrame:
    return named(t.ordenanzas.where(F.col("municipalidad_slug").rlike("^[a-z-]+$")))


def named(o: DataFrame) -> DataFrame:
    return o.select("id", F.initcap(F.replace(F.regexp_replace("municipalidad_slug", "^municipalidad-de-", ""), F.lit("-"), F.lit(" "))).alias("name"))


@query("f14_slug_names_all", "select id, array_to_string(list_transform(string_split(replace(regexp_replace(municipalidad_slug, '^municipalidad-de-', ''), '-', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') as name from ordenanzas where municipalidad_slug is not null")
def slug_names_all(t: Tables) -> DataFrame:
    """f14_slug_names over slugs of any characters."""
    return named(t.ordenanzas.where("municipalidad_slug is not null"))


@query("f16_padded_ids", "select distinct region_id, case when regexp_matches(region_id, '^[0-9]+$') then lpad(region_id, greatest(2, length(region_id))::int, '0') else region_id end as padded from providencia_records where region_id is not null")
def padded_ids(t: Tables) -> DataFrame:
    c = F.col("region_id")
    return t.providencia_records.where("region_id is not null").select(c, F.when(c.rlike("^[0-9]+$") & (F.length(c) < 2), F.lpad(c, 2, "0")).otherwise(c).alias("padded")).distinct()


@query("f20_escaped", "select record_id, replace(replace(replace(replace(titulo, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') as html from providencia_records where titulo is not null")
def escaped(t: Tables) -> DataFrame:
    c = F.col("titulo")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return t.providencia_records.where("titulo is not null").select("record_id", c.alias("html"))


@query("f22_candidate_sites", "select comuna_nombre, unnest(['https://www.' || s || '.example', 'https://' || s || '.example', 'https://transparencia.' || s || '.example']) as site from (select comuna_nombre, replace(trim(regexp_replace(strip_accents(lower(comuna_nombre)), '[^a-z0-9]+', ' ', 'g')), ' ', '-') as s from communes_master)")
def candidate_sites(t: Tables) -> DataFrame:
    s = text.normalize_key(F.col("comuna_nombre"), "-")
    sites_ = F.array(*(F.concat(F.lit(p), s, F.lit(".example")) for p in ("https://www.", "https://", "https://transparencia.")))
    return t.communes_master.select("comuna_nombre", F.explode(sites_).alias("site"))


@query("f23_markdown_to_html", r"select doc_id, count(*)::int as links from (select doc_id, unnest(regexp_extract_all(text, 'https?://[^\s]+')) from documents) group by 1")
def markdown_links(t: Tables) -> DataFrame:
    """Links of a text counted by pattern."""
    n = F.size(F.regexp_extract_all("text", F.lit(r"(https?://[^\s]+)"), F.lit(1)))
    return t.documents.where("text is not null").select("doc_id", n.alias("links")).where("links > 0")


@query("f41_codes_in_text", r"select directory_url, count(*) as n from organisms where regexp_matches(sai_link, 'MZ[0-9]+$') group by 1")
def codes_in_text(t: Tables) -> DataFrame:
    """Codes found with look-around: not inside longer ones."""
    code = F.regexp_extract("sai_link", r"(?<![A-Z0-9])MZ\d+(?!\d)", 0)
    return t.organisms.where(code != "").groupBy("directory_url").agg(F.count(F.lit(1)).alias("n"))


@query("f53_date_fallbacks", r"""select record_id, coalesce(nullif(regexp_extract(fecha, '^(\d{4}-\d{2}-\d{2})$', 1), ''), case when regexp_matches(fecha_publicidad, '^\d{2}/\d{2}/\d{4}$') then right(fecha_publicidad, 4) || '-' || substring(fecha_publicidad, 4, 2) || '-' || left(fecha_publicidad, 2) end, nullif(regexp_extract(target_url, '/((?:19|20)\d{2})/', 1), ''), 'S/F') as best from providencia_records""")
def date_fallbacks(t: Tables) -> DataFrame:
    """A full date, else the publication's, else the year of the address."""
    full = F.nullif(F.regexp_extract("fecha", r"^(\d{4}-\d{2}-\d{2})$", 1), F.lit(""))
    pub = F.when(F.col("fecha_publicidad").rlike(r"^\d{2}/\d{2}/\d{4}$"), dates.legal_date(F.col("fecha_publicidad")))
    return t.providencia_records.select("record_id", F.coalesce(full, pub, F.nullif(F.regexp_extract("target_url", r"/((?:19|20)\d{2})/", 1), F.lit("")), F.lit(dates.NO_DATE)).alias("best"))


@query("f54_first_and_last_year", r"select record_id, nullif(regexp_extract(titulo || ' ' || coalesce(descripcion, ''), '((?:19|20)\d{2})', 1), '') as first, nullif(list_extract(regexp_extract_all(titulo || ' ' || coalesce(descripcion, ''), '(?:19|20)\d{2}'), -1), '') as last from providencia_records where titulo is not null")
def first_and_last_year(t: Tables) -> DataFrame:
    c = F.concat_ws(" ", "titulo", F.coalesce("descripcion", F.lit("")))
    years = F.regexp_extract_all(c, F.lit(r"((?:19|20)\d{2})"), F.lit(1))
    return t.providencia_records.where("titulo is not null").select("record_id", F.try_element_at(years, F.lit(1)).alias("first"), F.try_element_at(years, F.lit(-1)).alias("last"))


@query("f57_repaired_numbers", r"select record_id, case when regexp_matches(numero, '^\s*(19|20)\d{2}\s*$') then 'S/N' else trim(regexp_replace(numero, '[-/](19|20)\d{2}$', '')) end as num from providencia_records where numero is not null")
def repaired_numbers(t: Tables) -> DataFrame:
    """Years that stand for a number are none; a year behind a number is taken off."""
    c = F.col("numero")
    return t.providencia_records.where("numero is not null").select("record_id", F.when(c.rlike(r"^\s*(19|20)\d{2}\s*$"), "S/N").otherwise(F.trim(F.regexp_replace(c, r"[-/](19|20)\d{2}$", ""))).alias("num"))


@query("f58_overrides", "select id, case when contains(titulo, 'ruidos molestos') then 'R-1' when contains(titulo, 'humedales') then 'H-1' else coalesce(numero, 'S/N') end as num from ordenanzas")
def overrides(t: Tables) -> DataFrame:
    """Corrections by substring of the title, kept as data."""
    rule = [rules.Rule(1, "R-1", "ruidos molestos"), rules.Rule(2, "H-1", "humedales")]
    return t.ordenanzas.select("id", F.coalesce(rules.first_label(F.col("titulo"), rule), "numero", F.lit("S/N")).alias("num"))


@query("c10_act_kinds", "select record_id, case when regexp_matches(strip_accents(lower(titulo)), 'deroga') then 'repeals' when regexp_matches(strip_accents(lower(titulo)), 'modifica|rectifica|reemplaza') then 'amends' when regexp_matches(strip_accents(lower(titulo)), 'refundido') then 'restates' else 'issues' end as kind from providencia_records where titulo is not null and not regexp_matches(titulo, '[^\\x{20}-\\x{17f}]')")
def act_kinds(t: Tables) -> DataFrame:
    return kinds(t.providencia_records.where(F.col("titulo").isNotNull() & ~F.col("titulo").rlike(r"[^\x{20}-\x{17f}]")))


def kinds(p: DataFrame) -> DataFrame:
    rule = [rules.Rule(1, "repeals", "deroga"), rules.Rule(2, "amends", "modifica|rectifica|reemplaza"), rules.Rule(3, "restates", "refundido")]
    return p.select("record_id", rules.first_label(text.fold(F.col("titulo")), rule, "issues").alias("kind"))


@query("c13_outcomes", "select verification.http_status as http, case when verification.http_status is null then 'none' when verification.http_status < 300 then 'ok' when verification.http_status < 400 then 'moved' when verification.http_status in (401, 403) then 'blocked' when verification.http_status = 404 then 'gone' else 'failed' end as state, count(*) as n from providencia_records group by 1, 2")
def outcomes(t: Tables) -> DataFrame:
    h = F.col("verification.http_status")
    state = F.when(h.isNull(), "none").when(h < 300, "ok").when(h < 400, "moved").when(h.isin(401, 403), "blocked").when(h == 404, "gone").otherwise("failed")
    return t.providencia_records.groupBy(h.alias("http"), state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("c15_catalog_labels", "select record_id, (case when verification.status = 'verified' then 'Verificado' else 'Pendiente' end) || ' · ' || coalesce(nullif(fuente, ''), 'sin fuente') as label from providencia_records")
def catalog_labels(t: Tables) -> DataFrame:
    v = F.when(F.col("verification.status") == "verified", "Verificado").otherwise("Pendiente")
    return t.providencia_records.select("record_id", F.concat(v, F.lit(" · "), F.coalesce(F.nullif("fuente", F.lit("")), F.lit("sin fuente"))).alias("label"))


@query("m2_idempotent_shards", "select distinct lote from providencia_records where lote not in (select lote from providencia_records group by 1 having count(*) filter (verification.status = 'verified') * 10 >= count(*) * 9)")
def idempotent_shards(t: Tables) -> DataFrame:
    """Shards whose output is not valid enough are to be run again; the others are kept."""
    g = t.providencia_records.groupBy("lote").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("verification.status") == "verified").alias("v"))
    return g.where("not (v * 10 >= n * 9)").select("lote")


@query("m6_pagination", r"with m as (select tabla_id, max(coalesce(nullif(regexp_extract(source_listing_url, '[?&](?:page|p|m)=(\d+)', 1), ''), '1')::int) as pages from providencia_records where tabla_id is not null and source_listing_url is not null group by 1) select tabla_id, unnest(range(1, pages + 1))::int as page from m")
def pagination(t: Tables) -> DataFrame:
    """Every page of a listing up to the last one mentioned."""
    p = t.providencia_records.where("tabla_id is not null and source_listing_url is not null").groupBy("tabla_id").agg(F.max(urls.page_number(F.col("source_listing_url"))).alias("pages")).where("pages >= 1")
    return p.select("tabla_id", F.explode(F.sequence(F.lit(1), F.col("pages"))).alias("page"))


@query("m7_fail_closed", "select lote, count(*) filter (verification.status = 'verified') = count(*) and count(*) filter (verification.sha256 is null) = 0 and count(distinct record_id) = count(*) as complete from providencia_records group by 1")
def fail_closed(t: Tables) -> DataFrame:
    """Complete only if every gate holds; what is unknown fails."""
    v = F.col("verification")
    g = t.providencia_records.groupBy("lote").agg(F.bool_and(F.coalesce(v["status"] == "verified", F.lit(False))).alias("a"), F.bool_and(v["sha256"].isNotNull()).alias("b"), F.count_distinct("record_id").alias("d"), F.count(F.lit(1)).alias("n"))
    return g.select("lote", (F.col("a") & F.col("b") & (F.col("d") == F.col("n"))).alias("complete"))


@query("k2_js_assignment_file", "select 'window.TOTAL = {\"acts\":' || count(*)::varchar || '};' as js from providencia_records")
def js_file(t: Tables) -> DataFrame:
    return t.providencia_records.agg(F.count(F.lit(1)).alias("acts")).select(sinks.assigned_js(F.to_json(F.struct("acts")), "TOTAL").alias("js"))


@query("k4_sorted_summary", "select row_number() over (order by region_id, comuna_nombre)::int as line, region_id, comuna_nombre from communes_master")
def sorted_summary(t: Tables) -> DataFrame:
    """A summary in its printed order; the master list is one small table."""
    return t.communes_master.select(F.row_number().over(Window.orderBy("region_id", "comuna_nombre")).alias("line"), "region_id", "comuna_nombre")


@query("k8_paths", "select doc_id, coalesce(nullif(replace(trim(regexp_replace(strip_accents(lower(comuna)), '[^a-z0-9]+', ' ', 'g')), ' ', '_'), ''), 's_n') || '/' || coalesce(nullif(fecha, ''), 's_f') || '_' || doc_id::varchar || '.md' as path from documents")
def paths(t: Tables) -> DataFrame:
    """Where each document's file goes: folders by place."""
    return t.documents.select("doc_id", F.concat(text.slugify(F.col("comuna")), F.lit("/"), F.coalesce(F.nullif("fecha", F.lit("")), F.lit("s_f")), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"))


@query("k16_manifest_text", "select 'ordenanzas: ' || (select count(*) from ordenanzas)::varchar || chr(10) || 'providencia_records: ' || (select count(*) from providencia_records)::varchar as manifest")
def manifest_text(t: Tables) -> DataFrame:
    a = t.ordenanzas.agg(F.lit("ordenanzas").alias("name"), F.count(F.lit(1)).alias("n"))
    b = t.providencia_records.agg(F.lit("providencia_records").alias("name"), F.count(F.lit(1)).alias("n"))
    line = F.concat("name", F.lit(": "), F.col("n").cast("string"))
    return a.unionByName(b).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("manifest"))


@query("w12_latest_per_key_kept", "select count(*) as rows, count(distinct norma_uri) as keys from ordenanzas")
def latest_per_key(t: Tables) -> DataFrame:
    """An upsert of a log into nothing keeps one row a key; of itself into itself, nothing changes."""
    o = t.ordenanzas.select("norma_uri", "id", "creado_en")
    kept = dedup.upsert(o.limit(0), o, ["norma_uri"], "creado_en")
    stacked = o.select(F.lit(1).alias("row"), F.lit(0).alias("key")).unionAll(kept.select(F.lit(0), F.lit(1)))
    return stacked.agg(F.sum("row").alias("rows"), F.sum("key").alias("keys"))
