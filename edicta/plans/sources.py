"""Formats at work: each query writes rows in a format and reads them back, so that the tables themselves are the check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicta.plans.registry import Tables, query
from edicta.sources import formats, sinks

RECORD = "struct<record_id: bigint, titulo: string>"


@query("s1_csv_round_trip", "select comuna_nombre, region_id, web_municipal from communes_master")
def csv_round_trip(t: Tables) -> DataFrame:
    """A dictionary written as CSV lines and parsed by from_csv."""
    m = t.communes_master.select(F.to_csv(F.struct("comuna_nombre", "region_id", "web_municipal")).alias("line"))
    return m.select(F.from_csv("line", "comuna_nombre string, region_id string, web_municipal string").alias("r")).select("r.*")


@query("s2_json_envelopes", "select record_id, titulo from providencia_records where lote <= 12 and tabla_id is not null")
def json_envelopes(t: Tables) -> DataFrame:
    """Envelopes of records by page of a listing, their declared count asserted, unnested again."""
    p = t.providencia_records.where("tabla_id is not null")
    packs = p.groupBy("source_listing_url", "lote", F.floor(F.col("record_id") / 1000)).agg(F.to_json(F.struct(F.count(F.lit(1)).alias("count"), F.collect_list(F.struct("record_id", "titulo")).alias("records"))).alias("j"))
    return formats.checked_records(packs.select(formats.envelopes(F.col("j"), RECORD).alias("e")), "e").select("record_id", "titulo")


@query("s4_js_assignment", "select cplt_code, organism_name from organisms")
def js_assignment(t: Tables) -> DataFrame:
    js = t.organisms.select(sinks.assigned_js(F.to_json(F.struct("cplt_code", "organism_name")), "DATA").alias("js"))
    return js.select(F.from_json(formats.unwrapped_js(F.col("js")), "cplt_code string, organism_name string").alias("r")).select("r.*")


@query("s7_sparql_bindings", "select norma_uri as uri, coalesce(numero, '') as num from ordenanzas")
def sparql_bindings(t: Tables) -> DataFrame:
    """Query results as endpoints give them, unwrapped."""
    val = lambda c: F.struct(F.coalesce(F.col(c), F.lit("")).alias("value"))
    j = t.ordenanzas.select(F.to_json(F.struct(F.struct(F.array(F.struct(val("norma_uri").alias("uri"), val("numero").alias("num"))).alias("bindings")).alias("results"))).alias("j"))
    return j.select(F.explode(formats.bindings(F.col("j"), ["uri", "num"])).alias("b")).select("b.*")


@query("s9_front_matter", "select doc_id, coalesce(comuna, '') as comuna, coalesce(materia_id, '') as materia_id, coalesce(fecha, '') as fecha from documents where text is not null")
def front_matter(t: Tables) -> DataFrame:
    """Documents written with a head and read back from their text alone."""
    d = t.documents.where("text is not null")
    md = d.select(sinks.markdown({"id": F.col("doc_id"), "comuna": F.col("comuna"), "materia": F.col("materia_id"), "fecha": F.col("fecha")}, F.col("text")).alias("md"))
    meta = formats.front_matter(F.col("md"))
    return md.select(meta.alias("m")).select(F.col("m")["id"].cast("long").alias("doc_id"), F.col("m")["comuna"].alias("comuna"), F.col("m")["materia"].alias("materia_id"), F.col("m")["fecha"].alias("fecha"))


@query("s9_bodies", "select doc_id, length(ltrim(text, chr(10)))::int as n from documents where text is not null")
def bodies(t: Tables) -> DataFrame:
    d = t.documents.where("text is not null")
    md = d.select("doc_id", sinks.markdown({"id": F.col("doc_id")}, F.col("text")).alias("md"))
    return md.select("doc_id", F.length(formats.body(F.col("md"))).alias("n"))


@query("s15_html_tables", "select cplt_code, trim(regexp_replace(organism_name, '\\s+', ' ', 'g')) as organism_name, ta_link from organisms")
def html_tables(t: Tables) -> DataFrame:
    """Directory rows as an HTML table with unclosed cells, parsed by the tolerant parser."""
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    link = F.when(F.col("ta_link").isNull(), F.lit("-")).otherwise(F.concat(F.lit('<a href="'), F.col("ta_link"), F.lit('">TA</a>')))
    html = t.organisms.select(F.concat(F.lit("<table><tr><td>"), "cplt_code", F.lit("<td><b>"), esc(F.col("organism_name")), F.lit("</b></td><td>"), link, F.lit("</table>")).alias("h"))
    rows = html.select(F.explode(formats.table_rows(F.col("h"))).alias("r"))
    return rows.select(F.col("r")[0]["text"].alias("cplt_code"), F.col("r")[1]["text"].alias("organism_name"), F.col("r")[2]["href"].alias("ta_link"))


@query("s18_anchors", "select record_id, target_url as href, trim(regexp_replace(replace(replace(numero, '<', ''), '>', ''), '\\s+', ' ', 'g')) as text from providencia_records where target_url is not null and numero is not null and not contains(target_url, '\"') and not contains(target_url, '''')")
def anchors(t: Tables) -> DataFrame:
    p = t.providencia_records.where(F.col("target_url").isNotNull() & F.col("numero").isNotNull() & ~F.col("target_url").rlike("[\"']"))
    html = p.select("record_id", F.concat(F.lit('<p>Ver <A class="x" href="'), "target_url", F.lit('"><i>'), "numero", F.lit("</i></A></p>")).alias("h"))
    return html.select("record_id", F.explode(formats.anchors(F.col("h"))).alias("a")).select("record_id", "a.href", "a.text")


@query("s20_sitemap", "select norma_uri as loc, count(*) as n from ordenanzas group by 1")
def sitemap(t: Tables) -> DataFrame:
    xml = t.ordenanzas.select(F.concat(F.lit("<urlset><url><loc>"), F.replace("norma_uri", F.lit("&"), F.lit("&amp;")), F.lit("</loc></url></urlset>")).alias("x"))
    return xml.select(F.explode(formats.sitemap(F.col("x"))).alias("loc")).groupBy("loc").agg(F.count(F.lit(1)).alias("n"))


@query("s23_options", "select cplt_code as code, organism_name as name from organisms")
def options(t: Tables) -> DataFrame:
    html = t.organisms.select(F.concat(F.lit("<select><option value='"), "cplt_code", F.lit("'> "), "organism_name", F.lit(" </option></select>")).alias("h"))
    return html.select(F.explode(formats.options(F.col("h"))).alias("o")).select("o.*")


@query("s31_urls_in_text", r'''select url, count(*) as docs from (select distinct doc_id, regexp_replace(unnest(regexp_extract_all(text, 'https?://[^\s"''<>\]\)}\\]+')), '[.,;]+$', '') as url from documents) group by 1''')
def urls_in_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.explode(formats.urls_in(F.col("text"))).alias("url")).groupBy("url").agg(F.count(F.lit(1)).alias("docs"))


@query("k9_manifest", "select source, count(*) as documents, sum(coalesce(n_chars, 0))::bigint as chars, count(*) filter (extraction_method is null) as no_method from documents group by 1")
def manifest(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.coalesce("n_chars", F.lit(0))).alias("chars"), F.count_if(F.col("extraction_method").isNull()).alias("no_method"))


@query("k11_markdown_lines", "select '| ' || region_nombre || ' | ' || count(*)::varchar || ' |' as line from communes_master group by region_nombre")
def markdown_lines(t: Tables) -> DataFrame:
    n = t.communes_master.groupBy("region_nombre").agg(F.count(F.lit(1)).alias("n"))
    return n.select(sinks.table_lines(["region_nombre", "n"]).alias("line"))


@query("k12_patched_html", "select lote, '<p>Total <b id=\"total\">' || count(*)::varchar || '</b> actos</p>' as html from providencia_records group by 1")
def patched_html(t: Tables) -> DataFrame:
    """An element of a page replaced by its id."""
    n = t.providencia_records.groupBy("lote").agg(F.count(F.lit(1)).alias("n"))
    return n.select("lote", sinks.replaced_element(F.lit('<p>Total <b id="total">0</b> actos</p>'), "total", F.col("n").cast("string")).alias("html"))


@query("k1_envelope_of_totals", "select count(*) as n from (select fuente from providencia_records group by fuente)")
def envelope_of_totals(t: Tables) -> DataFrame:
    """A small result as one JSON envelope, and its declared count."""
    n = t.providencia_records.groupBy("fuente").agg(F.count(F.lit(1)).alias("n"))
    return sinks.envelope(n, "fuente").select(F.get_json_object("value", "$.count").cast("long").alias("n"))


@query("s6_table_counts", "select 'ordenanzas' as name, count(*) as n from ordenanzas union all select 'providencia_records', count(*) from providencia_records union all select 'documents', count(*) from documents")
def table_counts(t: Tables) -> DataFrame:
    one = lambda name: getattr(t, name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
    return one("ordenanzas").unionByName(one("providencia_records")).unionByName(one("documents"))
