"""Ladders, repairs and merges over whole tables, each giving the values themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edicta.functions import dates, ladders, text, urls
from edicta.operators import dedup, matching, setops
from edicta.plans.registry import Tables, query

FILE_SQL = "nullif(replace(regexp_extract(regexp_extract(target_url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), '%20', ' '), '')"
_TEXT = "concat(coalesce(fecha, ''), ' ', coalesce(fecha_publicidad, ''), ' ', coalesce(descripcion, ''))"
_DATE_SQL = {"date": "trim(coalesce(fecha, ''))", "text": _TEXT, "url": "coalesce(target_url, '')"}
_NUMBER_SQL = {"both": f"concat(coalesce(titulo, ''), ' ', coalesce({FILE_SQL}, ''))", "file": f"coalesce({FILE_SQL}, '')", "title": "coalesce(titulo, '')", "url": "coalesce(target_url, '')"}


def _joined(*names: str):
    return F.concat_ws(" ", *(F.coalesce(n, F.lit("")) for n in names))


@query("f53_date_ladders", "select record_id, " + ", ".join(f"{ladders.climbed_sql(steps, repr(d), _DATE_SQL)} as {n}" for n, (steps, d) in ladders.DATES.items()) + " from providencia_records")
def date_ladders(t: Tables) -> DataFrame:
    """The date of every record by each of the ladders, that differ in order, sources and what they make up."""
    sources = {"date": F.trim(F.coalesce("fecha", F.lit(""))), "text": _joined("fecha", "fecha_publicidad", "descripcion"), "url": F.coalesce("target_url", F.lit(""))}
    return t.providencia_records.select("record_id", *(ladders.climbed(steps, d, sources).alias(n) for n, (steps, d) in ladders.DATES.items()))


@query("f56_number_ladders", "select record_id, " + ", ".join(f"{ladders.climbed_sql(steps, repr(d), _NUMBER_SQL)} as {n}" for n, (steps, d) in ladders.NUMBERS.items()) + " from providencia_records")
def number_ladders(t: Tables) -> DataFrame:
    """The number of every record by each of the extractors."""
    file = urls.file_name(F.col("target_url"))
    title = F.coalesce("titulo", F.lit(""))
    sources = {"both": F.concat_ws(" ", title, F.coalesce(file, F.lit(""))), "file": F.coalesce(file, F.lit("")), "title": title, "url": F.coalesce("target_url", F.lit(""))}
    return t.providencia_records.select("record_id", *(ladders.climbed(steps, d, sources).alias(n) for n, (steps, d) in ladders.NUMBERS.items()))


_FOUND = ladders.climbed_sql(ladders.FILE_DATES, "''", {"file": f"coalesce({FILE_SQL}, '')", "url": "coalesce(target_url, '')"})


@query("f52_file_dates", rf"""
select record_id, case when coalesce(fecha like '%-01-01' or regexp_matches(fecha, '^(20[3-9]\d|2[1-9]\d\d)'), false) then
  case when left(d, 4) <= '{ladders.LAST_YEAR}' and (length(d) in (0, 4, 7) or substring(d, 6, 2) between '01' and '12' and substring(d, 9, 2) between '01' and '31') then d else '' end else fecha end as fecha
from (select record_id, fecha, {_FOUND} as d from providencia_records)""")
def file_dates(t: Tables) -> DataFrame:
    return t.providencia_records.select("record_id", ladders.recovered_date(F.col("fecha"), F.coalesce("target_url", F.lit("")), F.coalesce(urls.file_name(F.col("target_url")), F.lit(""))).alias("fecha"))


_COMPILED = "(coalesce(contains(lower(target_url), 'compilado'), false) or coalesce(contains(lower(titulo), 'compilado'), false))"
_YEARS = ", ".join(f"'{y}'" for y in ladders.YEARS)


@query("f57_number_repairs", rf"""
with n as (select *, case when starts_with(s, 'DOC-') then 'S/N' else s end as num from (select record_id, titulo, target_url, coalesce({FILE_SQL}, '') as file, regexp_replace(trim(coalesce(numero, '')), '(?i)^(.*?)-[0-9a-f]{{4}}$', '\1') as s from providencia_records))
select record_id, case when {_COMPILED} then 'Compilado' when regexp_matches(file, '{ladders.YEAR_AND_NUMBER}') then regexp_extract(file, '{ladders.YEAR_AND_NUMBER}', 2)
 when num in ({_YEARS}) then case when regexp_extract(file, '{ladders.IN_FILE}', 1) not in ('', num) then regexp_extract(file, '{ladders.IN_FILE}', 1) else coalesce(nullif(regexp_extract(coalesce(titulo, ''), '{ladders.IN_TITLE}', 1), ''), 'S/N') end
 when num in ('', 'None') then 'S/N' else num end as num from n""")
def number_repairs(t: Tables) -> DataFrame:
    url = F.col("target_url")
    return t.providencia_records.select("record_id", ladders.repaired_number(F.col("numero"), F.col("titulo"), url, urls.file_name(url)).alias("num"))


_HALF = "length(titulo) % 2 = 1 and lower(left(titulo, length(titulo) // 2)) = lower(right(titulo, length(titulo) // 2)) and regexp_matches(substring(titulo, length(titulo) // 2 + 1, 1), '\\s')"


@query("f17_said_once", f"select id, case when {_HALF} then left(titulo, length(titulo) // 2) else titulo end as titulo from (select id, trim(regexp_replace(titulo, '\\s+', ' ', 'g')) as titulo from ordenanzas) where titulo is not null")
def said_once(t: Tables) -> DataFrame:
    """Every title, said once."""
    return t.ordenanzas.where("titulo is not null").select("id", ladders.said_once(F.trim(F.regexp_replace("titulo", r"\s+", " "))).alias("titulo"))


_STEM = f"trim(regexp_replace(regexp_replace(coalesce({FILE_SQL}, ''), '\\.[^.]*$', ''), '[-_+]+', ' ', 'g'))"
_NAMED = f"concat('Ordenanza Municipal de ', coalesce(comuna, ''), ' — ', {_STEM})"


@query("f19_title_repairs", rf"""
with x as (select *, case when {_HALF} then left(titulo, length(titulo) // 2) else coalesce(titulo, '') end as once, coalesce({FILE_SQL}, '') as file from providencia_records)
select record_id, case when {_COMPILED} then concat('Compilado de Ordenanzas Municipales — ', coalesce(comuna, ''))
 when lower(once) in ({', '.join(f"'{x}'" for x in ladders.LINK_LABELS)}) or contains(lower(once), 'untitled') then
  case when regexp_matches(file, '{ladders.NUMBERED_FILE}') then concat('Ordenanza ', trim(regexp_replace(replace(regexp_extract(file, '{ladders.NUMBERED_FILE}', 3), '+', ' '), '\s+', ' ', 'g')))
  when contains(lower(file), 'medio-ambiente') then concat('Ordenanza Municipal de Medio Ambiente — ', coalesce(comuna, '')) when contains(lower(file), 'mascarilla') then concat('Ordenanza Municipal sobre Uso de Mascarillas — ', coalesce(comuna, '')) else {_NAMED} end
 when starts_with(lower(once), 'enlace ') and trim(regexp_extract(once, '{ladders.BETWEEN_LINKS}', 1)) <> '' then upper(left(trim(regexp_extract(once, '{ladders.BETWEEN_LINKS}', 1)), 1)) || substring(trim(regexp_extract(once, '{ladders.BETWEEN_LINKS}', 1)), 2)
 when lower(once) in ({', '.join(f"'{x}'" for x in ladders.BARE_TITLES)}) then {_NAMED} else once end as titulo from x""")
def title_repairs(t: Tables) -> DataFrame:
    url = F.col("target_url")
    return t.providencia_records.select("record_id", ladders.repaired_title(F.col("titulo"), F.col("comuna"), url, urls.file_name(url)).alias("titulo"))


@query("f34_unquoted_all", "select record_id, url_decode(replace(target_url, '+', '%2B')) as url, url_encode(coalesce(titulo, '')) as quoted from providencia_records where target_url is not null")
def unquoted_all(t: Tables) -> DataFrame:
    """Every address with its escapes undone, and every title escaped."""
    quoted = F.replace(F.replace(F.url_encode(F.coalesce("titulo", F.lit(""))), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    return t.providencia_records.where("target_url is not null").select("record_id", urls.unquoted(F.col("target_url")).alias("url"), F.replace(quoted, F.lit("%7E"), F.lit("~")).alias("quoted"))


_NAMES = ["file", "pdf", "url", "document", "id"]


@query("f36_targets_all", "select record_id, " + ", ".join(f"nullif(regexp_extract(regexp_extract(target_url, '\\?([^#]*)', 1), '(?:^|&){n}=([^&]*)', 1), '') as {n}" for n in _NAMES) + r", coalesce(nullif(regexp_extract(source_listing_url, '/(?:page|pagina)/(\d+)', 1), ''), nullif(regexp_extract(source_listing_url, '[?&](?:page|p|m)=(\d+)', 1), ''), '1')::int as page from providencia_records where target_url is not null and source_listing_url is not null")
def targets_all(t: Tables) -> DataFrame:
    """The parameters that may name a document, and the page of the listing in a parameter or the path, of every record."""
    p = t.providencia_records.where("target_url is not null and source_listing_url is not null")
    return p.select("record_id", *(urls.parameter(F.col("target_url"), n).alias(n) for n in _NAMES), urls.page_number(F.col("source_listing_url")).alias("page"))


@query("f4_collapsed_text", rf"select record_id, trim(regexp_replace(regexp_replace(comuna, '[{text.INVISIBLE}]', '', 'g'), '{text.WHITE}', ' ', 'g')) as comuna from providencia_records where comuna is not null")
def collapsed_text(t: Tables) -> DataFrame:
    """The collapsed name itself."""
    return t.providencia_records.where("comuna is not null").select("record_id", F.trim(F.regexp_replace(F.translate("comuna", text.INVISIBLE, ""), text.WHITE, " ")).alias("comuna"))


@query("f10_stripped_tags", rf"select record_id, trim(regexp_replace(regexp_replace(coalesce(titulo, ''), '<[^>]*>', ' ', 'g'), '{text.WHITE}', ' ', 'g')) as titulo from providencia_records where not coalesce(contains(titulo, '&'), false)")
def stripped_tags(t: Tables) -> DataFrame:
    """Titles put into cells of markup and taken out again; those with entities are tested on fixtures."""
    from edicta.sources import formats

    p = t.providencia_records.where("not coalesce(contains(titulo, '&'), false)")
    return p.select("record_id", formats.strip_tags(F.concat(F.lit("<td class='t'><b>"), F.coalesce("titulo", F.lit("")), F.lit("</b><br></td>"))).alias("titulo"))


# -- merges, attribution, order


@query("j17_merged_shards", """
with s as (select lote as shard, cplt_code as k from providencia_records), want as (select unnest(range(1, (select max(lote) from providencia_records) + 2)) as shard)
select 'rows' as finding, count(*) as n from s union all select 'rows without key', count(*) from s where k is null
union all select 'keys in several shards', count(*) from (select k from s where k is not null group by 1 having count(distinct shard) > 1)
union all select 'missing shards', count(*) from want where shard not in (select shard from s)""")
def merged_shards(t: Tables) -> DataFrame:
    """What a merge of shards finds, one more shard being expected than there are: a sound merge has rows and no other finding."""
    p = t.providencia_records.select(F.col("lote").alias("shard"), F.col("cplt_code").alias("k"))
    return setops.merge_findings(p, "shard", "k", first=1, count=(p.agg(F.max("shard")).first()[0] or 0) + 1)


@query("j17_sound_merge", "select cplt_code, organism_name from organisms")
def sound_merge(t: Tables) -> DataFrame:
    """A table in shards by its key, merged: the job fails unless each key lies in one shard and no shard is missing."""
    o = t.organisms.select("cplt_code", "organism_name", F.pmod(F.xxhash64("cplt_code"), F.lit(4)).cast("int").alias("shard"))
    return setops.merged(o, "shard", "cplt_code", count=4)


@query("u7_missing_by_region", "with l as (select distinct region_id, lote from providencia_records where region_id is not null) select r.region_id, g.n::int as lote from (select distinct region_id from l) r cross join (select unnest(range(1, (select max(lote) + 1 from providencia_records))) as n) g where not exists (select 1 from l where l.region_id = r.region_id and l.lote = g.n)")
def missing_by_region(t: Tables) -> DataFrame:
    """Batches that bring nothing for a region; what is expected comes from the data."""
    p = t.providencia_records.select("region_id", "lote").where("region_id is not null")
    last = t.providencia_records.agg(F.max("lote")).first()[0] or 0
    wanted = p.select("region_id").distinct().withColumn("lote", F.explode(F.sequence(F.lit(1), F.lit(last)) if last else F.array().cast("array<int>")))
    return wanted.join(p.distinct(), ["region_id", "lote"], "left_anti")


_PAIRS = "(select a.comuna_nombre as short, b.comuna_nombre as long from communes_master a join communes_master b on a.comuna_nombre <> b.comuna_nombre and (starts_with(b.comuna_nombre, a.comuna_nombre || ' ') or ends_with(b.comuna_nombre, ' ' || a.comuna_nombre)))"


@query("j10_moves", f"""
with c as (select short as stated, long as meant from {_PAIRS} union all select long, short from {_PAIRS}),
h as (select o.id, c.stated, c.meant, o.norma_uri from ordenanzas o join c on c.stated = o.comuna_nombre where contains(lower(o.titulo), lower(c.meant)) and not (length(c.stated) > length(c.meant) and contains(lower(o.titulo), lower(c.stated))))
select id, stated, arg_max(meant, (length(meant), meant)) as meant, bool_or(exists (select 1 from ordenanzas x where x.comuna_nombre = h.meant and x.norma_uri = h.norma_uri)) as present from h group by 1, 2""")
def moves(t: Tables) -> DataFrame:
    """Acts filed under a name that begins, ends, or goes on from the name their title gives: where they belong, and whether they are
    there already (then the move leaves one copy)."""
    m = t.communes_master.select(F.col("comuna_nombre").alias("long"))
    parts, n = F.split("long", " "), F.size(F.split("long", " "))
    begins = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), " "))
    ends = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, i + 1, n), " "))
    held = m.select("long", F.explode(F.array_distinct(F.concat(begins, ends))).alias("short")).where("short != long and short != ''")
    pairs = held.join(m.select(F.col("long").alias("short")), "short", "left_semi")
    both = pairs.select(F.col("short").alias("stated"), F.col("long").alias("meant")).unionByName(pairs.select(F.col("long").alias("stated"), F.col("short").alias("meant")))
    o = t.ordenanzas.select("id", F.col("comuna_nombre").alias("stated"), F.lower("titulo").alias("t"), "norma_uri").join(matching.sized(both), "stated")
    said = F.contains("t", F.lower("meant")) & ~((F.length("stated") > F.length("meant")) & F.contains("t", F.lower("stated")))
    there = t.ordenanzas.select(F.col("comuna_nombre").alias("meant"), "norma_uri").where("norma_uri is not null").distinct().withColumn("there", F.lit(True))
    hits = o.where(said).join(there, ["meant", "norma_uri"], "left")
    return hits.groupBy("id", "stated").agg(F.max_by("meant", F.struct(F.length("meant"), "meant")).alias("meant"), F.bool_or(F.coalesce("there", F.lit(False))).alias("present"))


@query("j16_seeds_all", "select numero, pdf_url as url, 'seed' as origin from ordenanzas o where numero is not null and pdf_url is not null and not exists (select 1 from providencia_records p where p.numero = o.numero and p.target_url = o.pdf_url) union all select numero, target_url, 'listing' from providencia_records")
def seeds_all(t: Tables) -> DataFrame:
    """The listing, and the seeds it does not have by number and address: all rows of both tables."""
    listing = t.providencia_records.select("numero", F.col("target_url").alias("url"))
    seeds = t.ordenanzas.select("numero", F.col("pdf_url").alias("url")).where("numero is not null and url is not null").join(listing.distinct(), ["numero", "url"], "left_anti")
    return seeds.withColumn("origin", F.lit("seed")).unionByName(listing.withColumn("origin", F.lit("listing")))


_FOLD = "trim(regexp_replace(strip_accents(lower(coalesce(comuna, ''))), '[^a-z0-9]+', ' ', 'g'))"


@query("w2_first_by_address", "select min(record_id) as record_id from providencia_records where target_url is not null group by target_url")
def first_by_address(t: Tables) -> DataFrame:
    return t.providencia_records.where("target_url is not null").groupBy("target_url").agg(F.min("record_id").alias("record_id")).select("record_id")


@query("w2_first_by_act", "select min(record_id) as record_id from providencia_records where cplt_code is not null and numero is not null and fecha is not null group by cplt_code, numero, fecha")
def first_by_act(t: Tables) -> DataFrame:
    """The first record of each organism, number and date."""
    return t.providencia_records.dropna(subset=["cplt_code", "numero", "fecha"]).groupBy("cplt_code", "numero", "fecha").agg(F.min("record_id").alias("record_id")).select("record_id")


@query("w6_second_clash", """
with k as (select record_id, cplt_code, numero, fecha, left(verification.sha256, 4) as x, row_number() over (partition by cplt_code, numero, fecha order by record_id) as r from providencia_records where cplt_code is not null and numero is not null and fecha is not null and verification.sha256 <> ''),
l as (select *, case when r = 1 then numero else numero || '-' || x end as label from k)
select record_id, label from (select *, row_number() over (partition by cplt_code, label, fecha order by r > 1, record_id) as again from l) where again = 1""")
def second_clash(t: Tables) -> DataFrame:
    """A key that comes again gets the beginning of its hash; what clashes once more is dropped."""
    p = t.providencia_records.select("record_id", "cplt_code", "numero", "fecha", F.col("verification.sha256").alias("h")).dropna().where("h != ''")
    r = p.withColumn("r", F.row_number().over(Window.partitionBy("cplt_code", "numero", "fecha").orderBy("record_id")))
    labelled = r.withColumn("label", F.when(F.col("r") == 1, F.col("numero")).otherwise(F.concat_ws("-", "numero", F.substring("h", 1, 4))))
    return dedup.keep_best(labelled, ["cplt_code", "label", "fecha"], F.col("r") > 1, F.col("record_id")).select("record_id", "label")


@query("o7_first_rows", "select id, titulo from ordenanzas order by id limit 100")
def first_rows(t: Tables) -> DataFrame:
    """A limit on the rows to work on, in a total order."""
    return t.ordenanzas.select("id", "titulo").orderBy("id").limit(100)


@query("s2_all_envelopes", "select record_id, titulo from providencia_records")
def all_envelopes(t: Tables) -> DataFrame:
    """Envelopes of all records, their count asserted, unnested again."""
    from edicta.sources import formats

    packs = t.providencia_records.groupBy("source_listing_url", "lote", F.floor(F.col("record_id") / 1000)).agg(F.to_json(F.struct(F.count(F.lit(1)).alias("count"), F.collect_list(F.struct("record_id", "titulo")).alias("records"))).alias("j"))
    return formats.checked_records(packs.select(formats.envelopes(F.col("j"), "struct<record_id: bigint, titulo: string>").alias("e")), "e").select("record_id", "titulo")


@query("k1_envelope_records", "select area_id, area_label, alcance from subject_areas")
def envelope_records(t: Tables) -> DataFrame:
    """A small table as one envelope, its records read back whole and in order."""
    from edicta.sources import formats, sinks

    e = sinks.envelope(t.subject_areas.select("area_id", "area_label", "alcance"), "area_id")
    return formats.checked_records(e.select(formats.envelopes(F.col("value"), "struct<area_id: string, area_label: string, alcance: string>").alias("e")), "e").select("area_id", "area_label", "alcance")


_Y = "try_cast(left(fecha, 4) as int)"


@query("pred11_all_variants", rf"select record_id, coalesce({_Y} between 2021 and 2026, false) as by_prefix, coalesce({_Y} >= 2021, false) as open_ended, coalesce(regexp_matches(fecha, '202[1-6]'), false) as anywhere, coalesce(left(fecha, 4) >= '2021', false) as as_text, coalesce(try_cast(nullif(regexp_extract(fecha, '((?:19|20)\d{{2}})', 1), '') as int) between 2021 and 2026, false) as by_year, coalesce(regexp_matches(fecha, '^202[1-6]-[0-9]{{2}}-[0-9]{{2}}$'), false) as dated from providencia_records")
def all_variants(t: Tables) -> DataFrame:
    """Six readings of 'recent' for every record."""
    c, y = F.col("fecha"), F.left("fecha", F.lit(4)).try_cast("int")
    no = lambda x: F.coalesce(x, F.lit(False))
    return t.providencia_records.select("record_id", no(y.between(2021, 2026)).alias("by_prefix"), no(y >= 2021).alias("open_ended"), no(c.rlike("202[1-6]")).alias("anywhere"), no(F.left("fecha", F.lit(4)) >= "2021").alias("as_text"), dates.recent(c).alias("by_year"), no(c.rlike("^202[1-6]-[0-9]{2}-[0-9]{2}$")).alias("dated"))


@query("pred12_gaps", """
with g as (select comuna_nombre as c, count(*) as national from ordenanzas group by 1), p as (select comuna as c, count(*) as municipal, count(*) filter (try_cast(nullif(regexp_extract(fecha, '((?:19|20)[0-9]{2})', 1), '') as int) between 2021 and 2026) as recent from providencia_records group by 1)
select g.c as comuna from g left join p on p.c = g.c where g.national >= 15 and coalesce(p.municipal, 0) <= 5 and coalesce(p.recent, 0) <= 3""")
def gaps(t: Tables, national: int = 15, municipal: int = 5, recent: int = 3) -> DataFrame:
    """Names with many acts in one table, and hardly any, hardly any of them recent, in the other."""
    g = t.ordenanzas.groupBy(F.col("comuna_nombre").alias("comuna")).agg(F.count(F.lit(1)).alias("n"))
    p = t.providencia_records.groupBy("comuna").agg(F.count(F.lit(1)).alias("m"), F.count_if(dates.recent(F.col("fecha"))).alias("r"))
    none = lambda c: F.coalesce(c, F.lit(0))
    return g.join(p, "comuna", "left").where((F.col("n") >= national) & (none("m") <= municipal) & (none("r") <= recent)).select("comuna")


_ALL = ["communes_master", "organisms", "ordenanzas", "providencia_records", "documents", "subject_areas", "mix_targets"]


@query("s6_all_tables", " union all ".join(f"select '{n}' as name, (select count(*) from {n}) as rows, (select count(*) from information_schema.columns where table_name = '{n}') as columns" for n in _ALL))
def all_tables(t: Tables) -> DataFrame:
    """Every table of the domain as a catalog lists it: name, rows, columns."""
    out = None
    for n in _ALL:
        df = getattr(t, n)
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"))
        out = one if out is None else out.unionAll(one)
    return out


@query("k9_documents", "select doc_id, source, coalesce(materia_id, '') as materia, coalesce(length(text), 0)::int as chars, coalesce(extraction_method, '') as method, coalesce(sha256(text), '') as sha from documents")
def manifest_documents(t: Tables) -> DataFrame:
    """The manifest's list: one row a document."""
    sha = F.sha2(F.encode("text", "UTF-8"), 256)
    return t.documents.select("doc_id", "source", F.coalesce("materia_id", F.lit("")).alias("materia"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"), F.coalesce("extraction_method", F.lit("")).alias("method"), F.coalesce(sha, F.lit("")).alias("sha"))
