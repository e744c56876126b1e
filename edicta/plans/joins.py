"""Joins of the catalog: strict, defaulted, anti, semi, cascading, by rules, through shared keys; set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicta.functions import rules, text, urls
from edicta.operators import dedup, graph, matching
from edicta.plans.registry import Tables, query

KEY = "trim(regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', ' ', 'g'))"


@query("j1_strict_inner", f"""
select p.record_id, m.comuna_nombre, m.region_id from providencia_records p join communes_master m on {KEY.format('p.comuna')} = {KEY.format('m.comuna_nombre')}""")
def strict_inner(t: Tables) -> DataFrame:
    """Inner join on the folded name."""
    m = t.communes_master.select("comuna_nombre", "region_id", text.normalize_key(F.col("comuna_nombre")).alias("k"))
    p = t.providencia_records.select("record_id", text.normalize_key(F.col("comuna")).alias("k"))
    return p.join(matching.sized(m), "k").select("record_id", "comuna_nombre", "region_id")


@query("j1_unmatched", f"""
select comuna, count(*) as n from providencia_records where comuna is not null and {KEY.format('comuna')} not in (select {KEY.format('comuna_nombre')} from communes_master) group by 1""")
def unmatched(t: Tables) -> DataFrame:
    """What a strict join would have to refuse."""
    m = t.communes_master.select(text.normalize_key(F.col("comuna_nombre")).alias("k"))
    p = t.providencia_records.where("comuna is not null").groupBy("comuna").agg(F.count(F.lit(1)).alias("n"))
    return p.withColumn("k", text.normalize_key(F.col("comuna"))).join(m, "k", "left_anti").select("comuna", "n")


@query("j2_left_default", "select p.record_id, coalesce(m.region_nombre, 'Sin región') as region from providencia_records p left join communes_master m on m.comuna_nombre = p.comuna")
def left_default(t: Tables) -> DataFrame:
    m = t.communes_master.select(F.col("comuna_nombre").alias("comuna"), F.col("region_nombre").alias("r"))
    return t.providencia_records.select("record_id", "comuna").join(matching.sized(m), "comuna", "left").select("record_id", F.coalesce("r", F.lit("Sin región")).alias("region"))


@query("j3_four_way", """
with p as (select cplt_code, count(*) as records, count(*) filter (verification.status = 'verified') as verified from providencia_records group by 1), n as (select comuna_nombre, count(*) as norms from ordenanzas group by 1)
select o.cplt_code, m.comuna_nombre, coalesce(p.records, 0) as records, coalesce(p.verified, 0) as verified, coalesce(n.norms, 0) as norms
from organisms o left join communes_master m on trim(regexp_replace(strip_accents(lower(m.comuna_nombre)), '[^a-z0-9]+', ' ', 'g')) = o.municipality_key left join p on p.cplt_code = o.cplt_code left join n on n.comuna_nombre = m.comuna_nombre""")
def four_way(t: Tables) -> DataFrame:
    """From the universe of organisms outward; every right side is aggregated before it is joined."""
    m = t.communes_master.select("comuna_nombre", text.normalize_key(F.col("comuna_nombre")).alias("municipality_key"))
    p = t.providencia_records.groupBy("cplt_code").agg(F.count(F.lit(1)).alias("r"), F.count_if(F.col("verification.status") == "verified").alias("v"))
    n = t.ordenanzas.groupBy("comuna_nombre").agg(F.count(F.lit(1)).alias("n"))
    out = t.organisms.select("cplt_code", "municipality_key").join(m, "municipality_key", "left").join(p, "cplt_code", "left").join(n, "comuna_nombre", "left")
    return out.select("cplt_code", "comuna_nombre", *(F.coalesce(a, F.lit(0)).alias(b) for a, b in (("r", "records"), ("v", "verified"), ("n", "norms"))))


@query("j4_left_anti", """
select record_id from (select record_id, verification.sha256 as h, row_number() over (partition by verification.sha256 order by record_id) as r from providencia_records where lote > 1 and verification.sha256 <> '')
where r = 1 and h not in (select verification.sha256 from providencia_records where lote = 1 and verification.sha256 is not null)""")
def left_anti(t: Tables) -> DataFrame:
    """Hashes of later batches that the first has not, the first record of each."""
    p = t.providencia_records.select("record_id", "lote", F.col("verification.sha256").alias("h"))
    return dedup.append_delta(p.where("lote = 1"), p.where("lote > 1 and h != ''"), ["h"], "record_id").select("record_id")


@query("j5_left_semi", "select id from ordenanzas where comuna_nombre in (select comuna_nombre from communes_master where region_id = '13')")
def left_semi(t: Tables) -> DataFrame:
    m = t.communes_master.where("region_id = '13'").select("comuna_nombre")
    return t.ordenanzas.join(matching.sized(m), "comuna_nombre", "left_semi").select("id")


@query("j6_anti_flag", "select comuna_nombre, comuna_nombre not in (select comuna from providencia_records where lote > 6 and comuna is not null) as quiet from communes_master")
def anti_flag(t: Tables) -> DataFrame:
    late = t.providencia_records.where("lote > 6 and comuna is not null").select(F.col("comuna").alias("c")).distinct()
    return t.communes_master.join(late, F.col("c") == F.col("comuna_nombre"), "left").select("comuna_nombre", F.col("c").isNull().alias("quiet"))


@query("j7_exactly_one", """
with k as (select titulo, count(*) as n, min(record_id) as record_id from providencia_records where titulo is not null group by 1)
select o.id, case when k.n = 1 then k.record_id end as record_id, coalesce(k.n = 1, false) as matched from ordenanzas o left join k on k.titulo = o.titulo""")
def exactly_one(t: Tables) -> DataFrame:
    """Rows that meet one row, and one only, of the other table; all others are accounted for as unmatched."""
    right = t.providencia_records.where("titulo is not null").select("titulo", "record_id")
    return matching.exactly_one(t.ordenanzas.select("id", "titulo"), right, "titulo", "record_id").select("id", "record_id", "matched")


@query("j8_fuzzy_best", f"""
with v as (select distinct {KEY.format('comuna')} as typed from providencia_records where comuna is not null), m as (select {KEY.format('comuna_nombre')} as name from communes_master),
d as (select typed, name, levenshtein(typed, name) as distance from v, m where abs(length(typed) - length(name)) <= 3)
select typed, arg_min(name, (distance, name)) as name, min(distance)::int as distance from d where distance <= 3 group by 1""")
def fuzzy_best(t: Tables) -> DataFrame:
    """The nearest name within three edits for each typed name; found by pieces, without a cross join."""
    typed = t.providencia_records.select(text.normalize_key(F.col("comuna")).alias("typed"))
    names = t.communes_master.select(text.normalize_key(F.col("comuna_nombre")).alias("name"))
    return matching.best_similar(typed, "typed", names, "name", 3)


@query("j9_longest_contained", r"""
with n as (select comuna_nombre, trim(regexp_replace(lower(comuna_nombre), '[^\p{L}\p{N}]+', ' ', 'g')) as k from communes_master),
x as (select id, ' ' || trim(regexp_replace(lower(titulo), '[^\p{L}\p{N}]+', ' ', 'g')) || ' ' as t from ordenanzas where titulo is not null)
select id, arg_max(comuna_nombre, (length(k), k)) as comuna_nombre from x, n where contains(t, ' ' || k || ' ') group by 1""")
def longest_contained(t: Tables) -> DataFrame:
    """The longest territory name in each title: 'X del Mar' wins over 'X'."""
    return matching.longest_contained(t.ordenanzas.where("titulo is not null"), "id", "titulo", t.communes_master.select("comuna_nombre"), "comuna_nombre")


@query("j10_attribution", """
with c as (select a.comuna_nombre as short, b.comuna_nombre as long from communes_master a join communes_master b on starts_with(b.comuna_nombre, a.comuna_nombre || ' '))
select o.id, o.comuna_nombre as stated, c.long as corrected from ordenanzas o join c on c.short = o.comuna_nombre where contains(o.titulo, c.long)""")
def attribution(t: Tables) -> DataFrame:
    """Acts filed under a name that is the beginning of the name their title gives. The pairs of names are found by an equality join on
    each name's beginnings."""
    m = t.communes_master.select(F.col("comuna_nombre").alias("long"))
    parts = F.split("long", " ")
    begins = m.select("long", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), " "))).alias("short")).where("short != long and short != ''")
    pairs = begins.join(t.communes_master.select(F.col("comuna_nombre").alias("short")), "short", "left_semi")
    o = t.ordenanzas.select("id", F.col("comuna_nombre").alias("short"), "titulo").join(matching.sized(pairs), "short")
    return o.where(F.contains("titulo", F.col("long"))).select("id", F.col("short").alias("stated"), F.col("long").alias("corrected"))


BASKET_RULES = [rules.Rule(1, "residuos", "residuo|aseo|basura|recicla"), rules.Rule(2, "ruidos", "ruido|sonor|musica"), rules.Rule(3, "mascotas", "mascota|perro|gato", negate="gatos artificiales"), rules.Rule(4, "transito", "transito|vehiculo|estacionamiento|velocidad"), rules.Rule(5, "comercio", "comercio|feria|botilleria|patente")]
_FOLDED = "strip_accents(lower(titulo))"


@query("j11_multi_label", "select label, count(*) as acts from (" + " union all ".join(f"select '{r.label}' as label from ordenanzas where regexp_matches({_FOLDED}, '{r.pattern}')" + (f" and not regexp_matches({_FOLDED}, '{r.negate}')" if r.negate else "") for r in BASKET_RULES) + ") group by 1")
def multi_label(t: Tables) -> DataFrame:
    """Rules compiled into one projection: every label of a title, without a theta join."""
    labels = rules.all_labels(text.fold(F.col("titulo")), BASKET_RULES)
    return t.ordenanzas.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("acts"))


@query("j12_cascade", """
select o.id, coalesce(s.record_id, u.record_id, -1) as record_id from ordenanzas o
left join (select target_url, min(record_id) as record_id from providencia_records group by 1) s on s.target_url = o.pdf_url
left join (select titulo, min(record_id) as record_id from providencia_records group by 1) u on u.titulo = o.titulo""")
def cascade(t: Tables) -> DataFrame:
    """By address, else by title, else a default."""
    first = lambda c, a: t.providencia_records.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(a)).agg(F.min("record_id").alias(f"r_{a}"))
    out = t.ordenanzas.select("id", F.col("pdf_url").alias("a"), F.col("titulo").alias("b")).join(first("target_url", "a"), "a", "left").join(first("titulo", "b"), "b", "left")
    return out.select("id", F.coalesce("r_a", "r_b", F.lit(-1)).alias("record_id"))


@query("j13_composite_first", "select o.id, f.record_id from ordenanzas o left join (select fecha, numero, min(record_id) as record_id from providencia_records group by 1, 2) f on f.fecha = o.fecha_publicacion and f.numero = o.numero")
def composite_first(t: Tables) -> DataFrame:
    f = t.providencia_records.where("fecha is not null and numero is not null").groupBy("fecha", "numero").agg(F.min("record_id").alias("record_id"))
    o = t.ordenanzas.select("id", F.col("fecha_publicacion").alias("fecha"), "numero")
    return o.join(f, ["fecha", "numero"], "left").select("id", "record_id")


@query("j14_shared_urls", "select target_url, count(distinct comuna) as territories, count(*) as records from providencia_records where target_url is not null group by 1 having count(distinct comuna) > 1")
def shared_urls(t: Tables) -> DataFrame:
    """A self-join through a shared address, as an aggregate: pairs are never formed."""
    g = t.providencia_records.where("target_url is not null").groupBy("target_url").agg(F.count_distinct("comuna").alias("territories"), F.count(F.lit(1)).alias("records"))
    return g.where("territories > 1")


@query("j15_rollup_to_organism", "select o.cplt_code, count(p.record_id) as records, count(distinct p.tabla_id) as tables from organisms o left join providencia_records p on p.cplt_code = o.cplt_code group by 1")
def rollup_to_organism(t: Tables) -> DataFrame:
    per = t.providencia_records.groupBy("cplt_code").agg(F.count(F.lit(1)).alias("r"), F.count_distinct("tabla_id").alias("t"))
    return t.organisms.select("cplt_code").join(per, "cplt_code", "left").select("cplt_code", F.coalesce("r", F.lit(0)).alias("records"), F.coalesce("t", F.lit(0)).alias("tables"))


@query("j16_seeds_not_listed", """
select numero, target_url, 'seed' as origin from providencia_records s where lote = 2 and numero is not null and target_url is not null and not exists (select 1 from providencia_records l where l.lote = 1 and l.numero = s.numero and l.target_url = s.target_url)
union all select numero, target_url, 'listing' from providencia_records where lote = 1""")
def seeds_not_listed(t: Tables) -> DataFrame:
    p = t.providencia_records.select("lote", "numero", "target_url")
    listing = p.where("lote = 1").drop("lote")
    seeds = p.where("lote = 2 and numero is not null and target_url is not null").drop("lote").join(listing, ["numero", "target_url"], "left_anti")
    return seeds.withColumn("origin", F.lit("seed")).unionByName(listing.withColumn("origin", F.lit("listing")))


@query("j17_shard_merge", """
select (record_id % 4)::int as shard, count(*) as records, count(distinct record_id) = count(*) as disjoint from providencia_records group by 1""")
def shard_merge(t: Tables) -> DataFrame:
    """Shards of a table, merged again: sizes and whether any id came twice."""
    p = t.providencia_records.select("record_id", F.pmod("record_id", F.lit(4)).cast("int").alias("shard"))
    return p.groupBy("shard").agg(F.count(F.lit(1)).alias("records"), (F.count_distinct("record_id") == F.count(F.lit(1))).alias("disjoint"))


@query("j18_host_pairs", r"""
select record_id from providencia_records where regexp_replace(lower(regexp_extract(target_url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), '^www\.|:[0-9]+$', '', 'g') = regexp_replace(lower(regexp_extract(source_listing_url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), '^www\.|:[0-9]+$', '', 'g')""")
def host_pairs(t: Tables) -> DataFrame:
    p = t.providencia_records
    return p.where(urls.root_host(F.col("target_url")) == urls.root_host(F.col("source_listing_url"))).select("record_id")


@query("u1_union_lineage", "select 'ordenanzas' as origin, id as row_key, titulo from ordenanzas union all select 'providencia', record_id, titulo from providencia_records")
def union_lineage(t: Tables) -> DataFrame:
    a = t.ordenanzas.select(F.lit("ordenanzas").alias("origin"), F.col("id").alias("row_key"), "titulo")
    return a.unionByName(t.providencia_records.select(F.lit("providencia").alias("origin"), F.col("record_id").alias("row_key"), "titulo"))


@query("u2_replace_partition", """
with new as (select tabla_id, record_id from providencia_records where lote = 3), old as (select tabla_id, record_id from providencia_records where lote = 1)
select * from old where tabla_id not in (select tabla_id from new) union all select * from new""")
def replace_partition(t: Tables) -> DataFrame:
    p = t.providencia_records.select("tabla_id", "record_id", "lote")
    return dedup.replace_partition(p.where("lote = 1").drop("lote"), p.where("lote = 3").drop("lote"), "tabla_id")


@query("u3_append_delta", """
select record_id, target_url from (select record_id, target_url, row_number() over (partition by target_url order by record_id) as r from providencia_records where lote > 8 and target_url is not null)
where r = 1 and target_url not in (select target_url from providencia_records where lote <= 8 and target_url is not null)""")
def append_delta(t: Tables) -> DataFrame:
    p = t.providencia_records.select("record_id", "target_url", "lote").where("target_url is not null")
    return dedup.append_delta(p.where("lote <= 8"), p.where("lote > 8"), ["target_url"], "record_id").select("record_id", "target_url")


@query("u4_ordered_distinct", "select titulo, string_agg(w, ' ' order by p) as words from (select titulo, w, min(p) as p from (select titulo, unnest(string_split(lower(titulo), ' ')) as w, generate_subscripts(string_split(lower(titulo), ' '), 1) as p from (select distinct titulo from ordenanzas where titulo is not null)) group by 1, 2) group by 1")
def ordered_distinct(t: Tables) -> DataFrame:
    """Words of a title, each once, in the order they first come."""
    return t.ordenanzas.where("titulo is not null").select("titulo").distinct().withColumn("words", F.array_join(F.array_distinct(F.split(F.lower("titulo"), " ")), " "))


@query("u5_coalesce_merge", """
select coalesce(a.numero, b.numero) as numero, coalesce(a.titulo, b.titulo) as titulo, a.numero is null as filled from (select numero, min(titulo) as titulo from ordenanzas where numero is not null group by 1) a
full join (select numero, min(titulo) as titulo from providencia_records where numero is not null group by 1) b on a.numero = b.numero""")
def coalesce_merge(t: Tables) -> DataFrame:
    side = lambda df, x: df.where("numero is not null").groupBy("numero").agg(F.min("titulo").alias(x)).withColumn(f"in_{x}", F.lit(True))
    both = side(t.ordenanzas, "a").join(side(t.providencia_records, "b"), "numero", "full")
    return both.select("numero", F.coalesce("a", "b").alias("titulo"), F.col("in_a").isNull().alias("filled"))


@query("u6_accounting", """
select count(*) as input, count(*) filter (length(verification.sha256) = 64) as kept, count(*) filter (not coalesce(length(verification.sha256) = 64, false)) as quarantined from providencia_records""")
def accounting(t: Tables) -> DataFrame:
    """kept and quarantined add up to the input."""
    ok = F.coalesce(F.length("verification.sha256") == 64, F.lit(False))
    return t.providencia_records.agg(F.count(F.lit(1)).alias("input"), F.count_if(ok).alias("kept"), F.count_if(~ok).alias("quarantined"))


@query("u6_except", "select comuna_nombre from communes_master except select comuna from providencia_records")
def except_(t: Tables) -> DataFrame:
    return t.communes_master.select("comuna_nombre").subtract(t.providencia_records.select("comuna"))


@query("u6_intersect", "select comuna_nombre from ordenanzas intersect select comuna from providencia_records")
def intersect(t: Tables) -> DataFrame:
    return t.ordenanzas.select("comuna_nombre").intersect(t.providencia_records.select("comuna"))


@query("u7_missing_shards", "select r.range::bigint as lote from range(1, 20) r where r.range not in (select lote from providencia_records)")
def missing_shards(t: Tables) -> DataFrame:
    have = t.providencia_records.select(F.col("lote").cast("long").alias("lote")).distinct()
    return t.spark.range(1, 20).withColumnRenamed("id", "lote").join(have, "lote", "left_anti")


@query("u8_overlap", "select cplt_code, coalesce(bool_or(materia_id in ('aseo_residuos', 'aseo')), false) as waste from providencia_records where cplt_code is not null group by 1")
def overlap(t: Tables) -> DataFrame:
    """Whether the set of an organism's subjects meets a set of aliases; the set is bounded by the vocabulary."""
    wanted = F.array(F.lit("aseo_residuos"), F.lit("aseo"))
    g = t.providencia_records.where("cplt_code is not null").groupBy("cplt_code").agg(F.collect_set("materia_id").alias("s"))
    return g.select("cplt_code", F.arrays_overlap("s", wanted).alias("waste"))


@query("m5_reachable", """
with recursive e as (select distinct regexp_extract(source_listing_url, '^https?://([^/]*)', 1) as src, regexp_extract(target_url, '^https?://([^/]*)', 1) as dst from providencia_records where source_listing_url is not null and target_url is not null
 union select distinct regexp_extract(target_url, '^https?://([^/]*)', 1), comuna from providencia_records where target_url is not null and comuna is not null and lote = 2),
r(node, depth) as (select min(src), 0 from e union select e.dst, r.depth + 1 from r join e on e.src = r.node where r.depth < 3)
select node, min(depth)::int as depth from r group by 1""")
def reachable(t: Tables) -> DataFrame:
    """Hosts and territories reached from one host in at most three steps: over the links of all batches between hosts, and those of the
    second batch from hosts to territories."""
    return reached(t.providencia_records, t.providencia_records.where("lote = 2"))


def reached(links: DataFrame, places: DataFrame) -> DataFrame:
    """(node, depth) within three steps of the first host; links join hosts, places hosts to territories."""
    host = lambda c: F.regexp_extract(c, r"^https?://([^/]*)", 1)
    a = links.where("source_listing_url is not null and target_url is not null").select(host("source_listing_url").alias("src"), host("target_url").alias("dst"))
    b = places.where("target_url is not null and comuna is not null").select(host("target_url").alias("src"), F.col("comuna").alias("dst"))
    edges = a.union(b).distinct()
    return graph.reachable(edges.agg(F.min("src").alias("node")), edges, 3)


@query("m5_reachable_all", """
with recursive e as (select distinct regexp_extract(source_listing_url, '^https?://([^/]*)', 1) as src, regexp_extract(target_url, '^https?://([^/]*)', 1) as dst from providencia_records where source_listing_url is not null and target_url is not null
 union select distinct regexp_extract(target_url, '^https?://([^/]*)', 1), comuna from providencia_records where target_url is not null and comuna is not null),
r(node, depth) as (select min(src), 0 from e union select e.dst, r.depth + 1 from r join e on e.src = r.node where r.depth < 3)
select node, min(depth)::int as depth from r group by 1""")
def reachable_all(t: Tables) -> DataFrame:
    """m5_reachable over the links of every batch."""
    return reached(t.providencia_records, t.providencia_records)


@query("m10_merge_update", """
select m.comuna_nombre, coalesce(u.last, 'never') as last_fetch from communes_master m left join (select comuna, max(capturado_en)::date::varchar as last from providencia_records group by 1) u on u.comuna = m.comuna_nombre""")
def merge_update(t: Tables) -> DataFrame:
    """Status of a plan's rows updated by name."""
    u = t.providencia_records.groupBy(F.col("comuna").alias("comuna_nombre")).agg(F.max("capturado_en").cast("date").cast("string").alias("last"))
    return t.communes_master.select("comuna_nombre").join(u, "comuna_nombre", "left").select("comuna_nombre", F.coalesce("last", F.lit("never")).alias("last_fetch"))
