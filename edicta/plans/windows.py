"""Windows, ranking, top-k, ordering with limits, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edicta.functions import dates
from edicta.operators import dedup
from edicta.plans.registry import Tables, query
from edicta.session import cut

HASHED = "select record_id, fecha, titulo, numero, comuna, target_url, verification.sha256 as h from providencia_records"


def hashed(t: Tables) -> DataFrame:
    return t.providencia_records.select("record_id", "fecha", "titulo", "numero", "comuna", "target_url", F.nullif("verification.sha256", F.lit("")).alias("h"))


@query("w1_keep_best", f"""
with s as ({HASHED}), k as (select record_id, h, row_number() over (partition by h order by 2 * length(coalesce(fecha, '')) + length(coalesce(titulo, '')) desc, record_id) as r from s where h <> '')
select record_id from k where r = 1 union all select record_id from s where h is null or h = ''""")
def keep_best(t: Tables) -> DataFrame:
    """Of equal hashes the best scored, of equal scores the first; rows without a hash stay."""
    score = 2 * F.length(F.coalesce("fecha", F.lit(""))) + F.length(F.coalesce("titulo", F.lit("")))
    return dedup.keep_best(hashed(t), ["h"], score.desc(), F.col("record_id")).select("record_id")


@query("w2_first_wins", f"select min(record_id) as record_id from ({HASHED}) where h <> '' group by h")
def first_wins(t: Tables) -> DataFrame:
    return hashed(t).where("h is not null").groupBy("h").agg(F.min("record_id").alias("record_id")).select("record_id")


@query("w3_last_wins", f"select max(record_id) as record_id from ({HASHED}) where comuna is not null and numero is not null and target_url is not null group by comuna, numero, target_url")
def last_wins(t: Tables) -> DataFrame:
    rows = hashed(t).dropna(subset=["comuna", "numero", "target_url"])
    return rows.groupBy("comuna", "numero", "target_url").agg(F.max("record_id").alias("record_id")).select("record_id")


@query("w4_longest_label", f"select target_url, arg_max(titulo, (length(titulo), titulo)) as titulo from ({HASHED}) where target_url is not null and titulo is not null group by 1")
def longest_label(t: Tables) -> DataFrame:
    rows = hashed(t).where("target_url is not null and titulo is not null")
    return rows.groupBy("target_url").agg(F.max_by("titulo", F.struct(F.length("titulo"), "titulo")).alias("titulo"))


@query("w5_key_violations", f"select comuna, numero, fecha, count(*) as rows from ({HASHED}) where comuna is not null and numero not in ('', 'S/N', 's/n') and regexp_matches(fecha, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') group by 1, 2, 3 having count(*) > 1")
def key_violations(t: Tables) -> DataFrame:
    """Act keys that more than one record has; keys of no number or part of a date do not count."""
    valid = hashed(t).where("numero not in ('', 'S/N', 's/n')").where(dates.precision(F.col("fecha")) == "day")
    return dedup.violations(valid, ["comuna", "numero", "fecha"])


@query("w6_disambiguated", f"""
with k as (select record_id, numero, left(h, 4) as x, row_number() over (partition by comuna, numero, fecha order by record_id) as r from ({HASHED}) where numero is not null and h <> '')
select record_id, case when r = 1 then numero else numero || '-' || x end as label from k""")
def disambiguated(t: Tables) -> DataFrame:
    w = Window.partitionBy("comuna", "numero", "fecha").orderBy("record_id")
    rows = hashed(t).where("numero is not null and h is not null").withColumn("r", F.row_number().over(w))
    return rows.select("record_id", F.when(F.col("r") == 1, F.col("numero")).otherwise(F.concat_ws("-", "numero", F.substring("h", 1, 4))).alias("label"))


@query("w7_top_per_group", "select region_id, record_id, r::int as place from (select region_id, record_id, row_number() over (partition by region_id order by capturado_en desc, record_id) as r from providencia_records where region_id is not null) where r <= 6")
def top_per_group(t: Tables) -> DataFrame:
    w = Window.partitionBy("region_id").orderBy(F.desc("capturado_en"), "record_id")
    return t.providencia_records.where("region_id is not null").select("region_id", "record_id", F.row_number().over(w).alias("place")).where("place <= 6")


@query("w8_chronological_rank", "select comuna, last, dense_rank() over (order by last desc)::int as place from (select comuna, max(capturado_en) as last from providencia_records where comuna in (select comuna_nombre from communes_master) group by 1)")
def chronological_rank(t: Tables) -> DataFrame:
    """Ranks over the aggregate, one row for each name of the master list: what one task holds is bounded by that list."""
    names = t.communes_master.select(F.col("comuna_nombre").alias("comuna"))
    last = t.providencia_records.join(names, "comuna", "left_semi").groupBy("comuna").agg(F.max("capturado_en").alias("last"))
    return last.withColumn("place", F.dense_rank().over(Window.orderBy(F.desc("last"))))


@query("w8_chronological_rank_all", "select comuna, last, dense_rank() over (order by last desc)::int as place from (select comuna, max(capturado_en) as last from providencia_records where comuna is not null group by 1)")
def chronological_rank_all(t: Tables) -> DataFrame:
    """Ranks of every typed name. Distinct moments are ranked within ranges, and each range starts behind the sizes of those before it:
    no task holds them all, and the table of ranges has a row for each partition."""
    last = cut(t.providencia_records.where("comuna is not null").groupBy("comuna").agg(F.max("capturado_en").alias("last")), "last")
    ranges = cut(last.select("last").distinct().repartitionByRange(F.desc("last")).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("last")))
    places = ranges.withColumn("own", own).join(F.broadcast(before), "part").select(F.col("last").alias("moment"), (F.col("own") + F.col("before")).cast("int").alias("place"))
    return last.join(places, F.col("last").eqNullSafe(F.col("moment"))).select("comuna", "last", "place")


@query("w9_sequential_ids", "select 'PV-' || lpad(row_number() over (order by cplt_code)::varchar, 4, '0') as seq, cplt_code from organisms")
def sequential_ids(t: Tables) -> DataFrame:
    w = Window.orderBy("cplt_code")
    return t.organisms.select(F.format_string("PV-%04d", F.row_number().over(w)).alias("seq"), "cplt_code")


@query("w10_running_share", "select lote, n, round(sum(n) over (order by lote) / sum(n) over (), 6) as share from (select lote, count(*) as n from providencia_records group by 1)")
def running_share(t: Tables) -> DataFrame:
    n = t.providencia_records.groupBy("lote").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.round(F.sum("n").over(Window.orderBy("lote")) / F.sum("n").over(Window.partitionBy()), 6))


@query("w11_refetch_intervals", "select id, norma_uri, date_diff('day', lag(creado_en) over (partition by norma_uri order by creado_en, id)::date, creado_en::date)::int as days from ordenanzas")
def refetch_intervals(t: Tables) -> DataFrame:
    w = Window.partitionBy("norma_uri").orderBy("creado_en", "id")
    return t.ordenanzas.select("id", "norma_uri", F.date_diff(F.col("creado_en").cast("date"), F.lag("creado_en").over(w).cast("date")).alias("days"))


@query("k10_upsert_latest", "select norma_uri, id, estado from (select norma_uri, id, estado, row_number() over (partition by norma_uri order by creado_en desc, id desc) as r from ordenanzas) where r = 1")
def upsert_latest(t: Tables) -> DataFrame:
    """A log of fetches reduced to the latest row of each norm."""
    o = t.ordenanzas.select("norma_uri", "id", "estado", "creado_en")
    return dedup.keep_best(o, ["norma_uri"], F.desc("creado_en"), F.desc("id")).select("norma_uri", "id", "estado")


@query("o1_sorted_territories", "select row_number() over (order by n desc, comuna)::int as place, comuna, n from (select comuna, count(*) as n from providencia_records where comuna is not null group by 1) order by n desc, comuna limit 50")
def sorted_territories(t: Tables) -> DataFrame:
    """A top-k report: ordering and limit are one operator."""
    n = t.providencia_records.where("comuna is not null").groupBy("comuna").agg(F.count(F.lit(1)).alias("n"))
    top = n.orderBy(F.desc("n"), "comuna").limit(50)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "comuna"))).select("place", "comuna", "n")


@query("o3_scored_links", "select target_url, score from (select target_url, max(10 * regexp_matches(lower(target_url), 'documentos')::int + 5 * regexp_matches(lower(target_url), '\\.pdf')::int + 2 * regexp_matches(lower(target_url), 'firma')::int) as score from providencia_records where target_url is not null group by 1) order by score desc, target_url limit 15")
def scored_links(t: Tables) -> DataFrame:
    from edicta.functions import rules

    s = rules.score(F.lower("target_url"), [("documentos", 10), (r"\.pdf", 5), ("firma", 2)])
    g = t.providencia_records.where("target_url is not null").groupBy("target_url").agg(F.max(s).alias("score"))
    return g.orderBy(F.desc("score"), "target_url").limit(15)


@query("o4_capped_per_page", "select source_listing_url, record_id from (select source_listing_url, record_id, row_number() over (partition by source_listing_url order by record_id) as r from providencia_records where source_listing_url is not null) where r <= 20")
def capped_per_page(t: Tables) -> DataFrame:
    w = Window.partitionBy("source_listing_url").orderBy("record_id")
    p = t.providencia_records.where("source_listing_url is not null")
    return p.select("source_listing_url", "record_id", F.row_number().over(w).alias("r")).where("r <= 20").drop("r")


@query("o6_first_hits", "select id, titulo from ordenanzas where contains(strip_accents(lower(titulo)), 'ruidos') order by id limit 4")
def first_hits(t: Tables) -> DataFrame:
    from edicta.functions import text

    return t.ordenanzas.where(F.contains(text.fold(F.col("titulo")), F.lit("ruidos"))).select("id", "titulo").orderBy("id").limit(4)
