"""Aggregations over the catalog: status, totals, zero-filled counts, pivots, roll-ups, histograms, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edicta.functions import dates, rule_sets
from edicta.plans import classifiers
from edicta.plans.registry import Tables, query

YEAR = "try_cast(nullif(regexp_extract({0}, '((?:19|20)[0-9]{{2}})', 1), '') as int)"


def acts(t: Tables) -> DataFrame:
    """Acts of both tables: (comuna, origin, fecha, year, titulo, area). The area is the declared one, else the axis of the title."""
    axis = rule_sets.first_list(F.lower("titulo"), rule_sets.AXES, rule_sets.DEFAULT_AXIS, True)
    p = t.providencia_records.select("comuna", F.lit("municipal").alias("origin"), "fecha", "titulo", F.coalesce(F.nullif("materia_id", F.lit("")), axis).alias("area"))
    o = t.ordenanzas.select(F.col("comuna_nombre").alias("comuna"), F.lit("national").alias("origin"), F.col("fecha_publicacion").alias("fecha"), "titulo", axis.alias("area"))
    return o.unionAll(p).withColumn("year", dates.year(F.col("fecha")))


_AXIS = rule_sets.first_list_sql("lower(titulo)", rule_sets.AXES, repr(rule_sets.DEFAULT_AXIS), True)
ACTS = f"""(select comuna_nombre as comuna, 'national' as origin, fecha_publicacion as fecha, titulo, {_AXIS} as area, {YEAR.format('fecha_publicacion')} as year from ordenanzas
 union all select comuna, 'municipal', fecha, titulo, coalesce(nullif(materia_id, ''), {_AXIS}), {YEAR.format('fecha')} from providencia_records)"""


@query("a1_territory_status", f"""
select m.comuna_nombre, m.region_id, count(a.comuna) as total, count(*) filter (a.origin = 'national') as national, count(*) filter (a.origin = 'municipal') as municipal,
  max(a.year) as last_year, case when count(*) filter (a.origin = 'municipal') > 0 and count(*) filter (a.origin = 'national') > 0 then 'both'
  when count(*) filter (a.origin = 'municipal') > 0 then 'municipal' when count(*) filter (a.origin = 'national') > 0 then 'national' else 'none' end as status
from communes_master m left join {ACTS} a on a.comuna = m.comuna_nombre group by all""")
def territory_status(t: Tables) -> DataFrame:
    """Conditional counts, latest year and a status for every territory of the master list, those without acts included."""
    counts = acts(t).groupBy("comuna").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("origin") == "national").alias("national"), F.count_if(F.col("origin") == "municipal").alias("municipal"), F.max("year").alias("last_year"))
    joined = t.communes_master.select("comuna_nombre", "region_id").join(counts, F.col("comuna") == F.col("comuna_nombre"), "left")
    n = {c: F.coalesce(c, F.lit(0)) for c in ("total", "national", "municipal")}
    status = F.when((n["municipal"] > 0) & (n["national"] > 0), "both").when(n["municipal"] > 0, "municipal").when(n["national"] > 0, "national").otherwise("none")
    return joined.select("comuna_nombre", "region_id", *(v.alias(k) for k, v in n.items()), "last_year", status.alias("status"))


@query("a2_totals", f"""
select count(*) as acts, count(distinct comuna) as typed_names, count(*) filter (origin = 'national') as national,
  round(100.0 * count(*) filter (origin = 'national') / count(*), 2) as national_pct, min(year) as first_year, max(year) as last_year from {ACTS}""")
def totals(t: Tables) -> DataFrame:
    a = acts(t).agg(F.count(F.lit(1)).alias("acts"), F.count_distinct("comuna").alias("typed_names"), F.count_if(F.col("origin") == "national").alias("national"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    return a.withColumn("national_pct", F.round(100.0 * F.col("national") / F.col("acts"), 2))


@query("a3_areas_zero_filled", f"select s.area_id, count(a.area) as acts from subject_areas s left join {ACTS} a on a.area = s.area_id group by 1")
def areas_zero_filled(t: Tables) -> DataFrame:
    counts = acts(t).groupBy("area").agg(F.count(F.lit(1)).alias("n"))
    return t.subject_areas.join(counts, F.col("area_id") == F.col("area"), "left").select("area_id", F.coalesce("n", F.lit(0)).alias("acts"))


@query("a4_source_breakdown", "select coalesce(nullif(fuente, ''), '(none)') as source, count(*) as acts from (select fuente from ordenanzas union all select fuente from providencia_records) group by 1")
def source_breakdown(t: Tables) -> DataFrame:
    rows = t.ordenanzas.select("fuente").unionAll(t.providencia_records.select("fuente"))
    return rows.groupBy(F.coalesce(F.nullif("fuente", F.lit("")), F.lit("(none)")).alias("source")).agg(F.count(F.lit(1)).alias("acts"))


@query("a5_recent_territories", f"""
with c as (select m.comuna_nombre, m.region_id, coalesce(bool_or(a.year between 2021 and 2026), false) as recent from communes_master m left join {ACTS} a on a.comuna = m.comuna_nombre group by 1, 2)
select region_id, count(*) as territories, count(*) filter (recent) as recent, count(*) filter (not recent) as stale from c group by 1""")
def recent_territories(t: Tables) -> DataFrame:
    """Two levels: whether a territory has any recent act, then counts by region."""
    flags = acts(t).groupBy("comuna").agg(F.bool_or(dates.recent(F.col("fecha"))).alias("recent"))
    per = t.communes_master.join(flags, F.col("comuna") == F.col("comuna_nombre"), "left").select("region_id", F.coalesce("recent", F.lit(False)).alias("recent"))
    return per.groupBy("region_id").agg(F.count(F.lit(1)).alias("territories"), F.count_if("recent").alias("recent"), F.count_if(~F.col("recent")).alias("stale"))


@query("a6_area_map", f"""
select comuna, string_agg(area || '=' || n, ',' order by area) as areas from (select comuna, area, count(*) as n from {ACTS} where comuna is not null and area is not null group by 1, 2) group by 1""")
def area_map(t: Tables) -> DataFrame:
    """A map area -> count for each typed name, here as text in the order of its keys."""
    n = acts(t).where("comuna is not null and area is not null").groupBy("comuna", "area").agg(F.count(F.lit(1)).alias("n"))
    maps = n.groupBy("comuna").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("area", "n")))).alias("m"))
    return maps.select("comuna", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("areas"))


AREAS = ["aseo_residuos", "comercio_publicidad", "convivencia_ruidos", "derechos_tarifas", "medio_ambiente", "obras_espacio_publico", "organizacion_participacion", "seguridad_prevencion", "transito_transporte"]


@query("a7_area_pivot", "select region_id, " + ", ".join(f"count(*) filter (materia_id = '{a}') as {a}" for a in AREAS) + " from providencia_records where region_id is not null group by 1")
def area_pivot(t: Tables) -> DataFrame:
    rows = t.providencia_records.where("region_id is not null").groupBy("region_id").pivot("materia_id", AREAS).count()
    return rows.na.fill(0)


@query("a8_reconciliation", f"""
with a as (select count(*) as n from {ACTS}), s as (select (select count(*) from ordenanzas) + (select count(*) from providencia_records) as n), d as (select sum(k)::bigint as n from (select count(*) as k from {ACTS} group by coalesce(comuna, '')))
select a.n as acts, s.n as rows_in, d.n as by_territory, a.n = s.n and s.n = d.n as reconciled from a, s, d""")
def reconciliation(t: Tables) -> DataFrame:
    """Three ways to the same total, compared: counted apart, stacked, and laid side by side by one aggregate."""
    ways = {
        "acts": acts(t).agg(F.count(F.lit(1)).alias("n")),
        "rows_in": t.ordenanzas.select(F.lit(1)).unionAll(t.providencia_records.select(F.lit(1))).agg(F.count(F.lit(1)).alias("n")),
        "by_territory": acts(t).groupBy("comuna").count().agg(F.sum("count").alias("n")),
    }
    stacked = None
    for name, df in ways.items():
        df = df.select(F.lit(name).alias("way"), "n")
        stacked = df if stacked is None else stacked.unionByName(df)
    one = stacked.agg(*(F.max(F.when(F.col("way") == w, F.col("n"))).alias(w) for w in ways))
    return one.withColumn("reconciled", (F.col("acts") == F.col("rows_in")) & (F.col("rows_in") == F.col("by_territory")))


@query("a9_last_year", f"select m.comuna_nombre, coalesce(max(a.year), 0) as last_year from communes_master m left join {ACTS} a on a.comuna = m.comuna_nombre group by 1")
def last_year(t: Tables) -> DataFrame:
    per = acts(t).groupBy("comuna").agg(F.max("year").alias("y"))
    return t.communes_master.join(per, F.col("comuna") == F.col("comuna_nombre"), "left").select("comuna_nombre", F.coalesce("y", F.lit(0)).alias("last_year"))


@query("a10_group_samples", """
select tabla_nombre, count(*) as acts, string_agg(record_id::varchar, ',' order by record_id) filter (r <= 3) as first_ids
from (select tabla_nombre, record_id, row_number() over (partition by tabla_nombre order by record_id) as r from providencia_records) group by 1""")
def group_samples(t: Tables) -> DataFrame:
    """Size of each group and its first three members. Ranks come from a group-limited window; only three rows a group are collected."""
    p = t.providencia_records.select("tabla_nombre", "record_id")
    w = Window.partitionBy("tabla_nombre").orderBy("record_id")
    top = p.withColumn("r", F.row_number().over(w)).where("r <= 3").groupBy("tabla_nombre").agg(F.array_join(F.transform(F.array_sort(F.collect_list("record_id")), lambda x: x.cast("string")), ",").alias("first_ids"))
    sizes = p.groupBy("tabla_nombre").agg(F.count(F.lit(1)).alias("acts"))
    return sizes.join(top, sizes.tabla_nombre.eqNullSafe(top.tabla_nombre)).select(sizes.tabla_nombre, "acts", "first_ids")


@query("a11_density_buckets", f"""
with n as (select m.comuna_nombre, count(a.comuna) as n from communes_master m left join {ACTS} a on a.comuna = m.comuna_nombre group by 1)
select case when n = 0 then '0' when n <= 3 then n::varchar when n <= 10 then '4-10' when n <= 100 then '11-100' else 'over 100' end as bucket, count(*) as territories from n group by 1""")
def density_buckets(t: Tables) -> DataFrame:
    n = territory_status(t).select(F.col("total").alias("n"))
    bucket = F.when(F.col("n") == 0, "0").when(F.col("n") <= 3, F.col("n").cast("string")).when(F.col("n") <= 10, "4-10").when(F.col("n") <= 100, "11-100").otherwise("over 100")
    return n.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("territories"))


@query("a12_area_shares", "select materia_id, count(*) as acts, round(100.0 * count(*) / sum(count(*)) over (), 1) as pct from providencia_records where materia_id is not null and materia_id <> '' group by 1")
def area_shares(t: Tables) -> DataFrame:
    n = t.providencia_records.where("materia_id is not null and materia_id <> ''").groupBy("materia_id").agg(F.count(F.lit(1)).alias("acts"))
    return n.withColumn("pct", F.round(100.0 * F.col("acts") / F.sum("acts").over(Window.partitionBy()), 1))


@query("a13_coverage", f"select m.region_nombre, m.comuna_nombre, count(a.comuna) as acts from communes_master m left join {ACTS} a on a.comuna = m.comuna_nombre group by 1, 2")
def coverage(t: Tables) -> DataFrame:
    n = acts(t).groupBy("comuna").agg(F.count(F.lit(1)).alias("n"))
    return t.communes_master.join(n, F.col("comuna") == F.col("comuna_nombre"), "left").select("region_nombre", "comuna_nombre", F.coalesce("n", F.lit(0)).alias("acts"))


SCORES = f"""(select m.comuna_nombre, m.region_id, count(distinct a.topic) as score, count(distinct a.topic) filter (a.year between 2021 and 2026) as recent_score,
 coalesce(string_agg(distinct a.topic, ', ' order by a.topic), '') as matched from communes_master m
 left join (select comuna, {YEAR.format('fecha')} as year, unnest(topics) as topic from {classifiers.BASKET_SQL}) a on a.comuna = m.comuna_nombre group by 1, 2)"""


@query("a14_topic_scores", f"select * from {SCORES}")
def topic_scores(t: Tables) -> DataFrame:
    """Distinct topics of the basket per territory, ever and recently, and which they are. Topics are reduced per territory before they
    are counted."""
    in_basket = classifiers.basket_acts(t).select("comuna", "fecha", F.explode("topics").alias("topic")).groupBy("comuna", "topic").agg(F.bool_or(dates.recent(F.col("fecha"))).alias("recent"))
    per = in_basket.groupBy("comuna").agg(F.count(F.lit(1)).alias("s"), F.count_if("recent").alias("r"), F.array_join(F.array_sort(F.collect_list("topic")), ", ").alias("matched"))
    return t.communes_master.join(per, F.col("comuna") == F.col("comuna_nombre"), "left").select("comuna_nombre", "region_id", F.coalesce("s", F.lit(0)).alias("score"), F.coalesce("r", F.lit(0)).alias("recent_score"), F.coalesce("matched", F.lit("")).alias("matched"))


@query("a15_score_histogram", f"""
select p.period, g.score, count(s.comuna_nombre) as territories, round(100.0 * count(s.comuna_nombre) / (select count(*) from communes_master), 1) as pct
from (values ('ever'), ('recent')) p(period) cross join (select range::bigint as score from range(0, 6)) g
left join (select 'ever' as period, comuna_nombre, score from {SCORES} union all select 'recent', comuna_nombre, recent_score from {SCORES}) s on s.period = p.period and s.score = g.score group by 1, 2""")
def score_histogram(t: Tables) -> DataFrame:
    """Zero-filled histogram of both scores, by unpivoting them."""
    scores = topic_scores(t).select("comuna_nombre", F.explode(F.create_map(F.lit("ever"), "score", F.lit("recent"), "recent_score")).alias("period", "score"))
    n = scores.groupBy("period", "score").agg(F.count(F.lit(1)).alias("n"))
    grid = t.spark.range(0, 6).select(F.col("id").alias("score"), F.explode(F.array(F.lit("ever"), F.lit("recent"))).alias("period"))
    out = grid.join(n, ["period", "score"], "left").select("period", "score", F.coalesce("n", F.lit(0)).alias("territories"))
    return out.withColumn("pct", F.round(100.0 * F.col("territories") / F.sum("territories").over(Window.partitionBy("period")), 1))


@query("a16_area_ranks", f"""
select area, count(*) as acts, count(distinct comuna) as territories, count(*) filter (year between 2021 and 2026) as recent, round(100.0 * count(*) filter (year between 2021 and 2026) / count(*), 1) as recent_pct, rank() over (order by count(*) desc) as place
from {ACTS} where area is not null group by 1""")
def area_ranks(t: Tables) -> DataFrame:
    n = acts(t).where("area is not null").groupBy("area").agg(F.count(F.lit(1)).alias("acts"), F.count_distinct("comuna").alias("territories"), F.count_if(dates.recent(F.col("fecha"))).alias("recent"))
    return n.withColumn("recent_pct", F.round(100.0 * F.col("recent") / F.col("acts"), 1)).withColumn("place", F.rank().over(Window.orderBy(F.desc("acts"))).cast("long"))


MACRO = [("norte", ["01", "02", "03", "04", "15"]), ("centro", ["05", "06", "07", "13", "16"]), ("sur", ["08", "09", "10", "14"]), ("austral", ["11", "12"])]
_MACRO_SQL = "case " + " ".join(f"when region_id in ({', '.join(repr(x) for x in ids)}) then '{z}'" for z, ids in MACRO) + " else 'otra' end"


def macro_zone(region: str = "region_id"):
    out = F.lit("otra")
    for zone, ids in reversed(MACRO):
        out = F.when(F.col(region).isin(ids), zone).otherwise(out)
    return out


@query("a17_macro_rollup", f"select {_MACRO_SQL} as macro, count(*) as territories, round(avg(score), 4) as mean_score, count(*) filter (score = 5) as complete, count(*) filter (score = 0) as none from {SCORES} group by 1")
def macro_rollup(t: Tables) -> DataFrame:
    return topic_scores(t).groupBy(macro_zone().alias("macro")).agg(F.count(F.lit(1)).alias("territories"), F.round(F.avg("score"), 4).alias("mean_score"), F.count_if(F.col("score") == 5).alias("complete"), F.count_if(F.col("score") == 0).alias("none"))


@query("a17_zone_histograms", f"""
select macro, g.score, count(s.comuna_nombre) as territories, count(s.comuna_nombre) filter (contains(matched, 'mascotas')) as mascotas, count(s.comuna_nombre) filter (contains(matched, 'participacion')) as participacion
from (select distinct {_MACRO_SQL} as macro from communes_master) m cross join (select range::bigint as score from range(0, 6)) g left join (select *, {_MACRO_SQL} as zone from {SCORES}) s on s.zone = m.macro and s.score = g.score group by 1, 2""")
def zone_histograms(t: Tables) -> DataFrame:
    """Territories by score in each zone, zero-filled, and how many of them have two of the topics."""
    scores = topic_scores(t).withColumn("macro", macro_zone())
    n = scores.groupBy("macro", "score").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.contains("matched", F.lit("mascotas"))).alias("a"), F.count_if(F.contains("matched", F.lit("participacion"))).alias("b"))
    grid = t.communes_master.select(macro_zone().alias("macro")).distinct().withColumn("score", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))))
    out = grid.join(n, ["macro", "score"], "left")
    return out.select("macro", "score", *(F.coalesce(c, F.lit(0)).alias(k) for k, c in (("territories", "n"), ("mascotas", "a"), ("participacion", "b"))))


@query("a18_region_rollup", f"select region_id, count(*) as territories, round(avg(score), 4) as mean_score, round(sum(score)::double / (count(*) * 5), 4) as fulfilment from {SCORES} group by 1")
def region_rollup(t: Tables) -> DataFrame:
    return topic_scores(t).groupBy("region_id").agg(F.count(F.lit(1)).alias("territories"), F.round(F.avg("score"), 4).alias("mean_score"), F.round(F.sum("score") / (F.count(F.lit(1)) * 5), 4).alias("fulfilment"))


@query("a19_grouping_sets", f"""
select macro, region_id, count(*) as territories, sum(score)::bigint as points from (select *, {_MACRO_SQL} as macro from {SCORES}) group by grouping sets ((macro, region_id), (macro), ())""")
def grouping_sets(t: Tables) -> DataFrame:
    """Nation, macro-zone and region in one pass."""
    rows = topic_scores(t).withColumn("macro", macro_zone())
    return rows.groupingSets([["macro", "region_id"], ["macro"], []], "macro", "region_id").agg(F.count(F.lit(1)).alias("territories"), F.sum("score").alias("points"))


@query("a20_first_example", "select materia_id, min(record_id) as record_id, arg_min(titulo, record_id) as titulo from providencia_records where materia_id is not null and titulo is not null group by 1")
def first_example(t: Tables) -> DataFrame:
    return t.providencia_records.where("materia_id is not null and titulo is not null").groupBy("materia_id").agg(F.min("record_id").alias("record_id"), F.min_by("titulo", "record_id").alias("titulo"))


GAPS = [("no_number", "numero is null or trim(numero) in ('', 'S/N', 's/n')"), ("no_date", "fecha is null or fecha in ('', 'S/F')"), ("no_commune", "comuna is null"), ("no_code", "cplt_code is null"), ("not_verified", "verification.status is null or verification.status <> 'verified'"), ("no_hash", "verification.sha256 is null or length(verification.sha256) <> 64")]


@query("a21_gap_histogram", "select gap, count(*) as records from (" + " union all ".join(f"select '{g}' as gap from providencia_records where {p}" for g, p in GAPS) + ") group by 1")
def gap_histogram(t: Tables) -> DataFrame:
    """Each record's gaps as an array, exploded: one pass over the table for all of them."""
    gaps = F.array_compact(F.array(*(F.when(F.expr(p), g) for g, p in GAPS)))
    return t.providencia_records.select(F.explode(gaps).alias("gap")).groupBy("gap").agg(F.count(F.lit(1)).alias("records"))


@query("a22_nested_flags", """
with a as (select cplt_code, list(verification.status order by record_id) as st, list(coalesce(verification.bytes, 0)) as b from providencia_records where cplt_code is not null group by 1)
select cplt_code, len(st) as documents, len(list_filter(st, lambda x: x = 'verified')) > 0 as any_verified, len(list_filter(st, lambda x: x is null or x <> 'verified')) = 0 as all_verified, list_sum(b)::bigint as bytes from a""")
def nested_flags(t: Tables) -> DataFrame:
    """exists, forall and aggregate over the documents of an organism; flags and sums are combined before the shuffle."""
    ok = F.coalesce(F.col("verification.status") == "verified", F.lit(False))
    p = t.providencia_records.where("cplt_code is not null")
    # one small array per partial group, then higher-order functions over the nested value
    per = p.groupBy("cplt_code", ok.alias("ok")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("verification.bytes", F.lit(0))).alias("b"))
    docs = per.groupBy("cplt_code").agg(F.collect_list(F.struct("ok", "n", "b")).alias("d"))
    total = lambda f: F.aggregate("d", F.lit(0).cast("long"), lambda a, x: a + x[f])
    return docs.select("cplt_code", total("n").alias("documents"), F.exists("d", lambda x: x["ok"]).alias("any_verified"), F.forall("d", lambda x: x["ok"]).alias("all_verified"), total("b").alias("bytes"))


@query("a23_state_counters", "select verification.status as status, verification.content_type as content_type, count(*) as n, count(*) filter (verification.http_status >= 400) as failed from providencia_records group by 1, 2")
def state_counters(t: Tables) -> DataFrame:
    v = t.providencia_records.select("verification.*")
    return v.groupBy("status", "content_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("http_status") >= 400).alias("failed"))


@query("a24_distinct_hashes", "select tipo_acto, count(*) as documents, count(distinct nullif(verification.sha256, '')) as hashes from providencia_records group by 1")
def distinct_hashes(t: Tables) -> DataFrame:
    return t.providencia_records.groupBy("tipo_acto").agg(F.count(F.lit(1)).alias("documents"), F.count_distinct(F.nullif("verification.sha256", F.lit(""))).alias("hashes"))


@query("a25_batch_profile", "select lote, count(*) as n, count(distinct comuna) as territories, count(distinct verification.sha256) as hashes, max(record_id) - min(record_id) + 1 = count(*) as contiguous from providencia_records group by 1")
def batch_profile(t: Tables) -> DataFrame:
    g = t.providencia_records.groupBy("lote").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("comuna").alias("territories"), F.count_distinct("verification.sha256").alias("hashes"), F.min("record_id").alias("a"), F.max("record_id").alias("b"))
    return g.withColumn("contiguous", F.col("b") - F.col("a") + 1 == F.col("n")).drop("a", "b")


@query("a26_coverage_status", """
select o.cplt_code, count(p.record_id) as acts, count(*) filter (p.verification.status = 'verified') as verified,
  case when count(p.record_id) = 0 then 'unregistered' when count(*) filter (p.verification.status = 'verified') = count(p.record_id) then 'complete' else 'partial' end as coverage
from organisms o left join providencia_records p on p.cplt_code = o.cplt_code group by 1""")
def coverage_status(t: Tables) -> DataFrame:
    per = t.providencia_records.groupBy(F.col("cplt_code").alias("code")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("verification.status") == "verified").alias("v"))
    out = t.organisms.join(per, F.col("code") == F.col("cplt_code"), "left").select("cplt_code", F.coalesce("n", F.lit(0)).alias("acts"), F.coalesce("v", F.lit(0)).alias("verified"))
    return out.withColumn("coverage", F.when(F.col("acts") == 0, "unregistered").when(F.col("acts") == F.col("verified"), "complete").otherwise("partial"))


@query("a27_shared_sets", """
with s as (select verification.sha256 as h, string_agg(distinct region_id, ',' order by region_id) as regions from providencia_records where length(verification.sha256) = 64 and region_id is not null group by 1 having count(*) > 1)
select regions, count(*) as hashes from s group by 1""")
def shared_sets(t: Tables) -> DataFrame:
    """How often a set of regions shares a file. The set of a hash is bounded by the regions there are."""
    s = t.providencia_records.where("length(verification.sha256) = 64 and region_id is not null").groupBy("verification.sha256").agg(F.array_join(F.array_sort(F.collect_set("region_id")), ",").alias("regions"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return s.groupBy("regions").agg(F.count(F.lit(1)).alias("hashes"))


@query("a28_value_counts", "select categoria_carpeta, count(*) as n, count(distinct tabla_id) as tables from providencia_records group by 1")
def value_counts(t: Tables) -> DataFrame:
    return t.providencia_records.groupBy("categoria_carpeta").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("tabla_id").alias("tables"))


ALIASES = [("aseo", "aseo_residuos"), ("transito", "transito_transporte"), ("comercio_alcoholes", "comercio_publicidad"), ("mascotas", "medio_ambiente"), ("mascotas_tenencia", "medio_ambiente"), ("participacion_ciudadana", "organizacion_participacion")]


@query("a29_alias_groups", "select coalesce(a.area, materia_id) as area, count(*) as n from providencia_records p left join (values " + ", ".join(f"('{x}', '{y}')" for x, y in ALIASES) + ") a(alias, area) on a.alias = p.materia_id where p.materia_id is not null and p.materia_id <> '' group by 1")
def alias_groups(t: Tables) -> DataFrame:
    """Counts over groups of names that mean one area; the alias table is a constant of six rows."""
    alias = t.spark.createDataFrame(ALIASES, "alias string, area string")
    p = t.providencia_records.where("materia_id is not null and materia_id <> ''").join(F.broadcast(alias), F.col("alias") == F.col("materia_id"), "left")
    return p.groupBy(F.coalesce("area", "materia_id").alias("area")).agg(F.count(F.lit(1)).alias("n"))


@query("a30_change_counters", r"select count(*) filter (trim(numero) <> numero) as padded, count(*) filter (regexp_matches(numero, '^0+[0-9]')) as zeros, count(*) filter (regexp_replace(target_url, '^http://', 'https://') <> target_url) as http from providencia_records")
def change_counters(t: Tables) -> DataFrame:
    """What cleaning would change, counted in one pass."""
    p = t.providencia_records
    return p.agg(F.count_if(F.trim("numero") != F.col("numero")).alias("padded"), F.count_if(F.col("numero").rlike("^0+[0-9]")).alias("zeros"), F.count_if(F.regexp_replace("target_url", "^http://", "https://") != F.col("target_url")).alias("http"))


@query("a31_year_spans", f"select fuente, min(y)::varchar || '-' || max(y)::varchar as span from (select fuente, {YEAR.format('fecha')} as y from providencia_records) where y is not null group by 1")
def year_spans(t: Tables) -> DataFrame:
    y = t.providencia_records.select("fuente", dates.year(F.col("fecha")).alias("y")).where("y is not null")
    return y.groupBy("fuente").agg(F.concat(F.min("y").cast("string"), F.lit("-"), F.max("y").cast("string")).alias("span"))


@query("a32_presence_matrix", "select region_id, " + ", ".join(f"bool_or(coalesce(materia_id = '{a}', false)) as has_{a}" for a in AREAS[:6]) + " from providencia_records where region_id is not null group by 1")
def presence_matrix(t: Tables) -> DataFrame:
    return t.providencia_records.where("region_id is not null").groupBy("region_id").agg(*(F.bool_or(F.coalesce(F.col("materia_id") == a, F.lit(False))).alias(f"has_{a}") for a in AREAS[:6]))


@query("a33_diagnosis_shares", """
with d as (select case when verification.status is null then 'unknown' when verification.status = 'verified' then 'verified' when verification.http_status >= 500 then 'server' when verification.http_status >= 400 then 'client' when verification.status = 'timeout' then 'timeout' else 'other' end as diagnosis from providencia_records)
select diagnosis, count(*) as n, round(count(*) / sum(count(*)) over (), 4) as share from d group by 1""")
def diagnosis_shares(t: Tables) -> DataFrame:
    v = t.providencia_records.select("verification.*")
    d = F.when(F.col("status").isNull(), "unknown").when(F.col("status") == "verified", "verified").when(F.col("http_status") >= 500, "server").when(F.col("http_status") >= 400, "client").when(F.col("status") == "timeout", "timeout").otherwise("other")
    n = v.groupBy(d.alias("diagnosis")).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 4))
