"""The queries of the training-data problems over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def host(col: str):
    return F.lower(F.regexp_extract(F.col(col), r"^[a-zA-Z]+://([^/:]+)", 1))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.residue import residue

    rows = table(spark, sf_dir, "providencia_records").select("record_id", "titulo", "source_listing_url")
    return residue(rows, "record_id", "titulo", host("source_listing_url")).select(F.col("id").alias("record_id"))


def p1_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog without the records of p1_found."""
    from edicta.llm.residue import without_residue

    rows = table(spark, sf_dir, "providencia_records").select("record_id", "titulo", "comuna", "source_listing_url")
    return without_residue(rows, "record_id", "titulo", host("source_listing_url")).select("record_id", "titulo", "comuna")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.lookalikes import rewrite

    rows = table(spark, sf_dir, "providencia_records").select("record_id", "titulo", "descripcion")
    return rewrite(rows, "record_id", ["titulo", "descripcion"]).select(F.col("id").alias("record_id"), "field")


def p6_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with both fields in one consistent form and the names of the changed fields."""
    from edicta.llm.lookalikes import unified

    rows = table(spark, sf_dir, "providencia_records").select("record_id", "titulo", "descripcion")
    return unified(rows, "record_id", ["titulo", "descripcion"])


def commune_names(spark: SparkSession, sf_dir: str):
    from edicta.llm.canonical import reference_counts

    typed = [(table(spark, sf_dir, "ordenanzas"), "comuna_nombre"), (table(spark, sf_dir, "providencia_records"), "comuna")]
    return reference_counts(table(spark, sf_dir, "communes_master"), "comuna_nombre", *typed)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.canonical import not_exact, resolve_column

    names = commune_names(spark, sf_dir)
    rows = table(spark, sf_dir, "ordenanzas").select(F.col("id").alias("row_key"), F.col("comuna_nombre").alias("typed"))
    rows = rows.unionAll(table(spark, sf_dir, "providencia_records").select("record_id", "comuna"))
    return resolve_column(not_exact(rows, "typed", names), "typed", names).select("row_key", F.col("canonical").alias("comuna_nombre"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.encoding import encode

    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"))


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by whether their ids decode to their text."""
    from edicta.llm.encoding import decode

    texts = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    back = decode(p8_ids(spark, sf_dir)).select(F.col("doc_id").alias("d"), F.col("text").alias("back"))
    same = F.coalesce("back", F.lit("")) == F.col("text")
    return texts.join(back, texts.doc_id == back.d, "left").groupBy(same.alias("same")).agg(F.count(F.lit(1)).alias("documents"))


def sized_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens) of the documents with text."""
    from edicta.llm.encoding import token_counts
    from edicta.session import cut

    docs = table(spark, sf_dir, "documents")
    counts = token_counts(docs.select("doc_id", "text"))
    return cut(docs.select("doc_id", "source").join(counts, "doc_id"), "sized")


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.mixture import mixture

    return mixture(sized_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.mixture import shares

    return shares(sized_documents(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.truncation import truncated

    return truncated(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(F.col("id").alias("doc_id"))


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.truncation import rates

    return rates(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.scan_noise import noise

    return noise(table(spark, sf_dir, "ordenanzas"), "id", "texto_completo")


def p2_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as continuous readable paragraphs."""
    from edicta.llm.scan_noise import repaired

    return repaired(table(spark, sf_dir, "ordenanzas"), "id", "texto_completo")


def subject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, title folded, place folded, declared) of both tables, without the records of p1_found."""
    from edicta.functions.text import fold
    from edicta.llm.residue import residue
    from edicta.session import cut

    empty = F.array().cast("array<string>")
    a = table(spark, sf_dir, "ordenanzas").select(F.col("id").alias("key"), fold(F.col("titulo")).alias("title"), fold(F.col("comuna_nombre")).alias("place"), F.coalesce(F.filter(F.split("materia", " / "), lambda x: x != ""), empty).alias("declared"))
    b = table(spark, sf_dir, "providencia_records").select(F.col("record_id").alias("key"), fold(F.col("titulo")).alias("title"), fold(F.col("comuna")).alias("place"), F.array_compact(F.array(F.coalesce(F.nullif(F.col("materia_id"), F.lit("")), F.nullif(F.col("materia"), F.lit(""))))).alias("declared"), host("source_listing_url").alias("source"))
    b = cut(b, "titles")
    found = residue(b, "key", "title", F.col("source"), folded=True).select(F.col("id").alias("key"))
    return a.unionByName(b.drop("source").join(found, "key", "left_anti"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.subjects import subjects

    areas = table(spark, sf_dir, "subject_areas").select(F.col("area_id").alias("area"))
    return subjects(subject_rows(spark, sf_dir), areas).select(F.col("key").alias("row_key"), F.col("area").alias("area_id"))


def p3_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by subject area; a document of several areas counts in each."""
    return p3_found(spark, sf_dir).groupBy("area_id").agg(F.count(F.lit(1)).alias("documents"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.incremental import duplicates

    rows = table(spark, sf_dir, "providencia_records").select("record_id", "lote", "comuna", "numero", "fecha", "fecha_publicidad", "titulo", F.col("verification.sha256").alias("sha256"), "target_url")
    return duplicates(rows, "lote", commune_names(spark, sf_dir))


def act_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edicta.llm.linkage import attributes, linked
    from edicta.session import cut

    names = commune_names(spark, sf_dir)
    left = attributes(table(spark, sf_dir, "ordenanzas"), "id", "comuna_nombre", "numero", "titulo", ["fecha_publicacion"], names)
    right = attributes(table(spark, sf_dir, "providencia_records"), "record_id", "comuna", "numero", "titulo", ["fecha", "fecha_publicidad"], names)
    return linked(cut(left, "left"), cut(right, "right"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return act_pairs(spark, sf_dir).select("id", F.col("rid").alias("record_id"))


def p5_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs with their confidence."""
    return act_pairs(spark, sf_dir).select("id", F.col("rid").alias("record_id"), F.round("confidence", 6).alias("confidence"))


QUERIES = {f.__name__: f for f in (p1_found, p1_catalog, p2_found, p2_repaired, p3_found, p3_composition, p4_found, p5_found, p5_confidence, p6_found, p6_unified, p7_found, p8_ids, p8_decoded, p9_mixture, p9_shares, p10_found, p10_rates)}
ORACLE: dict[str, str] = {}
