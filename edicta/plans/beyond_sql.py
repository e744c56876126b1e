"""Queries over all rows that the SQL of their namesakes leaves out, because DuckDB cannot fold or normalise them; fixtures test them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edicta.functions import text
from edicta.operators import matching
from edicta.plans import ingestion
from edicta.plans.registry import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[Tables], DataFrame]):
    QUERIES[f.__name__] = lambda spark, path: f(Tables(spark, path))
    return f


@query
def c10_act_kinds_all(t: Tables) -> DataFrame:
    """The kind of every act with a title, in whatever characters it is written."""
    return ingestion.kinds(t.providencia_records.where("titulo is not null"))


@query
def f9_cleaned_text_all(t: Tables) -> DataFrame:
    """The length of every text after the full cleaning."""
    return t.documents.where("text is not null").select("doc_id", F.length(text.cleaned(F.col("text"))).alias("n"))


@query
def f9_cleaned_texts(t: Tables) -> DataFrame:
    """Every text after the full cleaning."""
    return t.documents.where("text is not null").select("doc_id", text.cleaned(F.col("text")).alias("text"))


@query
def j8_best_ratio(t: Tables) -> DataFrame:
    """The territory that each typed name is, or is most like by the ratio of matching blocks, from 0.72 on."""
    typed = t.providencia_records.select(text.normalize_key(F.col("comuna")).alias("typed"))
    names = t.communes_master.select(text.normalize_key(F.col("comuna_nombre")).alias("name"))
    out = matching.best_ratio(typed, "typed", names, "name")
    return out.select("typed", "name", F.round("ratio", 6).alias("ratio"))
