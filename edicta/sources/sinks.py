"""Writers. Tables of any size are written by the executors; only single-row results become driver-side files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def envelope(df: DataFrame, order: str, limit: int = 100_000) -> DataFrame:
    """One row with the JSON envelope (count, records) of a small result, such as an aggregate; the job fails for over `limit` rows,
    of which no more than one beyond the limit are brought together."""
    few = df.limit(limit + 1)
    one = few.agg(F.struct(F.count(F.lit(1)).alias("count"), F.array_sort(F.collect_list(F.struct(order, *(c for c in df.columns if c != order)))).alias("records")).alias("e"))
    fits = F.assert_true(F.col("e.count") <= limit, F.lit(f"over {limit} rows: write tables as files"))
    return one.withColumn("_fits", fits).where("_fits is null").select(F.to_json("e").alias("value"))


def assigned_js(json: Column, name: str) -> Column:
    return F.concat(F.lit(f"window.{name} = "), json, F.lit(";"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV parts with a header each."""
    df.write.mode("overwrite").csv(path, header=True, escape='"', encoding="UTF-8")


def write_small_csv(df: DataFrame, path: str, limit: int = 100_000) -> int:
    """One local CSV file with a byte-order mark, for spreadsheet programs; refuses tables of over `limit` rows."""
    rows = df.limit(limit + 1).toPandas()
    if len(rows) > limit:
        raise ValueError(f"over {limit} rows: use write_csv")
    rows.to_csv(path, index=False, encoding="utf-8-sig")
    return len(rows)


def markdown(head: dict[str, Column], body: Column) -> Column:
    """Text of a document: a head between lines of dashes, values quoted, and the body."""
    quoted = [F.concat(F.lit(f'{k}: "'), F.replace(F.coalesce(v.cast("string"), F.lit("")), F.lit('"'), F.lit('\\"')), F.lit('"\n')) for k, v in head.items()]
    return F.concat(F.lit("---\n"), *quoted, F.lit("---\n\n"), F.coalesce(body, F.lit("")))


def write_partitioned_text(df: DataFrame, text: str, by: list[str], path: str) -> None:
    """Text files in folders by the given columns."""
    df.select(text, *by).write.mode("overwrite").partitionBy(*by).text(path)


def table_lines(columns: list[str]) -> Column:
    """A row as a line of a Markdown table."""
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in columns)), F.lit(" |"))


def replaced_element(html: Column, element_id: str, new: Column) -> Column:
    """html with the text of the element of an id replaced."""
    before = F.regexp_extract(html, rf"""(?s)^(.*?<[^>]*\bid=["']{element_id}["'][^>]*>)""", 1)
    after = F.regexp_extract(html, rf"""(?s)^.*?<[^>]*\bid=["']{element_id}["'][^>]*>[^<]*(.*)$""", 1)
    return F.when(before == "", html).otherwise(F.concat(before, new, after))
