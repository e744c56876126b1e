"""Readers of the catalog's formats. Text formats are parsed from columns, so that they work on files and tables alike; each `read_*`
reads a path. Malformed content gives nulls or no rows, never a failed job, except where a contract is asked for."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CELLS = "array<array<struct<text:string,href:string>>>"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header, UTF-8 with or without a byte-order mark; all values as the schema says."""
    return spark.read.csv(path, header=True, schema=schema, encoding="UTF-8", enforceSchema=True, multiLine=True, escape='"')


def read_default(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    """What is at path, or an empty table of the schema where nothing is."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(path)


def envelopes(text: Column, record: str) -> Column:
    """struct(count, records) of a JSON envelope."""
    return F.from_json(text, f"count bigint, records array<{record}>")


def checked_records(df: DataFrame, envelope: str) -> DataFrame:
    """The records of envelopes, one a row; an envelope whose count is not that of its records fails the job."""
    e = F.col(envelope)
    sound = F.assert_true(e["count"] == F.size(e["records"]), F.lit("the declared count differs from the records"))
    return df.withColumn("_ok", sound).where("_ok is null").select(F.explode(e["records"]).alias("r")).select("r.*")


def unwrapped_js(text: Column) -> Column:
    """The JSON of a script that assigns it to a name."""
    return F.regexp_replace(F.regexp_replace(text, r"^\s*(?:window\.|var |const |let )?[\w.$]+\s*=\s*", ""), r";?\s*$", "")


def bindings(text: Column, names: list[str]) -> Column:
    """array<struct> of the values of a query result in SPARQL JSON."""
    one = ", ".join(f"`{n}`: struct<value: string>" for n in names)
    rows = F.from_json(text, f"results struct<bindings: array<struct<{one}>>>")["results"]["bindings"]
    return F.transform(rows, lambda b: F.struct(*(b[n]["value"].alias(n) for n in names)))


def front_matter(text: Column) -> Column:
    """map<string, string> of the head between two lines of dashes; quoted values are unescaped."""
    head = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---", 1)
    keys = F.regexp_extract_all(head, F.lit(r"(?m)^(\w+): (.*)$"), F.lit(1))
    values = F.transform(F.regexp_extract_all(head, F.lit(r"(?m)^(\w+): (.*)$"), F.lit(2)), lambda v: F.when(v.rlike('^".*"$'), F.replace(F.regexp_replace(v, '^"|"$', ""), F.lit('\\"'), F.lit('"'))).otherwise(v))
    return F.map_from_arrays(keys, values)


def body(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\A---\n.*?\n---\n*", "")


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(path, meta, body) of every Markdown file below path."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    return files.select(F.col("_metadata.file_path").alias("path"), front_matter(F.col("value")).alias("meta"), body(F.col("value")).alias("body"))


def read_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, bytes) of the files below path that begin as PDF does, whatever their name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    pdf = files.where(F.substring("content", 1, 5) == F.encode(F.lit("%PDF-"), "US-ASCII"))
    return pdf.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def anchors(html: Column) -> Column:
    """array<struct<href, text>> of the quoted links of a page; tags inside the text are dropped."""
    p = F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>""")
    clean = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]*>", " "), r"\s+", " "))
    return F.arrays_zip(F.regexp_extract_all(html, p, F.lit(1)).alias("href"), F.transform(F.regexp_extract_all(html, p, F.lit(2)), clean).alias("text"))


def frames(html: Column) -> Column:
    """Addresses of iframe, embed and object."""
    return F.regexp_extract_all(html, F.lit(r"""(?is)<(?:iframe|embed|object)\b[^>]*?\b(?:src|data)\s*=\s*["']([^"']*)["']"""), F.lit(1))


def sitemap(xml: Column) -> Column:
    return F.transform(F.regexp_extract_all(xml, F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1)), lambda x: F.replace(x, F.lit("&amp;"), F.lit("&")))


def options(html: Column) -> Column:
    """array<struct<code, name>> of the options of a select."""
    p = F.lit(r"""(?is)<option\b[^>]*?\bvalue\s*=\s*["']([^"']*)["'][^>]*>(.*?)</option>""")
    return F.arrays_zip(F.regexp_extract_all(html, p, F.lit(1)).alias("code"), F.transform(F.regexp_extract_all(html, p, F.lit(2)), lambda x: F.trim(x)).alias("name"))


def strip_tags(html: Column) -> Column:
    """Text of a page: tags as spaces, the common entities undone, white space collapsed."""
    c = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " "), "<[^>]*>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def urls_in(text: Column) -> Column:
    """Addresses mentioned in a text, each once, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"""(https?://[^\s"'<>\]\)}\\]+)"""), F.lit(1)), lambda x: F.regexp_replace(x, r"[.,;]+$", "")))


class _Tables(HTMLParser):
    """Rows of table cells with their text and first link; unclosed cells and rows are closed by what follows."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[list]] = []
        self.row: list[list] | None = None
        self.cell: list | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self._end_row()
            self.row = []
        elif tag in ("td", "th"):
            self._end_cell()
            if self.row is None:
                self.row = []
            self.cell = ["", None]
        elif tag == "a" and self.cell is not None and self.cell[1] is None:
            self.cell[1] = dict(attrs).get("href")

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self._end_cell()
        elif tag in ("tr", "table"):
            self._end_row()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell[0] += data

    def _end_cell(self):
        if self.cell is not None:
            self.row.append({"text": " ".join(self.cell[0].split()), "href": self.cell[1]})
            self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row:
            self.rows.append(self.row)
        self.row = None


def table_rows(html: Column) -> Column:
    """Rows of cells of all tables of a page, by a tolerant parser: what patterns cannot express goes through Arrow batches."""

    @F.pandas_udf(CELLS)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(text):
            if text is None:
                return None
            p = _Tables()
            p.feed(text)
            p.close()
            p._end_row()
            return p.rows

        for s in batches:
            yield s.map(one)

    return parse(html)


def with_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """df with exactly the columns of a schema: missing ones null, others dropped."""
    return df.select(*(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def element_text(html: Column, element_id: str) -> Column:
    """Text right inside the element of an id; null where there is none."""
    p = rf"""(?s)<[^>]*\bid=["']{element_id}["'][^>]*>([^<]*)"""
    return F.when(html.rlike(p), F.regexp_extract(html, p, 1))
