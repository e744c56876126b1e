"""Text cut off by field limits (problem 10).

Per source, the discrete hazard of each text length (texts that end there over texts at least as long) is compared with the hazard of
its neighbourhood by window functions; a Chernoff bound of the Poisson tail gives the p-value, and lengths are significant under
Benjamini-Hochberg control. Texts at significant lengths are flagged where their ending is incomplete; at other lengths (transfers that
broke off) where the ending is certainly broken: a damaged character, half an escape or tag, a mark of continuation after running
text, or running text that stops inside a sentence. `at_limit` tells the two classes apart.

Whether a last line without a stop is running text is learnt from the whole corpus: of all lines that open with the same words, the
share that ends without a stop. Signatures, tables, references and greetings never end with one; running text nearly always does.

Defined cases: null, empty and blank texts are never truncated; repeated documents each come out; an empty table gives no rows; a
source without a significant length is still searched for broken endings; the length is counted in characters of the raw text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edicta.session import cut

#: Neighbouring lengths on either side, rate of false discoveries.
REACH, FDR = 40, 0.001
#: Marks that say the text goes on elsewhere (fixed values).
CONTINUES = r"(?:\[(?:…|\.\.\.)\]|\((?:…|\.\.\.)\)|\((?:leer|ver|seguir leyendo|read) ?(?:m[aá]s|more)?\)|\[(?:leer|ver|read) (?:m[aá]s|more)\]|(?:leer|ver|read) (?:m[aá]s|more)|\(?(?:sigue|contin[uú]a)\)?|…|\.\.\.|>>|»)$"
CONTINUES_MOST = 24  # characters of the longest of them
BROKEN = r"(?:�|\\u?[0-9a-fA-F]{0,3}|\\x[0-9a-fA-F]?|<[/\w]*|<\w+ [^<>]*|&#?\w{0,7}|%[0-9A-F]?)$"
#: Marks that close what a stop ends, those that may stand at the end themselves, and stops (fixed values).
CLOSING, CLOSED, STOPS = "\"'»”)]", ")»”\"]", ".!?"
HEADING = r"(?i)(?:^|[\s(])(?:art[ií]culo|art|t[ií]tulo|letra|inciso|n[°º]|nro|sr|sra|dr|dra|av|avda|inc|pág|p)\.? ?\d*(?:°\.-|[.°:]+)$|[$] ?\d{1,3}\.$|\.-$"
#: Signs that may follow a finished text.
ORNAMENT = r"[\s\x{200D}\x{FE0F}\x{2190}-\x{21FF}\x{2460}-\x{27BF}\x{2B00}-\x{2BFF}\x{1F000}-\x{1FAFF}*_]+$"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, ORNAMENT, "")


def _ends_with(c: Column, signs: str) -> Column:
    return F.instr(F.lit(signs), F.right(c, F.lit(1))) * F.length(c) > 0


def stops(line: Column) -> Column:
    """Whether a line ends with a stop, with or without closing marks behind it, or with a closing mark."""
    return _ends_with(line, CLOSED) | _ends_with(F.rtrim(line, F.lit(CLOSING)), STOPS)


def first_words(line: Column) -> Column:
    """The first three words of a line as they stand."""
    return F.regexp_extract(F.substring(F.ltrim(line), 1, 80), r"^\S+(?: +\S+){0,2}", 0)


def opening(words: Column) -> Column:
    """First words in one form: digits as 0, names as X."""
    head = F.regexp_replace(words, r"\d+(?:[.,/-]\d+)*", "0")
    head = F.regexp_replace(head, r"^\p{Lu}[\p{L}]+(?=,)", "X")
    return F.regexp_replace(head, r"(?<=\s)\p{Lu}[\p{L}]*", "X")


def significant_lengths(df: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, length, n, expected, p): the lengths at which more texts of a source end than its neighbouring lengths let expect."""
    # exact copies of a text count once: they share its length without any limit
    texts = df.where(F.trim(F.col(text)) != "").select(F.col(source).alias("source"), F.length(text).alias("length"), F.xxhash64(text).alias("h")).distinct()
    lengths = texts.groupBy("source", "length").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("source").orderBy("length")
    near = by.rangeBetween(-REACH, REACH)
    tested = (
        lengths.withColumn("at_risk", F.sum("n").over(Window.partitionBy("source").orderBy(F.desc("length"))))
        .withColumn("ended", F.sum("n").over(near) - F.col("n"))
        .withColumn("first", F.max("at_risk").over(near))
        # neighbouring lengths without texts count as well, each at risk with the texts longer than it
        .withColumn("expected", (F.col("ended") + 1) / (2.0 * REACH) * (F.col("at_risk") / F.col("first")))
        .withColumn("p", F.when(F.col("n") > F.col("expected"), F.exp(-(F.col("n") * F.log(F.col("n") / F.col("expected")) - F.col("n") + F.col("expected")))).otherwise(1.0))
    )
    tested = cut(tested.select("source", "length", "n", "expected", "p"), "hazards")
    m = tested.count()
    # the largest k of which k tests have p <= FDR * k / m, come down to from above: no ranks, hence no task that holds all tests
    k = m
    while (passing := tested.where(F.col("p") <= F.lit(FDR * k / max(m, 1))).count()) < k:
        k = passing
    return tested.where(F.col("p") <= F.lit(FDR * k / max(m, 1)))


def opening_shares(df: DataFrame, text: str = "text") -> DataFrame:
    """(opening, lines, unstopped): over all lines of the corpus, how often lines that open so end without a stop. Lines are counted by
    their first words as they stand; only the distinct ones are brought to one form."""
    lines = df.where(F.col(text).isNotNull()).select(F.explode(F.split(F.col(text), "\n")).alias("line")).where("trim(line) != ''")
    raw = lines.groupBy(first_words(F.col("line")).alias("words")).agg(F.count(F.lit(1)).alias("lines"), F.count_if(~stops(F.rtrim("line"))).alias("unstopped"))
    return raw.groupBy(opening(F.col("words")).alias("opening")).agg(F.sum("lines").alias("lines"), F.sum("unstopped").alias("unstopped"))


def truncated(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(id, source, length, at_limit, ending) of the documents whose text was cut; ending: damaged, continued, or open."""
    spikes = significant_lengths(df, source, text).select("source", "length", F.lit(True).alias("at_limit"))
    docs = df.where(F.trim(F.col(text)) != "").select(F.col(doc_id).alias("id"), F.col(source).alias("source"), F.length(text).alias("length"), F.rtrim(F.substring_index(stripped(F.substring_index(F.rtrim(F.col(text), F.lit(" \n\t\r")), "\n", -4)), "\n", -1)).alias("last"))
    docs = cut(docs, "endings")
    before = F.rtrim(F.regexp_replace("last", CONTINUES, ""))
    # each pattern is tried where a sign that it needs is there
    ending = (
        F.when(F.col("last").rlike(r"[�\\<&%]") & F.col("last").rlike(BROKEN), "damaged")
        .when(F.right("last", F.lit(CONTINUES_MOST)).rlike(CONTINUES) & ~before.rlike(r"[.!?:]$") & (F.length(before) > 0), "continued")
        .when(_ends_with(F.col("last"), ".°:-") & F.col("last").rlike(HEADING), "heading")
        .when(~stops(F.col("last")), "open")
    )
    docs = docs.withColumn("ending", ending).where("ending is not null")
    docs = docs.join(spikes, (docs.source.eqNullSafe(spikes.source)) & (docs.length == spikes.length), "left").select(docs["*"], F.coalesce("at_limit", F.lit(False)).alias("at_limit"))
    docs = docs.withColumn("opening", opening(first_words(F.col("last")))).withColumn("form", F.regexp_replace(F.regexp_replace("last", r"\d+(?:[.,/-]\d+)*", "0"), r"\p{Lu}\p{L}+", "X"))
    docs = cut(docs, "unfinished")
    forms = docs.where("ending = 'open' and not at_limit").groupBy("form").agg(F.count(F.lit(1)).alias("same"))
    shares = cut(opening_shares(df, text), "openings")
    first = F.regexp_extract("opening", r"^\S+", 0)
    wider = shares.groupBy(first.alias("first")).agg(F.sum("lines").alias("lines1"), F.sum("unstopped").alias("unstopped1"))
    docs = docs.withColumn("first", first).join(shares, "opening", "left").join(wider, "first", "left").join(forms, "form", "left")
    # an opening seen on few lines is judged by its first word, a first word seen on few lines by the look of the line
    running = (
        F.when(F.col("lines") >= 8, F.col("unstopped") < 0.5 * F.col("lines"))
        .when(F.col("lines1") >= 3, F.col("unstopped1") < 0.5 * F.col("lines1"))
        .otherwise(F.col("last").rlike(r"(?:\p{Ll}[\p{Ll},]*\s+){6}"))
    )
    # at a limit, a line of its own kind (signature, table) is whole only in a form that other texts end with
    keep = (
        F.col("ending").isin("damaged", "continued")
        | (F.col("ending") == "heading") & (F.col("at_limit") | F.col("last").rlike(r"(?i)^art[ií]culo \d+"))
        | (F.col("ending") == "open") & (running | F.col("at_limit") & (F.coalesce("same", F.lit(0)) < 1))
    )
    return docs.where(keep).select("id", "source", "length", "at_limit", "ending")


def rates(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Per source: documents with text, truncated ones, those at a significant length, and the rate."""
    cut = truncated(df, doc_id, source, text).groupBy("source").agg(F.count(F.lit(1)).alias("truncated"), F.count_if("at_limit").alias("at_limit"))
    all_ = df.where(F.trim(F.col(text)) != "").groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("documents"))
    out = all_.join(cut, all_.source.eqNullSafe(cut.source), "left").select(all_.source, "documents", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("truncated", "at_limit")))
    return out.withColumn("rate", F.col("truncated") / F.col("documents"))
