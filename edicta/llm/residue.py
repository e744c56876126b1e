"""Template residue and error-page text (problem 1).

Titles are brought to one spelling, numbers, dates and addresses are masked, and equal masked texts are grouped by hash over all
sources. Each distinct masked text is classified once. Placeholders are residue wherever they stand, filler and the phrases of messages
where they are what a title says, without the wrapping that pages put around a message. Recurrence decides on the rest: a text that
recurs over sources and is no act is judged by its words, each weighed by how often it occurs in messages that the rules know and in
acts; what no act says in such words is a message, whether a phrase rule knows it or not. A recurring message stands for its misspelt
forms as well: texts within a few letters of it, found by the segments that two near texts must share.

`kind` tells how a text was found (placeholder, message, filler, recurring, misspelt), `times` how often it occurs, `sources` over how
many sources: what occurs once is known by rule alone.

Defined cases: null and blank titles are no residue; a title that merely mentions such things is none; the longest titles are
classified whole; repeated rows each come out; other columns are kept out of the way; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edicta.functions.text import fold
from edicta.session import cut

#: Names of fields that templates hold (fixed values: the columns of the catalog and their usual shorter names).
FIELDS = "titulo|titulo_doc|nombre|nombre_acto|nombre_archivo|denominacion|denominacion_acto|tipo|tipo_acto|materia|submateria|fecha|fecha_publicidad|fecha_publicacion|numero|num|nro|sector|comuna|municipalidad|region|descripcion|texto|contenido|autor|url|enlace|anio|ano|dia|mes|id|title|name|date|number|description|content|field|value"
#: What a placeholder looks like, over folded text.
PLACEHOLDERS = [
    r"\{\{[^{}]*\}\}", r"\$\{[^{}]*\}", r"\{%[^{}]*%\}", r"<\?(=|php)?[^>]*\?>", r"<%=?[^>]*%>", r"\[\[[^\]]*\]\]",
    rf"<(?:{FIELDS}|[a-z]+_[a-z_]+)>", rf"\{{(?:{FIELDS}|[a-z]+_[a-z_]+)\}}", rf"%(?:{FIELDS}|[a-z]+_[a-z_]+)%", rf"#(?:{FIELDS}|[a-z]+_[a-z_]+)#",
    rf"__(?:{FIELDS}|[a-z]+_[a-z_]+)__", rf"@@(?:{FIELDS}|[a-z]+_[a-z_]+)\b", r"_{4,}", r"\bx{4,}\b", r"\bxx[-/.]xx[-/.]\w{2,4}\b", r"\bdd[-/.]mm[-/.]a{2,4}\b",
    r"[\[(<](?:por |sin )?(?:completar|definir|rellenar|llenar|insertar|ingresar|indicar|escribir|agregar|nombre d|titulo d|numero d|fecha d|materia\b|texto aqui|\.\.\.)[^\])>]*[\])>]",
    r"\[\.\.\.\]", r"\.{5,}", r"&(?:nbsp|amp|quot|lt|gt);",
]
#: Messages of systems and filler, over the folded, masked core of a title (digits are 0).
PHRASES = [
    r"(?:error )?(?:http )?(?:status )?0 ?[-:–·]? ?(?:not found|forbidden|bad gateway|bad request|unauthorized|internal server error|service unavailable|gateway time-?out)",
    r"error(?: http)?(?: status)? 0(?: ?[-:–·.] ?(?:ref\b.*|pagina no encontrada|not found|el servidor no pudo .*|no encontrado|acceso denegado|.*servidor.*))?",
    r"http (?:status|error) 0.*", r"¡?ups!?.* no encontramos .*", r"(?:la )?pagina (?:solicitada |que busca )?(?:no existe|no (?:fue |ha sido )?encontrada|no esta disponible).*",
    r"(?:el )?archivo (?:que intenta descargar|solicitado) .*", r"no se puede (?:acceder|mostrar|abrir|conectar).*(?:sitio|pagina|servidor|recurso).*", r"servicio (?:temporalmente )?no disponible.*",
    r"tiempo de espera agotado.*", r".*gateway time-?out.*", r"acceso denegado.*", r"usted no tiene permisos? .*", r"su sesion ha (?:expirado|caducado).*", r"sesion (?:expirada|caducada|finalizada).*", r"(?:inicie|debe iniciar) sesion.*",
    r"fatal error:? .*", r"warning:? undefined .*", r"notice:? undefined .*", r"parse error:? .*", r"sqlstate ?\[.*", r"object reference not set .*", r"uncaught (?:exception|error|typeerror).*", r"(?:java|python|system)\.[a-z.]+(?:exception|error).*", r"stack trace.*", r"ora-0.*",
    r"(?:please )?(?:you need to )?enable (?:javascript|scripts|js|cookies)\b.*", r"(?:debe |favor |por favor,? )?(?:habilit(?:ar|e)|activ(?:ar|e)) (?:javascript|los scripts|scripts|js|cookies)\b.*", r"este sitio (?:web )?(?:requiere|necesita|utiliza) (?:javascript|scripts|cookies).*", r"para visualizar correctamente .*",
    r"javascript (?:esta|se encuentra|is|must be|debe) .*", r"su navegador no (?:soporta|admite|permite) .*", r"necesitamos verificar su navegador.*", r"(?:just a moment|checking your browser|verifying you are human).*", r"this (?:site|page|app) requires javascript.*",
    r"lorem ipsum.*", r".*\blorem ipsum\b.*", r"(?:asdf|qwerty|asd|qwe)(?: (?:asdf|qwerty|asd|qwe))*", r"(.)\1{5,}", r"(?:prueba|test)(?: (?:prueba|test))*(?: 0)*", r"test carga .*", r"(?:texto|titulo|documento|registro|acto) de (?:prueba|ejemplo)(?:,.*|: .*)?", r"(?:esto es una|es una) prueba.*",
    r"titulo del? documento(?: 0)?", r"(?:nuevo )?documento sin titulo.*", r"sin titulo(?: 0)?", r"untitled.*", r"escrib[ae] aqui .*", r"ingres[ae] (?:la |el |una |un )?(?:descripcion|titulo|texto|nombre)\b.*", r"haga clic (?:para|aqui) .*", r"click (?:here|to add) .*", r"insert[ae] (?:aqui|titulo|texto).*",
    r"\[?object object\]?", r"(?:undefined|null|none|nan)(?:(?: n° ?| ?- ?|: ?| ?/ ?| )(?:undefined|null|none|nan))*", r"#(?:¡?(?:ref|valor|value|nombre|name|div/0|nulo|null|num)!?\??|n/a|n/d|na)", r"[.\-_*#?\s]{5,}", r"(?:dolor|lorem|ipsum|tempor|amet|consectetur|adipiscing|sit)(?: (?:dolor|lorem|ipsum|tempor|sit|amet|consectetur|adipiscing|elit|sed|nulla|pharetra|do|eiusmod|ut|labore|et|magna|aliqua|incididunt))+",
]
#: Words of filler text (fixed values). Three of them in a row, or most of a text's words, are filler.
FILLER = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat "
    "duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt culpa officia deserunt mollit anim laborum pharetra tincidunt vestibulum vitae pellentesque "
    "donec curabitur mauris fusce aenean integer ultrices volutpat egestas ullamcorper laoreet aliquam erat faucibus ornare suspendisse interdum posuere maecenas vivamus phasellus nunc eget justo lectus sapien turpis viverra "
    "bibendum cursus dapibus dignissim etiam euismod facilisis feugiat fringilla gravida hendrerit iaculis imperdiet lacinia ligula lobortis luctus mattis mollis morbi neque nibh odio placerat porttitor praesent pretium proin "
    "pulvinar purus quisque rhoncus risus rutrum sagittis scelerisque semper sodales sollicitudin tellus tortor tristique varius vehicula venenatis vulputate"
).split()
#: What pages put before and after a message.
LEADING = r"^(?:(?:titulo|aviso|nota|atencion|mensaje|importante) ?: |\* ?|\[0\] ?|(?:ordenanzas|inicio|actos|documentos|portal) ?[»>|] ?|(?:ordenanza|decreto|resolucion|reglamento)(?: municipal| exento| exenta| alcaldicio)?(?: ?n?[°o.] ?(?:0|s/n))? ?[-:,.] )"
TRAILING = r"(?: ?\| ?[^|]*| ?[-–] ?(?:municipalidad|portal[^|]*|ordenanzas|inicio|actos)| ?\(0\)| ?[·|-] ?ref\.? ?[0-9a-f]+| ?\.\.\.| ?…|[!.,;: ]+)$"
#: Openings of acts: whatever follows, the text is an act and is not compared with messages.
ACT = r"\b(?:aprueba|regula|dicta|fija|establece|complementa|actualiza|modifica|deroga|reemplaza|autoriza|otorga|declara|designa|rectifica|deja sin efecto|subvencion|nombra|delega|crea|prorroga)\b"
#: A text recurs if it occurs so often over so many sources.
MIN_TIMES, MIN_SOURCES = 3, 2
#: Layers of wrapping on either side of a message that are taken off.
LAYERS = 3
#: Kinds of acts: what is headed by one, or holds one with its number, is an act.
HEADED = r"^(?:ordenanza|decreto|resolucion|reglamento|acuerdo|bases|convenio|contrato|plan|concurso|nomina|acta)\b"
#: Words of so many letters or more are weighed; rates under RARE hardly count; a recurring text is a message from LEAST_WEIGHT on.
WORD_LETTERS, RARE, LEAST_WEIGHT = 4, 1e-3, -0.1
MOST_EDITS = 2


#: Only texts with such signs can hold a placeholder or filler; other texts that open as an act are none.
SIGNS = r"[{}<>\[\]%#@$_&|\\?]|x{4}|xx[-/.]|dd[-/.]mm|\.{4}|\((?:por |sin )?(?:completar|definir|rellenar|llenar|insertar|ingresar|indicar|escribir|agregar|nombre|titulo|numero|fecha|materia|texto|\.)|ipsum|dolor|amet"


def masked(folded: Column) -> Column:
    """A folded title with addresses, dates and numbers as @, and 0."""
    c = F.when(F.instr(folded, "@") + F.instr(folded, "://") + F.instr(folded, "www.") > 0, F.regexp_replace(folded, r"https?://\S+|www\.\S+|\S+@\S+\.\w+", "@")).otherwise(folded)
    c = F.regexp_replace(c, r"\b\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}\b", "0")
    return F.regexp_replace(c, r"\d+(?:[.,]\d+)*", "0")


def core(text: Column) -> Column:
    """The masked text without LAYERS layers of wrapping on either side."""
    for _ in range(LAYERS):
        text = F.regexp_replace(F.regexp_replace(text, LEADING, ""), TRAILING, "")
    return F.trim(text)


def grouped(rows: DataFrame) -> DataFrame:
    """(hash, text, times, sources): the distinct masked texts over all sources. rows: text, source."""
    return rows.where("text is not null and text != ''").groupBy(F.md5("text").alias("hash")).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("times"), F.approx_count_distinct("source", 0.1).alias("sources"))


def classified(texts: DataFrame) -> DataFrame:
    """The texts that are not plain acts, with `kind`: placeholder, message, filler, or null."""
    texts = texts.where(~F.col("text").rlike(ACT) | F.col("text").rlike(SIGNS)).withColumn("core", core(F.col("text")))
    word = "|".join(FILLER)
    filler = rf"\b(?:{word})(?: (?:{word})){{2,}}\b"
    words = F.split("core", " ")
    hits = F.size(F.filter(words, lambda w: w.isin(FILLER)))
    kind = (
        F.when(F.col("text").rlike("|".join(PLACEHOLDERS)), "placeholder")
        .when(F.col("core").rlike("^(?:" + "|".join(p for p in PHRASES if "\\1" not in p) + ")$"), "message")
        .when(F.col("core").rlike(r"^(.)\1{5,}$") | F.col("text").rlike(filler) | (hits >= 3) & (hits >= 0.6 * F.size(words)), "filler")
    )
    return texts.withColumn("kind", kind)


def _words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, "[^a-zñ]+"), lambda w: F.length(w) >= WORD_LETTERS))


def recurring(texts: DataFrame, known: DataFrame) -> DataFrame:
    """known with kind 'recurring' for texts that recur over sources and say what messages say, not what acts say. A word's weight is the
    log of the rate at which the messages of the rules have it, less that at which acts have it, and a text weighs the mean of its words:
    one in words of its own, that acts do not use, comes out as a message. texts: all distinct texts, with times and sources."""
    act = F.col("text").rlike(ACT) | F.col("text").rlike(HEADED)
    open_ = F.col("kind").isNull() & (F.col("times") >= MIN_TIMES) & (F.col("sources") >= MIN_SOURCES) & ~F.col("core").rlike(ACT) & ~F.col("core").rlike(HEADED)
    asked = cut(known.where(open_).select("hash", F.explode(_words(F.col("core"))).alias("word")), "asked")
    if asked.isEmpty():
        return known
    wanted = asked.select("word").distinct()
    seen = lambda rows, name: rows.select(F.explode(_words(F.col("text"))).alias("word")).join(wanted, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias(name))
    acts_, messages = texts.where(act), known.where("kind = 'message'").select(F.col("core").alias("text"))
    n_acts, n_messages = acts_.count(), messages.count()
    rate = lambda name, n: F.log(F.coalesce(name, F.lit(0)) / max(n, 1) + max(RARE, 1 / (n_acts + 1)))
    weighed = asked.join(seen(acts_, "acts"), "word", "left").join(seen(messages, "messages"), "word", "left")
    said = weighed.groupBy("hash").agg(F.avg(rate("messages", n_messages) - rate("acts", n_acts)).alias("weight")).where(F.col("weight") >= LEAST_WEIGHT)
    return known.join(said.select("hash", F.lit("recurring").alias("_kind")), "hash", "left").withColumn("kind", F.coalesce("kind", "_kind")).drop("_kind")


def _segments(c: Column) -> Column:
    """The MOST_EDITS + 1 segments of a text, each a struct (n: length of the text, i, start, part)."""
    n, k = F.length(c), MOST_EDITS + 1
    at = lambda i: F.floor(n * i / k).cast("int")
    return F.array(*(F.struct(n.alias("n"), F.lit(i).alias("i"), F.substring(c, at(i) + 1, at(i + 1) - at(i)).alias("part")) for i in range(k)))


def with_misspelt(known: DataFrame) -> DataFrame:
    """known with kind 'misspelt' for texts that are no acts and differ by at most MOST_EDITS letters (one below eight) from a recurring
    message, or from a recurring placeholder that is all there is. Of a message's three segments two edits leave one whole, moved by two
    places at most; texts and messages meet by an equality join on it, whatever their number, and are verified by the distance."""
    recurs = known.where(F.col("kind").isin("message", "placeholder", "recurring") & ~F.col("core").rlike(ACT) & (F.col("times") >= MIN_TIMES) & (F.col("sources") >= MIN_SOURCES))
    recurs = recurs.select(F.explode(F.array_distinct(F.array("core", "text"))).alias("m")).where(F.length("m") >= 5).distinct()
    messages = recurs.select("m", F.explode(_segments(F.col("m"))).alias("s")).select("m", "s.*")
    open_ = known.where(F.col("kind").isNull() & ~F.col("core").rlike(ACT) & (F.length("core") >= 5 - MOST_EDITS))
    size, k = F.length("core"), MOST_EDITS + 1
    start = lambda n, i: F.floor(n * i / k).cast("int")
    lengths = F.sequence(F.greatest(size - MOST_EDITS, F.lit(1)), size + MOST_EDITS)
    shifts = F.sequence(F.lit(-MOST_EDITS), F.lit(MOST_EDITS))

    def windows(i: int) -> Column:
        part = lambda n, d: F.struct(n.alias("n"), F.lit(i).alias("i"), F.substring("core", start(n, i) + d + 1, start(n, i + 1) - start(n, i)).alias("part"))
        return F.flatten(F.transform(lengths, lambda n: F.transform(shifts, lambda d: F.when(start(n, i) + d >= 0, part(n, d)))))

    probes = open_.select("hash", "core", F.explode(F.array_distinct(F.array_compact(F.concat(*map(windows, range(k)))))).alias("s")).select("hash", "core", "s.*")
    near = probes.join(messages, ["n", "i", "part"]).where(F.levenshtein("core", "m") <= F.least(F.lit(MOST_EDITS), F.floor(F.length("m") / 8).cast("int") + 1)).select("hash").distinct()
    return known.join(near.withColumn("_m", F.lit(True)), "hash", "left").withColumn("kind", F.coalesce("kind", F.when(F.col("_m"), "misspelt"))).drop("_m")


def residue(df: DataFrame, id_col: str, title_col: str, source: Column, folded: bool = False) -> DataFrame:
    """(id, kind, times, sources) of the records whose title is or contains residue. folded: the titles were folded before."""
    title = F.col(title_col) if folded else fold(F.col(title_col))
    rows = cut(df.select(F.col(id_col).alias("id"), masked(title).alias("text"), F.xxhash64(source).alias("source")), "masked")
    texts = cut(grouped(rows), "texts")
    known = cut(recurring(texts, cut(classified(texts), "rules")), "residue")
    found = with_misspelt(known).where("kind is not null").select("hash", "kind", "times", "sources")
    return rows.select("id", F.md5("text").alias("hash")).where("hash is not null").join(found, "hash").select("id", "kind", "times", "sources")


def without_residue(df: DataFrame, id_col: str, title_col: str, source: Column) -> DataFrame:
    """df without those records."""
    found = residue(df, id_col, title_col, source).select(F.col("id").alias("_id"))
    return df.join(found, F.col(id_col) == F.col("_id"), "left_anti")
