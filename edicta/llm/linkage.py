"""Matching entities across sources without keys (problem 5): probabilistic record linkage of acts.

Both tables get the same partial attributes (commune, number, date, subject of the title). Several blocking passes propose pairs; each
pair is described by agreement levels; the levels' counts (at most some thousand patterns, whatever the size of the data) feed the
estimates, and the posterior of a pattern is the confidence of its pairs.

Chance agreements grow with the square of the rows of a commune, acts with their number, so that no estimate holds for all communes: the
date is taken together with the crowd, the size class of the commune. Pairs with equal numbers are judged by expectation-maximisation.
Pairs without a number have met by their titles, so that titles say no more of them than that; they are judged by what their dates have
beyond chance, of which the days behind the longest delay of a publication are the measure.

Defined cases: a missing attribute is a level of its own; rows fetched or captured more than once give one pair each; known numbers
that differ exclude a pair; null titles and titles that only name kind, number and place are 'absent'; empty tables give no pairs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edicta.functions.text import fold
from edicta.llm import acts
from edicta.llm.canonical import Names

#: Words of titles that place or join, without bearing on the subject.
LINKS = "en|el|sector|y|e|incluye|sobre|la|los|las|de|del"
LEVELS = {"number": ("equal", "missing", "differ"), "date": ("near", "year", "missing", "conflict"), "title": ("same", "close", "absent", "differ"), "commune": ("equal", "missing")}
#: Where EM starts: probabilities of each level among matches and among the other pairs of the blocks.
START_M = {"number": (0.85, 0.14, 0.01), "date": (0.70, 0.15, 0.10, 0.05), "title": (0.70, 0.10, 0.18, 0.02), "commune": (0.95, 0.05)}
START_U = {"number": (0.10, 0.10, 0.80), "date": (0.05, 0.25, 0.10, 0.60), "title": (0.15, 0.10, 0.15, 0.60), "commune": (0.90, 0.10)}
MOST_DAYS, THRESHOLD = 75, 0.5
#: First days of the classes of lags between near dates, the last ending at MOST_DAYS, and days behind it that measure chance.
LAGS, CHANCE_DAYS = (-2 * MOST_DAYS, -105, 0, 15, 45), 15
#: Pairs that the starting values weigh as much as, where titles of non-matches are counted.
ANCHOR = 10
#: What a pattern is.
FIELDS = ("number", "date", "lag", "late", "crowd", "title", "commune", "figures")


def subject_key(folded: Column) -> Column:
    words = F.regexp_replace(acts.subject(folded), "[^a-z0-9]+", " ")
    return F.coalesce(F.trim(F.regexp_replace(F.concat(F.lit(" "), words, F.lit(" ")), rf" (?:(?:{LINKS}) )+", " ")), F.lit(""))


def attributes(df: DataFrame, id_col: str, commune: str, num: str, title: str, dates: list[str], counts: Names) -> DataFrame:
    """(id, commune, num, day, month, year, late, s): dates are tried in order until one has a year; late: it was not the first."""
    rows = acts.with_commune(df.select(F.col(id_col).alias("id"), F.col(commune).alias("typed"), F.col(num).alias("n"), F.col(title).alias("t"), *(F.col(d).alias(f"d{i}") for i, d in enumerate(dates))), "typed", counts)
    tried = [acts.date_parts(F.col(f"d{i}")) for i in range(len(dates))]
    parts = F.coalesce(*(F.when(d.getField("year").isNotNull(), d) for d in tried))
    rows = rows.select("id", "typed", "commune", acts.number(F.col("n")).alias("n"), fold(F.col("t")).alias("t"), parts.alias("d"), F.coalesce(tried[0].getField("year").isNull(), F.lit(True)).alias("late"))
    s = subject_key(F.col("t"))
    place = F.trim(F.regexp_replace(F.regexp_replace(fold(F.col("typed")), "[^a-z0-9]+", " "), rf"\b(?:{LINKS}) ", ""))
    bare = lambda c: F.trim(F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", " "), rf"\b(?:{LINKS}) ", ""))
    named = (F.length(s) < 6) | (s == place) | (s == bare(F.col("commune"))) | (F.levenshtein(s, place, 3) >= 0) & (F.length(place) > 8)
    own = acts.title_number(F.col("t"))
    return rows.select("id", "commune", F.coalesce("n", own).alias("num"), F.col("d.day").alias("day"), F.col("d.month").alias("month"), F.col("d.year").alias("year"), "late", F.when(F.coalesce(named, F.length(s) < 6), F.lit("")).otherwise(s).alias("s"))


def _blocks(left: bool) -> Column:
    """Keys of the passes. A publication early in the year also meets acts of the year before, on either side: compared() lets the left
    date follow by MOST_DAYS, and precede by twice as many days where the right date is late, by two where not. The sharp key is
    commune, number and year; the others serve pairs where one side lacks a year, a number or the commune."""
    month = F.substring(F.coalesce("month", F.lit("-01")), -2, 2)
    early = month <= "03" if left else F.when(F.col("late"), month <= "05").otherwise(F.coalesce(F.substring("day", -5, 5) <= "01-02", F.lit(False)))
    years = F.when(early, F.array("year", F.col("year") - 1)).otherwise(F.array("year"))
    text = F.when(F.length("s") >= 12, F.col("s"))
    sharp = F.transform(years, lambda y: acts.block("n", F.col("commune"), F.col("num"), y))
    no_num = F.col("num").isNull()
    keys = [*acts.one_sided("y", F.col("year").isNull(), left, "commune", "num"), *acts.one_sided("d", no_num, left, "commune", "day"), *acts.one_sided("t", F.col("commune").isNull(), left, "num", text)]
    ends = []
    for kind, part in (("a", F.substring(text, 1, 10)), ("z", F.substring(text, -10, 10))):
        ends += [_yearly(years, kind, part, no_num, left, k) for k in (0, 1)]
    return F.array_distinct(F.array_compact(F.concat(sharp, F.array(*keys), *ends)))


def _yearly(years: Column, kind: str, part: Column, missing: Column, left: bool, k: int) -> Column:
    return F.transform(years, lambda y: acts.one_sided(kind, missing, left, F.col("commune"), y, part)[k])


def pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(id, rid): the distinct pairs of the passes. Numbers that are known and differ are dropped before anything is verified."""
    a = left.select("id", "num", F.explode(_blocks(True)).alias("k"))
    b = right.select(F.col("id").alias("rid"), F.col("num").alias("rnum"), F.explode(_blocks(False)).alias("k"))
    return a.join(b, "k").where("num is null or rnum is null or num = rnum").select("id", "rid").distinct()


def compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """(id, rid, number, date, title, commune, figures, lag, late, crowd): agreement levels of the proposed pairs. lag: class of near dates
    in LAGS, -1 for dates of the CHANCE_DAYS; late: of the right row; crowd: class of the number of right rows of the commune."""
    b = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    both = pairs(left, right).join(left, "id").join(b, F.col("rid") == F.col("r_id"))
    days = F.datediff(F.col("day").try_cast("date"), F.col("r_day").try_cast("date"))
    precise = days.isNotNull() & ~F.coalesce(F.col("r_day").endswith("-01-01"), F.lit(False)) & ~F.coalesce(F.col("day").endswith("-01-01"), F.lit(False))
    gap = F.col("year") - F.col("r_year")
    date = (
        F.when(gap.isNull(), "missing")
        .when(precise, F.when(days.between(F.when(F.col("r_late"), -2 * MOST_DAYS).otherwise(-2), MOST_DAYS), "near").otherwise("conflict"))
        .when((gap == 0) | (gap == 1) & (F.substring(F.coalesce("month", F.lit("-01")), -2, 2) <= "03"), "year")
        .otherwise("conflict")
    )
    longest = F.greatest(F.length("s"), F.length("r_s"))
    # a misspelt opening stays before the subject: the shorter text is also compared with the end of the longer one
    n = F.least(F.length("s"), F.length("r_s"))
    ends = F.levenshtein(F.expr("right(s, least(length(s), length(r_s)))"), F.expr("right(r_s, least(length(s), length(r_s)))"))
    unlike = F.least(F.levenshtein("s", "r_s") / longest, F.when((n >= 14) & (longest - n <= 45), ends / n))
    title = F.when((F.col("s") == "") | (F.col("r_s") == ""), "absent").when(unlike <= 0.1, "same").when(unlike <= 0.25, "close").otherwise("differ")
    number = F.when(F.col("num").isNull() | F.col("r_num").isNull(), "missing").when(F.col("num") == F.col("r_num"), "equal").otherwise("differ")
    commune = F.when(F.col("commune").isNull() | F.col("r_commune").isNull(), "missing").when(F.col("commune") == F.col("r_commune"), "equal").otherwise("differ")
    figures = F.regexp_replace("s", "[^0-9]+", " ") == F.regexp_replace("r_s", "[^0-9]+", " ")
    lag = F.when(date == "near", sum((days >= d).cast("int") for d in LAGS) - 1).when(precise & days.between(MOST_DAYS + 1, MOST_DAYS + CHANCE_DAYS), -1)
    crowds = right.where("commune is not null").groupBy(F.col("commune").alias("_c")).agg(F.floor(F.log2(F.count(F.lit(1)).cast("double")) / 2).cast("int").alias("crowd"))
    both = both.select("id", "rid", number.alias("number"), date.alias("date"), title.alias("title"), commune.alias("commune"), figures.alias("figures"), lag.alias("lag"), F.col("r_late").alias("late"), F.coalesce("commune", "r_commune").alias("_c")).where("commune != 'differ' and number != 'differ'")
    return both.join(crowds, "_c", "left").drop("_c").fillna(-1, ["crowd"])


def estimate(patterns: list[tuple[dict[str, str], int]], rounds: int = 40, anchored: bool = False) -> tuple[float, dict, dict]:
    """EM over pattern counts: share of matches, and the level probabilities of matches and non-matches. A level may be parted into
    classes ('near/3'), which start with equal parts of its probability. anchored (dates are 'date/lag/late/crowd'): the titles of
    non-matches are those of pairs whose dates conflict, those of matches what near dates have beyond chance, and stay; else a class that
    is larger than that of the matches can take its place."""
    seen = {f: sorted({*LEVELS[f], *(p[f] for p, _ in patterns)} - {p[f].split("/")[0] for p, _ in patterns if "/" in p[f]}) for f in LEVELS}

    def start(table: dict) -> dict:
        of = {f: dict(zip(LEVELS[f], table[f], strict=True)) for f in LEVELS}
        return {f: {x: of[f][x.split("/")[0]] / sum(y.split("/")[0] == x.split("/")[0] for y in xs) for x in xs} for f, xs in seen.items()}

    m, u = start(START_M), start(START_U)
    if anchored:
        by = {(p["date"], p["title"]): n for p, n in patterns}
        apart, beyond = dict.fromkeys(seen["title"], 0.0), dict.fromkeys(seen["title"], 0.0)
        for (d, t), n in by.items():
            date, lag, late, crowd = d.split("/")
            if date == "conflict":
                apart[t] += n
            elif date == "near":
                beyond[t] += n
            if lag == "-1":  # as many are expected a day where dates are near
                beyond[t] -= n / CHANCE_DAYS * sum(_days(x, late == "1") for x in range(len(LAGS)))
        for table, counted in ((u, apart), (m, {t: max(n, 0) for t, n in beyond.items()})):
            table["title"] = {t: (counted[t] + ANCHOR * v) / (sum(counted.values()) + ANCHOR) for t, v in table["title"].items()}
    share, total = 0.3, sum(n for _, n in patterns) or 1
    for _ in range(rounds):
        weight = [posterior(p, share, m, u) for p, _ in patterns]
        mass = sum(w * n for w, (_, n) in zip(weight, patterns, strict=True))
        for table, part in ((m, lambda w: w), (u, lambda w: 1 - w)):
            whole = sum(part(w) * n for w, (_, n) in zip(weight, patterns, strict=True))
            for f, levels in seen.items():
                if anchored and f == "title":
                    continue
                for level in levels:  # a half count each: a level that was not seen stays possible
                    times = sum(part(w) * n for w, (p, n) in zip(weight, patterns, strict=True) if p[f] == level)
                    table[f][level] = (times + 0.5) / (whole + 0.5 * len(levels))
        share = min(max(mass / total, 1e-6), 1 - 1e-6)
    return share, m, u


def posterior(pattern: dict[str, str], share: float, m: dict, u: dict) -> float:
    odds = math.log(share / (1 - share)) + sum(math.log(m[f][pattern[f]] / u[f][pattern[f]]) for f in LEVELS)
    return 1 / (1 + math.exp(-max(min(odds, 500), -500)))


def _days(lag: int, late: bool) -> int:
    """How many days a class of lags has."""
    first, after = LAGS[lag] if late else max(LAGS[lag], -2), (*LAGS[1:], MOST_DAYS + 1)[lag]
    return max(0, after - first)


def unnumbered(counts: dict[tuple, int], dated: dict[str, float]) -> dict[tuple, float]:
    """Confidence of pairs with the same title and no number, by (date, lag, late, crowd). counts: such pairs, also those of dates that
    conflict; dated: shares of the levels of dates among matches. Near dates are matches as far as they are more than the CHANCE_DAYS let
    expect; of imprecise ones as many are matches as there are for so many near ones."""
    out, near = {}, {}
    for (date, lag, late, crowd), n in counts.items():
        if date == "near":
            chance = counts.get(("conflict", -1, late, crowd), 0) / CHANCE_DAYS * _days(lag, late)
            out[date, lag, late, crowd] = (max(n - chance, 0) + 0.5) / (n + 1)
            near[crowd] = near.get(crowd, 0) + max(n - chance, 0)
    for (date, lag, late, crowd), n in counts.items():
        if date in ("year", "missing"):
            all_ = sum(k for (d, _, _, c), k in counts.items() if d == date and c == crowd)
            out[date, lag, late, crowd] = min(1.0, (near.get(crowd, 0) * dated[date] / dated["near"] + 0.5) / (all_ + 0.5))
    return out


def confidences(rows: list) -> list[tuple]:
    """(number, date, lag, late, crowd, title, commune, figures, confidence) of the patterns. rows: the same, with count."""
    # pairs without a commune have met by their titles, which therefore are classes of their own
    of = lambda r: {"number": "equal", "date": f"{r['date']}/{-2 if r['lag'] is None else r['lag']}/{r['late']:d}/{r['crowd']}", "title": f"{r['title']}/{r['commune']}", "commune": r["commune"]}
    numbered: dict[tuple, int] = {}
    for r in rows:
        if r["number"] == "equal":
            k = tuple(of(r).items())
            numbered[k] = numbered.get(k, 0) + r["count"]
    share, m, u = estimate([(dict(k), n) for k, n in numbered.items()], anchored=True)
    dated = {d: sum(x for k, x in m["date"].items() if k.split("/")[0] == d) for d in LEVELS["date"]}
    same: dict[tuple, int] = {}
    for r in rows:
        if r["number"] == "missing" and r["title"] == "same" and r["figures"]:
            k = (r["date"], r["lag"], r["late"], r["crowd"])
            same[k] = same.get(k, 0) + r["count"]
    loose = unnumbered(same, dated)
    out = []
    for r in rows:
        if r["number"] == "equal":
            c = posterior(of(r), share, m, u)
        else:
            c = loose.get((r["date"], r["lag"], r["late"], r["crowd"]), 0.0) if r["title"] == "same" and r["figures"] else 0.0
        out.append((*(r[f] for f in FIELDS), c))
    return out


def linked(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, rid, confidence) of the pairs whose posterior reaches the threshold. An exact check follows: dates must not contradict;
    without a number on both sides the titles must be the same, figures included; a number says which act it is only with a year, so
    that without one a title must speak for it; and a row is one act: where its title names no subject, it goes with the records whose
    date agrees best."""
    from edicta.session import cut

    levels = cut(compared(left, right), "levels")
    scored = confidences(levels.groupBy(*FIELDS).count().collect())
    table = levels.sparkSession.createDataFrame(scored, "number string, date string, lag int, late boolean, crowd int, title string, commune string, figures boolean, confidence double").select(*(F.col(f).alias(f"_{f}") for f in FIELDS), "confidence")
    same = F.lit(True)
    for f in FIELDS:
        same &= F.col(f).eqNullSafe(F.col(f"_{f}"))
    likely = levels.join(F.broadcast(table), same).where(F.col("confidence") >= threshold)
    numbered = F.col("number") == "equal"
    likely = likely.where((F.col("date") != "conflict") & F.when(numbered, (F.col("date") != "missing") | (F.col("title") != "absent")).otherwise((F.col("title") == "same") & F.col("figures")))
    rank = F.when(F.col("title") == "absent", F.when(F.col("date") == "near", 0).otherwise(1)).otherwise(0)
    return likely.withColumn("_rank", rank).withColumn("_best", F.min(rank).over(Window.partitionBy("id"))).where("_rank = _best").select("id", "rid", "confidence")
