"""Noise in text from scanned pages (problem 2).

Lines of a scanned text are told apart by the text's own structure: running headers recur page after page (misread or not), page
numbers follow one another, words go on over line ends. What headers say is learnt over the corpus: the words of lines that recur in
their own text, against the words of all other lines, tell a header where a text has one page only.

Words are repaired by a noisy channel: the probability of the confusions that turn a candidate word into the one read, times the
likelihood of the candidate among its neighbours, decoded by Viterbi per line. The probability of a confusion is estimated by
expectation-maximisation over the distinct words of the corpus: how often a sign is misread in frequent words, over how often it
stands in them.

Counts are taken over the whole corpus. The tasks receive words with a relative frequency of EPSILON or more and pairs with PAIR_EPSILON
or more: by that definition there are at most 1 / EPSILON and 1 / PAIR_EPSILON of them, whatever the size of the corpus. A word rarer
than EPSILON is no candidate for a correction; it is still recognised as misread where it holds signs that no word has.

Defined cases: null, empty and blank texts have no lines; texts whose lines are not wrapped are digital and have no noise, single long
lines in wrapped text aside; very long texts are treated whole, in time that grows with their lines; repeated rows each come out; lines
keep their numbers from 1 after splitting at line feeds.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPSILON, PAIR_EPSILON = 1e-6, 1e-5
#: What a scanned sign is read as, and the signs it may stand for (fixed values).
CONFUSED = {"@": ("a",), "€": ("c",), "0": ("o",), "1": ("i", "l", "í"), "5": ("s",), "8": ("b",), "9": ("g", "q"), "6": ("ó", "b", "g"), "3": ("e",), "7": ("t",), "4": ("a",), "c": ("e", "é"), "l": ("i", "í", "t"), "f": ("í", "e", "t"), "rn": ("m",), "ri": ("n",), "ii": ("u", "ü"), "cl": ("d",), "li": ("h",), "vv": ("w",), "m": ("rn",), "i": ("l", "í"), "u": ("n",), "n": ("u",), "h": ("b",), "o": ("a", "c", "e"), "e": ("c",)}
SURE = "@€01589634"  # signs no word holds among its letters
#: Where the estimate of a confusion's probability starts, how many words of evidence the start counts for, and how many times as
#: frequent a word must be to be what another was misread from.
P_START, P_WEIGHT, CLEARLY = 1e-3, 20, 20
#: How many of a word's occurrences are taken for its own before anything else is known of it.
OWN = 0.05
LEAST_PAGE = 60  # a single page number up to this is taken as one in the shortest text
HYPHENS = "-¬\xad‐‑"
TOKEN = re.compile(r"[\w@€]+")
ROMAN = re.compile(r"[ivxlc]{1,7}", re.I)
PAGE = re.compile(r"(?:p[áa@]g(?:ina)?s?|p|foja|fojas|hoja|folio|fs)\.? ?[\dlOo]{1,5}(?: ?(?:de|/) ?[\dlOo]{1,5})?|[\[(] ?\d{1,5} ?[\])]|\d{1,4} ?/ ?\d{1,4}|[-–—] ?\d{1,5} ?[-–—]|\d{1,4} de \d{1,4}", re.I)
PAGE_MOST = 30  # characters; no notation of a page's number has more
APART = re.compile(r"\S {3,}\S| [—·|] | / ")
ARTICLE = re.compile(r"\s*(?:art[íi1lf]?c?[uii]*l?[o0]|art)\b", re.I)
ROW = re.compile(r"\s*\w{3,12} \d{1,3}: ")
LOWER = re.compile(r"(?<!\w)[a-záéíóúñü]{2,}(?!\w)")


def scanned(lines: list[str]) -> bool:
    """Wrapped text: more lines that stop inside a sentence, which the next line takes up, than lines too long to be wrapped."""
    long = sum(len(x) > 120 for x in lines)
    if 2 * long > sum(len(x) > 30 for x in lines):
        return False
    broken = 0
    starts = [(i, x.lstrip()[0].islower()) for i, x in enumerate(lines) if x.strip()]
    k = 0
    for i, line in enumerate(lines):
        while k < len(starts) and starts[k][0] <= i:
            k += 1
        if 30 < len(line) <= 120 and line.rstrip()[-1:] not in ".:;":
            broken += any(low for j, low in starts[k : k + 4] if j <= i + 5)
            if broken > long:
                return True
    return False


def shape(line: str) -> str:
    """A line as its glyphs: confusable signs alike, accents and figures aside, so that misread copies come close."""
    text = "".join(x for x in unicodedata.normalize("NFD", line.strip().lower()) if unicodedata.category(x) != "Mn")
    text = re.sub(r"(?<![a-z@€])\d+(?![a-z@€])", "#", text)
    for a, b in (("rn", "m"), ("ri", "n"), ("ii", "u"), ("cl", "d"), ("li", "h"), ("€", "e"), ("c", "e"), ("f", "e"), ("0", "o"), ("1", "l"), ("i", "l"), ("5", "s"), ("8", "b"), ("@", "a"), ("9", "g"), ("6", "o")):
        text = text.replace(a, b)
    return re.sub(r"\s+", " ", text)


def _alike(a: str, b: str) -> bool:
    if a == b:
        return True
    if abs(len(a) - len(b)) > 3 or len(a) < 8:
        return False
    # what stands alike at either end is matched; of the rest at most the signs that both have
    most = min(len(a), len(b))
    head = next((k for k in range(most) if a[k] != b[k]), most)
    tail = next((k for k in range(most - head) if a[-1 - k] != b[-1 - k]), most - head)
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    if 2 * (head + tail + sum(min(x.count(z), y.count(z)) for z in set(x))) <= 0.85 * (len(a) + len(b)):
        return False
    return SequenceMatcher(None, a, b, autojunk=False).ratio() > 0.85


def _stated(s: str) -> bool:
    """Shapes that only headers have: capitals throughout, or parts set apart by signs or wide spaces."""
    if APART.search(s):
        return True
    if sum(map(str.islower, s)) > 0.2 * len(s):  # more than a fifth of the letters, then, whatever else there is
        return False
    letters = sum(map(str.isalpha, s))
    return letters >= 6 and sum(map(str.isupper, s)) >= 0.8 * letters


def page_numbers(lines: list[str]) -> set[int]:
    """Indexes of the lines that are only the page's number."""
    short = [(i, s) for i, x in enumerate(lines) if len(s := x.strip()) <= PAGE_MOST]
    found = {i for i, s in short if PAGE.fullmatch(s) or ROMAN.fullmatch(s)}
    bare = [(i, int(s)) for i, s in short if re.fullmatch(r"\d{1,4}", s)]
    at = {i for i, _ in bare}
    alone = [(i, n) for i, n in bare if i - 1 not in at and i + 1 not in at]
    # figures of tables stand together; pages rise by one, or by a few where a number was lost. The best chain so far that ends in each
    # figure is kept: longest, then of the smallest steps, then the first
    ends: dict[int, tuple[int, int, int, int]] = {}
    before: list[int] = []
    top = (0, 0, 0, -1)
    for at_, (_, n) in enumerate(alone):
        length, steps, _, last = max((ends[m][0], ends[m][1] - (n - m), -ends[m][3], ends[m][3]) for m in range(n - 4, n) if m in ends) if any(m in ends for m in range(n - 4, n)) else (0, 0, 0, -1)
        chain = (length + 1, steps, 0, at_)
        before.append(last)
        if n not in ends or chain[:2] > ends[n][:2]:
            ends[n] = chain
        if chain[:2] > top[:2]:
            top = chain
    best: list[int] = []
    at_ = top[3]
    while at_ >= 0:
        best.append(alone[at_][0])
        at_ = before[at_]
    best.reverse()
    if len(found) > 1 and len(best) < 3:  # the text numbers its pages in another notation
        best = []
    if len(best) == 1:
        i = best[0]
        # figures of a table stand near others; a text cannot have more pages before this one than it has lines
        near = any(i != j and abs(i - j) <= 6 for j in at)
        best = [] if near or int(lines[i].strip()) > max(LEAST_PAGE, len(lines)) else best
    return found | set(best)


def _signs(s: str) -> list[int]:
    """512 bits: which signs a shape has, how many times up to seven, as eight words of 64."""
    bits = 0
    for z, n in Counter(s).items():
        at = ord(z) % 73 * 7
        bits |= (1 << min(n, 7)) - 1 << at
    return [bits >> 64 * k & 0xFFFFFFFFFFFFFFFF for k in range(8)]


def grouped(shapes: dict[int, str]) -> dict[int, list[int]]:
    """For each line, the lines that look like it, itself included: equal shapes at once, others by the most frequent shape they are alike to.
    A shape is compared with those of which it lacks few enough signs, found for all at once on bits."""
    lines_of: dict[str, list[int]] = {}
    for i, s in shapes.items():
        lines_of.setdefault(s, []).append(i)
    group: dict[str, list[int]] = {}
    firsts: list[str] = []
    bits, size = np.zeros((16, 8), np.uint64), np.zeros(16, np.int64)
    for s, own in sorted(lines_of.items(), key=lambda x: -len(x[1])):  # the right spelling of a header recurs most
        n, sign = len(firsts), np.array(_signs(s), np.uint64)
        near = np.flatnonzero(np.abs(size[:n] - len(s)) <= 3) if len(s) >= 8 else []
        if len(near):
            lacks = np.bitwise_count(sign & ~bits[near]).sum(axis=1)
            near = near[lacks <= len(s) - 0.425 * (len(s) + size[near])]
        to = next((firsts[k] for k in near if _alike(s, firsts[k])), None)
        if to is not None:
            group[to].extend(own)
            group[s] = group[to]
            continue
        group[s] = [*own]
        if n == len(size):
            bits, size = np.vstack([bits, np.zeros_like(bits)]), np.concatenate([size, np.zeros_like(size)])
        bits[n], size[n] = sign, len(s)
        firsts.append(s)
    return {i: group[s] for i, s in shapes.items()}


def headers(lines: list[str], pages: set[int], said: dict[str, float] | None = None) -> set[int]:
    """Indexes of running headers: short lines of one look that recur page by page; where there is one page, a line at its edge or
    beside the page's number that looks like nothing else, or that says what headers say. said: weight of words, learnt."""
    width = max(map(len, lines))
    text = [i for i, x in enumerate(lines) if x.strip() and i not in pages]
    edge = {i for i in text if i <= 1 or lines[i][:1] == "\x0c" or i - 1 in pages or i + 1 in pages or i >= len(lines) - 2}

    def could(i: int) -> bool:
        s = lines[i].strip()
        stated = _stated(s)  # lines of text may recur as well
        prose = len(LOWER.findall(s)) > (7 if stated else 4) or not stated and re.search(r"[a-záéíóú)][.;] ", s)
        return 5 <= len(s) <= 90 and s[-1] not in ".,;:" + HYPHENS and not s[0].islower() and not prose and not ARTICLE.match(s) and not ROW.match(s)

    some = [i for i in text if could(i)]
    looks = {i: shape(lines[i]) for i in some}
    same_look = grouped(looks)
    names = {i for i in some if said and weight(looks[i], said) > 0}
    found = {i for i in some if SET_APART.search(lines[i].strip())}
    wrap = sorted(len(lines[i].rstrip()) for i in text)[int(0.8 * len(text))] if text else 0
    for a, i, b in zip(text, text[1:], text[2:], strict=False):  # a line that a sentence runs past, too short to have been wrapped there
        before, after = lines[a].rstrip(), lines[b].strip()
        if i in names and before[-1:] not in ".:;" and after[:1].islower() and len(lines[i].strip()) + 1 + len(after.split()[0]) < wrap - 2:
            found.add(i)
    for _ in range(3):  # a header beside a header is at the page's edge as well
        size = len(found)
        edge |= {i for i in text if i - 1 in found or i + 1 in found}
        recurs: dict[int, bool] = {}  # by group
        following = ""  # the next line of text that is no header, from the end backwards
        after_of = {}
        for i in reversed(text):
            after_of[i] = following
            if i not in found:
                following = lines[i].strip()
        for i in some:
            if i in found:
                continue
            s = lines[i].strip()
            same = same_look[i]
            if (apart := recurs.get(id(same))) is None:
                far = len(same) > 1 and max(same) - min(same) > 3
                apart = recurs[id(same)] = far and sum(j in edge for j in same) * 2 >= len(same) or far and None
            if apart or apart is None and _stated(s):
                found |= set(same)
            elif _stated(s) or len(s) < width - 8 and not after_of[i][:1].islower() and i in names:
                found.add(i)
        if len(found) == size:
            break
    return found


def weight(look: str, said: dict[str, float]) -> float:
    """How much more a line speaks like a header than like other lines: the sum of its words' weights."""
    return sum(said.get(w, 0.0) for w in set(look.split())) + said.get("", 0.0)


#: Parts of a line set apart by signs or wide spaces, as headers have them.
SET_APART = re.compile(r"\S {3,}\S|\S [—·|] \S|\S / \D+ / ")
def count_words(df: DataFrame, text: str) -> DataFrame:
    """(kind, a, b, n) over all texts: words 'w' and pairs of neighbouring words of a line 'p', in lower case; and of scanned texts, the
    words of shapes of lines that are headers by recurrence 'h' and of the others 't', with the numbers of such lines under no word."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[tuple[str, str, str]] = Counter()

        def flushed() -> pd.DataFrame:
            out = pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["kind", "a", "b", "n"])
            seen.clear()
            return out

        for frame in frames:
            for t in frame[text].dropna():
                for line in t.lower().split("\n"):
                    w = TOKEN.findall(line)
                    seen.update(("w", x, "") for x in w)
                    seen.update(("p", x, y) for x, y in zip(w, w[1:], strict=False))
                lines = t.split("\n")
                if t.strip() and scanned(lines):
                    pages = page_numbers(lines)
                    heads = headers(lines, pages)
                    for i, x in enumerate(lines):
                        if x.strip() and i not in pages and len(x.strip()) <= 90:
                            kind = "h" if i in heads else "t"
                            seen.update((kind, y, "") for y in {*shape(x).split(), ""})
                if len(seen) > 300_000:
                    yield flushed()
        yield flushed()

    return df.select(text).mapInPandas(count, "kind string, a string, b string, n long").groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))


class Model:
    """What the tasks receive: frequencies, weights of words in headers, stems of codes, probabilities of confusions."""

    def __init__(self, total: int, words: dict[str, float], pairs: dict[tuple[str, str], int], said: dict[str, float] | None = None, codes: set[str] | None = None, odds: dict[tuple[str, str], float] | None = None):
        self.total, self.words, self.pairs, self.said, self.codes, self.odds = total, words, pairs, said or {}, codes or set(), odds or {}


def language_model(df: DataFrame, text: str) -> Model:
    """The model of a corpus. Words and stems are at most 1 / EPSILON, pairs at most 1 / PAIR_EPSILON."""
    from edicta.session import cut

    counts = cut(count_words(df, text), "words")
    totals = {r.kind: r.n for r in counts.where("kind = 'w' or a = ''").groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    total = totals.get("w", 0)
    least = max(3, math.ceil(EPSILON * total))
    words = {r.a: r.n for r in counts.where((F.col("kind") == "w") & (F.col("n") >= least)).collect()}
    pairs = {(r.a, r.b): r.n for r in counts.where((F.col("kind") == "p") & (F.col("n") >= max(3, math.ceil(PAIR_EPSILON * total)))).collect()}
    stems = counts.where("kind = 'w'").where(F.col("a").rlike("^[a-z]+[0-9]+$")).groupBy(F.regexp_replace("a", "[0-9]+$", "").alias("stem")).agg(F.count(F.lit(1)).alias("forms"), F.sum("n").alias("n"))
    codes = {r.stem for r in stems.where((F.col("forms") >= 3) & (F.col("n") >= least)).collect()}
    odds = confusion_odds(counts, words)
    return Model(total, own_counts(words, odds), pairs, _said(counts, totals), codes, odds)


def own_counts(words: dict[str, int], odds: dict[tuple[str, str], float]) -> dict[str, float]:
    """How often each word stands for itself: its count without the share that words CLEARLY more frequent explain as misread."""
    longest = max(map(len, words), default=0)
    out = {}
    for w, n in words.items():
        explained = sum(words[v] * odds[c] for v, c in _confusions(w) if words.get(v, 0) >= CLEARLY * n) if 4 <= len(w) <= longest and not w.isdigit() else 0
        out[w] = n * n * OWN / (explained + n * OWN) if explained else n
    return out


def _said(counts: DataFrame, totals: dict[str, int]) -> dict[str, float]:
    """The log odds of words in headers against other lines; under no word, those of the lines themselves. At most 1 / EPSILON words."""
    heads, others = totals.get("h", 0), totals.get("t", 0)
    if not heads or not others:
        return {}
    least = max(3, math.ceil(EPSILON * (heads + others)))
    both = counts.where("kind in ('h', 't') and a != ''").groupBy("a").agg(F.sum(F.when(F.col("kind") == "h", F.col("n")).otherwise(0)).alias("h"), F.sum(F.when(F.col("kind") == "t", F.col("n")).otherwise(0)).alias("t"))
    rows = both.where(F.col("h") + F.col("t") >= least).collect()
    return {r.a: math.log((r.h + 0.5) / (heads + 1)) - math.log((r.t + 0.5) / (others + 1)) for r in rows} | {"": math.log(heads / others)}


def _confusions(w: str) -> Iterator[tuple[str, tuple[str, str]]]:
    """The words that one confusion turns into w, each with that confusion (what was read, what it stands for)."""
    for i in range(len(w)):
        for size in (1, 2):
            if i + size <= len(w):
                for to in CONFUSED.get(w[i : i + size], ()):
                    yield w[:i] + to + w[i + size :], (w[i : i + size], to)


def confusion_odds(counts: DataFrame, words: dict[str, int], rounds: int = 2) -> dict[tuple[str, str], float]:
    """Probability of each confusion, by expectation-maximisation: a word CLEARLY rarer than words it may be misread from is shared among
    these by their frequency and the confusions' present probabilities. Each round is one pass over the distinct words."""
    signs: Counter[str] = Counter()
    spelt = {to for tos in CONFUSED.values() for to in tos}
    for w, n in words.items():
        for to in spelt:
            if k := w.count(to):
                signs[to] += k * n
    odds = {(read, to): P_START for read, tos in CONFUSED.items() for to in tos}
    known = counts.sparkSession.sparkContext.broadcast(words)
    longest = max(map(len, words), default=0)
    for _ in range(rounds):
        now = dict(odds)

        def shared(frames: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            for frame in frames:
                got: Counter[tuple[str, str]] = Counter()
                for w, n in zip(frame["a"], frame["n"], strict=True):
                    # words that hold figures only in place of letters, or letters only
                    if len(w) > longest + 1 or w.isdigit() or len(w) < 4:
                        continue
                    options = [(c, known.value[v] * now[c]) for v, c in _confusions(w) if known.value.get(v, 0) >= CLEARLY * n]
                    mass = sum(p for _, p in options) + n * OWN  # or it is a word of its own
                    for c, p in options:
                        got[c] += n * p / mass
                yield pd.DataFrame([(*c, x) for c, x in got.items()], columns=["a", "b", "x"])

        found = counts.where("kind = 'w'").select("a", "n").mapInPandas(shared, "a string, b string, x double").groupBy("a", "b").agg(F.sum("x").alias("x"))
        times = {(r.a, r.b): r.x for r in found.collect()}
        odds = {c: (times.get(c, 0.0) + P_WEIGHT * P_START) / (signs[c[1]] + P_WEIGHT) for c in odds}
    return odds


class Channel:
    """Noisy-channel correction of lines."""

    def __init__(self, model: Model):
        self.total, self.words, self.pairs, self.model = max(model.total, 1), model.words, model.pairs, model
        self.odds = {c: math.log(p) for c, p in model.odds.items()}
        self.longest = max(map(len, model.words), default=0)
        self.known: dict[str, list[tuple[str, float]]] = {}

    def _undone(self, w: str) -> Iterator[tuple[str, float]]:
        """Words that one or two confusions turn into w, with the log probability of those."""
        start = math.log(P_START)
        once = []
        for i in range(len(w)):
            for size in (1, 2):
                for to in CONFUSED.get(w[i : i + size], ()) if i + size <= len(w) else ():
                    once.append((w[:i] + to + w[i + size :], i + len(to), self.odds.get((w[i : i + size], to), start)))
        yield from ((x, p) for x, _, p in once)
        for x, at, p in once:
            for i in range(at, len(x)):
                for size in (1, 2):
                    for to in CONFUSED.get(x[i : i + size], ()) if i + size <= len(x) else ():
                        yield x[:i] + to + x[i + size :], p + self.odds.get((x[i : i + size], to), start)

    def candidates(self, w: str) -> list[tuple[str, float]]:
        """What w may stand for: (word, log channel probability); itself first. Only words of the corpus are candidates."""
        if (found := self.known.get(w)) is None:
            best: dict[str, float] = {}
            # a confusion changes the length by one at most: longer words stand for none that is known
            if 2 <= len(w) <= self.longest + 2 and not w.isdigit() and any(x.isalpha() for x in w):
                own = self.words.get(w, 0)
                for v, p in self._undone(w):
                    if (n := self.words.get(v, 0)) > own and v.isalpha() and v != w:
                        best[v] = max(best.get(v, -99.0), p)
            found = [(w, 0.0), *sorted(best.items(), key=lambda x: (-x[1], x[0]))]
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[w] = found
        return found

    def _likely(self, before: str, w: str) -> float:
        n = self.words.get(w, 0)
        alone = max(n, OWN) / self.total
        if any(x in SURE for x in w) and not w.isdigit():
            alone *= 1e-4
        b = self.words.get(before, 0)
        paired = self.pairs.get((before, w), 0) / b if b else 0.0
        return math.log(0.5 * paired + 0.5 * alone)

    def decode(self, words: list[str]) -> list[str]:
        """The likeliest words behind those read, in lower case."""
        lattice = [self.candidates(w) for w in words]
        if all(len(x) == 1 for x in lattice):
            return words
        best = [{v: (p + self._likely("", v), None) for v, p in lattice[0]}]
        for options in lattice[1:]:
            before = best[-1]
            best.append({v: max(((s + p + self._likely(u, v), u) for u, (s, _) in before.items()), key=lambda x: x[0]) for v, p in options})
        v = max(best[-1], key=lambda x: best[-1][x][0])
        out = [v]
        for step in reversed(best[1:]):
            v = step[v][1]
            out.append(v)
        return out[::-1]


def _odd(word: str, codes: set[str]) -> bool:
    """A word with one or two signs among its letters that no word holds there; codes and ordinals are none. codes: stems of words that
    the corpus has with several numbers behind them."""
    signs = [x for x in word if x in SURE]
    letters = [x for x in word if x.isalpha()]
    if not signs or len(signs) > 2 or len(letters) < 3 or len(letters) + len(signs) < len(word):
        return False
    if any(x in "@€" for x in signs):
        return True
    inside = re.search(r"[a-záéíóúñü]{2}[01589634]|[01589634][a-záéíóúñü]{2}", word) and not re.search(r"[A-Z]{2}", word) and not re.match(r"\w*\d\d", word)
    return bool(inside) and not (re.fullmatch(r"[A-Za-z]+\d+", word) and word.lower().rstrip("0123456789") in codes)


class Page:
    """One text: its lines, what each is, and its repaired form."""

    def __init__(self, text: str, channel: Channel):
        self.lines = text.split("\n")
        self.is_scan = scanned(self.lines)
        self.kinds: list[tuple[int, str]] = []
        self.words: dict[int, list[tuple[int, int, str]]] = {}
        self.joined: set[int] = set()
        if not self.is_scan:
            return
        pages = page_numbers(self.lines)
        heads = headers(self.lines, pages, channel.model.said)
        self.dropped = pages | heads
        self.kinds += [(i, "page_number") for i in pages] + [(i, "header") for i in heads]
        body = [i for i, x in enumerate(self.lines) if x.strip() and i not in self.dropped]
        for i, j in zip(body, body[1:], strict=False):
            a, b = self.lines[i].rstrip(), self.lines[j].lstrip(" \t\x0c")
            if len(a) > 2 and a[-1] in HYPHENS and a[-2].isalnum() and b[:1].isalpha() and (b[0].islower() or b[0] in SURE):
                self.kinds.append((i, "hyphen"))
                self.joined.add(i)
        self._correct(body, channel)

    def _correct(self, body: list[int], channel: Channel) -> None:
        """Words over line ends are read whole; the half that holds the misread sign counts."""
        wrong: set[int] = set()
        rest: tuple[int, int, int, str] | None = None
        for k, i in enumerate(body):
            line = self.lines[i]
            spans = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(line)]
            if rest and spans:
                spans = spans[1:] if line.lstrip().startswith(spans[0][2]) else spans
            rest = None
            whole = [w for _, _, w in spans]
            if i in self.joined and spans and k + 1 < len(body):
                head = TOKEN.match(self.lines[body[k + 1]].lstrip(" \t\x0c"))
                if head:
                    whole[-1] = spans[-1][2] + head[0]
                    rest = (i, body[k + 1], len(spans[-1][2]), head[0])
            read = [w.lower() for w in whole]
            found = channel.decode(read) if read else []
            for n, (w, r, v) in enumerate(zip(whole, read, found, strict=True)):
                if r != v or _odd(w, channel.model.codes):
                    at = i
                    if rest and n == len(whole) - 1:
                        same = 0
                        while same < min(len(r), len(v)) and r[same] == v[same]:
                            same += 1
                        at = rest[1] if same >= rest[2] and r != v else i
                        if r == v and not any(x in SURE for x in spans[-1][2]):
                            at = rest[1]
                    wrong.add(at)
                    if r != v:
                        start, end, own = spans[n]
                        self.words.setdefault(i, []).append((start, end, _cased(w, v)))
        self.kinds += [(i, "ocr") for i in wrong]

    def repaired(self) -> str:
        """Continuous paragraphs without headers and page numbers; a digital text as it is."""
        if not self.is_scan:
            return "\n".join(self.lines)
        paragraphs: list[str] = []
        text, glue, open_ = "", False, False
        skip = ""
        for i, line in enumerate(self.lines):
            if i in self.dropped:
                continue
            if not line.strip():
                blank_in_page = any(j in self.dropped for j in (i - 1, i + 1)) and text and text.rstrip()[-1:] not in ".:;"
                if text and not blank_in_page:
                    paragraphs.append(text)
                    text = ""
                continue
            new = line
            for start, end, to in sorted(self.words.get(i, []), reverse=True):
                new = new[:start] + to + new[end:]
            whole = i in self.joined and any(e == len(line.rstrip()) - 1 for _, e, _ in self.words.get(i, []))
            new = new.strip(" \t\x0c")
            if skip and new.startswith(skip):
                new = new[len(skip) :]
            skip = ""
            if i in self.joined:
                new = new.rstrip(HYPHENS)
                if whole:  # the corrected word was put in whole: its second half is taken off the next line
                    nxt = next((self.lines[j].lstrip(" \t\x0c") for j in range(i + 1, len(self.lines)) if self.lines[j].strip() and j not in self.dropped), "")
                    skip = (TOKEN.match(nxt) or [""])[0]
            starts = line.startswith("    ") or ARTICLE.match(line) or ROW.match(line)
            if text and starts and not glue:
                paragraphs.append(text)
                text = ""
            text = text + new if glue or not text else f"{text} {new}"
            glue = i in self.joined
            open_ = True
        return "\n\n".join([*paragraphs, text] if text or not open_ else paragraphs).strip()


def _cased(old: str, new: str) -> str:
    if old.isupper() or sum(x.isupper() for x in old) > len(old) / 2:
        return new.upper()
    return new.capitalize() if old[:1].isupper() else new


def _run(df: DataFrame, id_col: str, text: str, schema: str, rows, model) -> DataFrame:
    kind = dict(df.dtypes)[id_col]
    model = df.sparkSession.sparkContext.broadcast(model if model is not None else language_model(df, text))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        channel = Channel(model.value)
        for frame in frames:
            for at in range(0, len(frame), 500):
                part = frame.iloc[at : at + 500]
                out = [row for i, t in zip(part[id_col], part[text], strict=True) if t is not None for row in rows(i, t, channel)]
                yield pd.DataFrame(out, columns=[x.split()[0] for x in schema.split(", ")]).astype({"id": frame[id_col].dtype})

    return df.select(id_col, text).where(F.col(text).isNotNull()).mapInPandas(run, schema.format(kind))


def noise(df: DataFrame, id_col: str, text: str, model=None) -> DataFrame:
    """(id, line_no, kind) of the noisy lines."""

    def rows(i, t, channel):
        return [(i, n + 1, k) for n, k in sorted(set(Page(t, channel).kinds))] if t.strip() else []

    return _run(df, id_col, text, "id {}, line_no int, kind string", rows, model)


def repaired(df: DataFrame, id_col: str, text: str, model=None) -> DataFrame:
    """(id, text): every non-null text as continuous paragraphs."""
    return _run(df, id_col, text, "id {}, text string", lambda i, t, channel: [(i, Page(t, channel).repaired())], model)
