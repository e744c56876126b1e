"""Visually identical text with different characters (problem 6).

Look-alike classes are the transitive closure (union-find) of pairs of strings of code points: compatibility forms, invisible
marks and the empty string, spaces, composed and combining accents, ligatures, look-alike letters. Each class is represented by its
member of the script, then of the spelling, most frequent in the corpus. Text is rewritten greedily (leftmost, longest) with an
Aho-Corasick automaton, until nothing changes.

Defined cases: null stays null and is never a change; empty text stays empty; words wholly in another script that hold a letter
without Latin look-alike are kept; quotes, dashes and signs that look different are kept; tables without rows give no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicta.functions.text import INVISIBLE, LOOKALIKE, SPACES

#: Spellings of several code points that are one sign to the eye (fixed values).
STRINGS = [("№", "N°"), ("Nº", "N°"), ("nº", "n°"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl")]
#: Compatibility kinds of the character database whose forms look the same.
SAME_LOOK = ("<wide>", "<narrow>", "<font>", "<noBreak>")


def _is_mark(ch: str) -> bool:
    return unicodedata.category(ch) == "Mn"


def count_strings(df: DataFrame, columns: list[str]) -> DataFrame:
    """(s, n): each code point of the columns, and each pair of code points that ends in a combining mark or spells a known string."""
    tails = {s[i : i + 2] for pair in STRINGS for s in pair for i in range(len(s) - 1)}

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ones = np.zeros(0x110000, dtype=np.int64)
        twos: Counter[str] = Counter()
        marks = np.array([c for c in range(0x300, 0x370)], dtype=np.uint32)
        for frame in frames:
            for name in frame.columns:
                text = "\n".join(x for x in frame[name] if x)
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                found, n = np.unique(codes, return_counts=True)
                ones[found] += n
                if np.isin(found, marks).any():
                    for at in np.flatnonzero(np.isin(codes[1:], marks)):
                        twos[text[at : at + 2]] += 1
                for t in tails:
                    if k := text.count(t):
                        twos[t] += k
        some = np.flatnonzero(ones)
        yield pd.DataFrame({"s": [chr(c) for c in some] + list(twos), "n": [*ones[some].tolist(), *twos.values()]})

    counted = df.select(*columns).mapInPandas(count, "s string, n long")
    return counted.groupBy("s").agg(F.sum("n").alias("n"))


def _script(s: str) -> str:
    if not s:
        return "basic"
    if len(s) > 1 and any(map(_is_mark, s)):
        return "combining"
    ch = s[0]
    if all(ord(x) < 0x100 for x in s) and ch not in INVISIBLE and ch not in SPACES:
        return "basic"
    return unicodedata.name(ch, "?").split()[0] if ch.isalpha() else "other"


class Classes:
    """Union-find over strings; `rewrites` maps every other member of a class to its representative."""

    def __init__(self, counts: dict[str, int]):
        self.parent: dict[str, str] = {}
        letters = [s for s in counts if len(s) == 1 and s.isalpha()]
        for s in counts:
            if len(s) == 1:
                kind, _, form = unicodedata.decomposition(s).partition(" ")
                if kind in SAME_LOOK:
                    self.union(s, "".join(chr(int(x, 16)) for x in form.split()))
                if s in LOOKALIKE:
                    self.union(s, LOOKALIKE[s])
                if s in SPACES:
                    self.union(s, " ")
                if s in INVISIBLE:
                    self.union(s, "")
                if 0x300 <= ord(s) < 0x370:
                    for base in letters:
                        one = unicodedata.normalize("NFC", base + s)
                        if len(one) == 1:
                            self.union(base + s, one)
        for a, b in STRINGS:
            self.union(a, b)
        scripts: Counter[str] = Counter()
        for s, n in counts.items():
            if len(s) == 1:
                scripts[_script(s)] += n
        groups: dict[str, list[str]] = {}
        for s in list(self.parent):
            groups.setdefault(self.find(s), []).append(s)
        self.rewrites: dict[str, str] = {}
        for members in groups.values():
            best = "" if "" in members else min(members, key=lambda s: (-scripts[_script(s)], -counts.get(s, 0), len(s), s))
            self.rewrites |= {s: best for s in members if s != best}

    def find(self, s: str) -> str:
        root = s
        while self.parent.setdefault(root, root) != root:
            root = self.parent[root]
        while self.parent[s] != root:
            self.parent[s], s = root, self.parent[s]
        return root

    def union(self, a: str, b: str) -> None:
        self.parent[self.find(a)] = self.find(b)


def classes_of(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The rewrites for the corpus. What is collected is bounded by the code points of Unicode and the pairs of rule."""
    return Classes({r.s: r.n for r in count_strings(df, columns).collect()}).rewrites


class Rewriter:
    """Greedy leftmost-longest rewriting with one automaton, repeated until stable."""

    FOREIGN = re.compile(r"[^\W\d_]+")
    OTHER = re.compile(r"[Ͱ-ԯא-ۿऀ-ॿ぀-ヿ一-鿿]")

    def __init__(self, rewrites: dict[str, str]):
        self.rewrites = rewrites
        self.machine = ahocorasick.Automaton()
        for s, best in rewrites.items():
            if s:
                self.machine.add_word(s, (len(s), best))
        if len(self.machine):
            self.machine.make_automaton()

    def _once(self, text: str) -> str:
        out, at = [], 0
        for end, (n, best) in self.machine.iter_long(text):
            out += [text[at : end - n + 1], best]
            at = end + 1
        return "".join([*out, text[at:]])

    def _kept(self, word: str) -> bool:
        """Wholly of another script, with a letter that looks like no Latin one."""
        return all(self.OTHER.match(x) or _is_mark(x) for x in word) and any(x not in self.rewrites for x in word)

    def __call__(self, text: str) -> str:
        if not len(self.machine):
            return text
        if self.OTHER.search(text):
            out, at = [], 0
            for m in self.FOREIGN.finditer(text):
                if self._kept(m[0]):
                    out += [self._stable(text[at : m.start()]), m[0]]
                    at = m.end()
            return "".join([*out, self._stable(text[at:])])
        return self._stable(text)

    def _stable(self, text: str) -> str:
        # ends: no representative is rewritten, and each round has fewer variants or a shorter text
        while (new := self._once(text)) != text:
            text = new
        return text


def _suspects(rewrites: dict[str, str]) -> str:
    """One character class that every variant has a member of: its code points beyond ASCII, as ranges."""
    codes = sorted({ord(x) for s in rewrites for x in (s if len(s) == 1 else [c for c in s if not c.isascii() and (_is_mark(c) or c == "º")] or s)})
    ranges: list[list[int]] = []
    for c in codes:
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]" if ranges else "(?!)"


def rewrite(df: DataFrame, id_col: str, columns: list[str], rewrites: dict[str, str] | None = None) -> DataFrame:
    """(id, field, old, new) of every value with a character that is not the usual one for its look. Only suspects reach Python."""
    rewrites = classes_of(df, columns) if rewrites is None else rewrites
    pattern = _suspects(rewrites)
    suspect = df.select(F.col(id_col).alias("id"), *columns).where(" or ".join(f"`{c}` rlike '{_sql(pattern)}'" for c in columns))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        to = Rewriter(rewrites)
        for frame in frames:
            rows = [(i, c, t, n) for c in columns for i, t in zip(frame["id"], frame[c], strict=True) if t and (n := to(t)) != t]
            yield pd.DataFrame(rows, columns=["id", "field", "old", "new"])

    kind = dict(df.dtypes)[id_col]
    return suspect.mapInPandas(run, f"id {kind}, field string, old string, new string")


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def unified(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """df with the columns in the consistent form and `changed_fields`, the names of those that changed (empty array if none)."""
    changes = rewrite(df, id_col, columns).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("field", "new"))).alias("_new"))
    out = df.join(changes.withColumnRenamed("id", "_id"), F.col("_id") == df[id_col], "left").drop("_id")
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.col("_new")[c], F.col(c)))
    return out.withColumn("changed_fields", F.coalesce(F.array_sort(F.map_keys("_new")), F.array().cast("array<string>"))).drop("_new")
