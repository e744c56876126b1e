"""One rule engine: rule sets are data, (priority, label, pattern, negate), compiled to expressions that stay in generated code."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    pattern: str
    negate: str | None = None

    def matches(self, c: Column) -> Column:
        hit = c.rlike(self.pattern)
        return hit & ~c.rlike(self.negate) if self.negate else hit


def first_label(c: Column, rules: list[Rule], default: str | None = None) -> Column:
    """The label of the first matching rule by priority, else the default. null text gets the default."""
    out = F.lit(default)
    for r in sorted(rules, key=lambda r: -r.priority):
        out = F.when(F.coalesce(r.matches(c), F.lit(False)), r.label).otherwise(out)
    return out


def all_labels(c: Column, rules: list[Rule]) -> Column:
    """Every label with a matching rule, sorted, each once; an empty array for none or null."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(r.matches(c), r.label) for r in rules)))))


def score(c: Column, weights: list[tuple[str, int]]) -> Column:
    """The sum of the weights of the matching patterns; null text scores 0."""
    total = F.lit(0)
    for pattern, w in weights:
        total = total + F.when(F.coalesce(c.rlike(pattern), F.lit(False)), w).otherwise(0)
    return total
