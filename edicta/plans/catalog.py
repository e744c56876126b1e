"""All queries of the core, by name."""

from edicta.plans import aggregates, classifiers, functions, ingestion, joins, remaining, repairs, search, sources, windows  # noqa: F401
from edicta.plans.registry import ORACLE, QUERIES  # noqa: F401
