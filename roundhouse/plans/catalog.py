"""All registered queries: importing the modules fills the registry."""

from roundhouse.plans import aggregates, datasets, exports, joins, picks, pipelines, scalars, scans, sequences, streams  # noqa: F401
from roundhouse.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
