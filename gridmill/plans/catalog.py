"""Every registered query of the library, with its DuckDB oracle where SQL can express it."""

from gridmill.plans import q_explore, q_features, q_ingest, q_model, q_parse, q_records, q_stream, q_tables  # noqa: F401  they register their queries
from gridmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
