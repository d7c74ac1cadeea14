"""A training corpus from ``documents``: language ID, near-duplicate removal, PII, mixing, packing (``logtide.llm.stages``)."""

from logtide.llm.stages import STAGES, run

#: None of the stages can be expressed in SQL: tests hold each against a plain version.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]
