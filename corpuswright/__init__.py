"""Document-corpus enrichment and audit as PySpark DataFrame operators."""

SCHEMA_VERSION = "corpuswright/v1"
