"""Secret redaction: named patterns applied one after another inside one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright import fixed_values as fv
from corpuswright.functions import text as tx
from corpuswright.functions.text import let


def redact_secrets(
    df: DataFrame,
    column: str = "text",
    *,
    patterns=None,
    action: str = "redact",
    replacement: str = "[REDACTED]",
) -> DataFrame:
    """Replace secrets in ``column``; add ``redaction_warnings`` (``redaction_match:{name}:{n}``).

    A pattern sees the text left by the ones before it. ``fail`` only counts and sets
    ``redaction_failed``; ``off`` changes nothing.
    """
    patterns = fv.SECRET_PATTERNS if patterns is None else patterns
    if action not in ("redact", "fail", "off"):
        raise ValueError(f"unknown action {action}")
    if action == "off" or not patterns:
        return df.withColumns(
            {"redaction_warnings": F.array().cast("array<string>"), "redaction_failed": F.lit(False)}
        )
    safe = replacement.replace("\\", "\\\\").replace("$", "\\$")

    def step(pattern: str, name: str):
        """A state (text, told) after one pattern; it is computed once and handed on."""

        def run(state: Column) -> Column:
            now = state["text"]
            times = F.when(_may_match(now, F.lower(now), pattern), F.regexp_count(now, F.lit(pattern))).otherwise(0)
            left = F.regexp_replace(now, pattern, safe) if action == "redact" else now
            told = lambda n: F.array_append(state["told"], F.concat(F.lit(f"redaction_match:{name}:"), n.cast("string")))
            return let(times, lambda n: F.when(n > 0, F.struct(left.alias("text"), told(n).alias("told"))).otherwise(state))

        return run

    found = F.struct(F.col(column).alias("text"), F.array().cast("array<string>").alias("told"))
    any_secret = F.lit(False)
    for name, pattern in patterns:
        found = let(found, step(pattern, name))
        any_secret = any_secret | (_may_match(F.col(column), F.col("_low"), pattern) & F.col(column).rlike(pattern))
    # most rows hold no secret: one scan decides, the chain runs for the rest only
    return (
        df.withColumn("_low", F.lower(column))
        .withColumn("_found", F.when(any_secret, found))
        .withColumns(
            {
                "redaction_warnings": tx.coalesce_array(F.col("_found.told")),
                column: F.coalesce("_found.text", column),
            }
        )
        .withColumn("redaction_failed", F.lit(action == "fail") & (F.size("redaction_warnings") > 0))
        .drop("_low", "_found")
    )


def _may_match(text: Column, low: Column, pattern: str) -> Column:
    """False where ``text`` (``low`` in lower case) holds none of the literals that every match of a known pattern has."""
    literals, folded = fv.SECRET_LITERALS.get(pattern, ([], False))
    return tx.contains_any(low if folded else text, literals) if literals else F.lit(True)


def redaction_failures(redacted: DataFrame) -> DataFrame:
    """(document_id, message) of documents refused by the ``fail`` action."""
    return redacted.where("redaction_failed").select(
        "document_id", F.concat(F.lit("Redaction policy failed: "), F.array_join("redaction_warnings", ", ")).alias("message")
    )
