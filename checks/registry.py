"""All registered queries and their SQL."""

from __future__ import annotations

import importlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODULES = ["profile", "duplicates", "classify", "extract", "reports", "jobs", "images", "inference", "plans", "refresh"]

# queries without SQL to compare with
ROWS_ONLY = {"render_documents", "refinalize"}


def plain(df: DataFrame) -> DataFrame:
    """Comparable columns: arrays of text joined by ``|``, integers as bigint, no float."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            c = F.array_join(c, "|")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        out.append(c.alias(field.name))
    return df.select(*out)


def _modules():
    return [importlib.import_module(f"checks.q_{m}") for m in MODULES]


def queries():
    found = {}
    for m in _modules():
        for name, fn in m.QUERIES.items():
            assert name not in found, name
            found[name] = (lambda f: lambda spark, sf: plain(f(spark, re.sub(r"/+$", "", sf))))(fn)
    return found


def oracle_sql():
    found = {}
    for m in _modules():
        found.update(m.SQL)
    return found
