"""Column and SQL functions of the library, in one namespace.

Column functions (JVM expressions, usable in any ``select``/``where``):

* :func:`pseudonym` — ``sha2(salt || value, 256)`` (X1, G1);
* :func:`encrypt_value` / :func:`decrypt_value` — AES-GCM with a per-row key
  column, base64 text at the edge (G4, G5);
* :func:`json_path` — text at a JSON path (X3);
* :func:`passes` — TRUE only when a predicate is TRUE (expectation semantics).

SQL functions, registered on a session by :func:`register`:
``decrypt_val(text, key)`` (G6, G7) and ``new_encryption_key(id)`` (U1).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lakeshore.operators.eventlog import json_path
from lakeshore.operators.privacy import decrypt_value, encrypt_value, register_sql_functions
from lakeshore.operators.quality import passes

__all__ = ["pseudonym", "encrypt_value", "decrypt_value", "json_path", "passes", "register"]


def pseudonym(value: Column | str, salt: str | None = None) -> Column:
    col = F.col(value) if isinstance(value, str) else value
    col = col.cast("string")
    if salt:
        col = F.concat(F.lit(salt), col)
    return F.sha2(col, 256)


def register(spark: SparkSession, persistent: bool = False) -> None:
    """Register the SQL functions on ``spark``."""
    register_sql_functions(spark, persistent=persistent)
