"""The privacy flow end to end: pseudonymise → key every subject → encrypt the
personal columns → store → a decrypting admin view beside the encrypted table
(G1-G8, K4, K10).

Columns are encrypted before the first write, so no file of the table ever holds
them in clear. Keys are only made for subjects without one; a table that has
been protected is refused, whatever rows come in, since encrypting cipher text
would destroy it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeshore.operators import privacy
from lakeshore.sinks import versioned


@dataclass
class ProtectedTable:
    table: str          # encrypted view (what ordinary users read)
    clear_view: str     # decrypting view (admin)
    keys_view: str      # key table view
    base: str           # versioned table folder
    key_path: str       # key table folder


def protect(spark: SparkSession, raw: DataFrame, root: str, name: str, id_column: str,
            pii_columns, pseudonym_of: str | None = None, salt: str | None = None
            ) -> ProtectedTable:
    """Run the flow over ``raw`` into folders below ``root``."""
    root = root.rstrip("/")
    pii = [pii_columns] if isinstance(pii_columns, str) else list(pii_columns)
    out = ProtectedTable(table=name, clear_view=f"{name}_admin", keys_view=f"{name}_keys",
                         base=f"{root}/{name}", key_path=f"{root}/{name}_keys")
    privacy.refuse_encrypted(spark, out.base, pii)
    df = privacy.pseudonymize(raw, pseudonym_of, salt=salt) if pseudonym_of else raw
    keys = privacy.store_keys(df, id_column, out.key_path)
    keys.createOrReplaceTempView(out.keys_view)
    versioned.write_version(privacy.encrypt_columns(df, keys, id_column, pii), out.base,
                            table=out.table, meta={"encrypted": sorted(c.lower() for c in pii)})
    privacy.register_sql_functions(spark)
    privacy.create_clear_view(spark, out.table, out.keys_view, id_column, pii, out.clear_view)
    return out
