"""Pseudonymisation and per-subject column encryption.

* Pseudo id: ``sha2(column, 256)``, optionally salted. Unsalted (the default,
  for parity) is guessable for low-entropy values such as e-mail addresses.
* One random 256-bit key per subject, kept in a key table (id, key as base64).
  Keys are made in a Python worker from ``secrets.token_bytes`` (a CSPRNG),
  one Arrow batch at a time, and the UDF is nondeterministic: the key table must
  be *written* before any join uses it, else a recomputed task would make new
  keys. Only subjects without a key get one, so re-running never replaces a key
  that existing ciphertext depends on.
* Encryption is Spark's native ``aes_encrypt`` in GCM mode (random IV per row,
  authenticated), base64 at the edge. It runs in the JVM inside whole-stage
  code generation; no row crosses into Python. Null stays null.
* Decryption is ``try_aes_decrypt`` (wrong key → null) or, strict, the raising
  ``aes_decrypt``. ``''`` passes through. A SQL function ``decrypt_val`` gives
  the same to SQL users and views.
* A row whose subject has no key fails the job (lazy check, same pass), so an
  inner join can never silently lose rows.

Keys sit beside the data in clear text; anyone allowed to read the key table
and the data can decrypt. Access control is the platform's job.
"""

from __future__ import annotations

import base64
import secrets

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakeshore.operators import joins
from lakeshore.sinks import versioned

KEY_COLUMN = "encryption_key"
KEY_BYTES = 32


def pseudonymize(df: DataFrame, column: str, out: str = "customer_pseudo_id",
                 salt: str | None = None) -> DataFrame:
    """Add ``out = sha2(salt || column, 256)`` (G1)."""
    value = F.col(column).cast("string")
    if salt:
        value = F.concat(F.lit(salt), value)
    return df.withColumn(out, F.sha2(value, 256))  # same as functions.pseudonym


@F.pandas_udf(StringType())
def _random_key(ids: pd.Series) -> pd.Series:
    return pd.Series([base64.b64encode(secrets.token_bytes(KEY_BYTES)).decode("ascii")
                      for _ in range(len(ids))], dtype="object")


new_key = _random_key.asNondeterministic()


def subject_keys(df: DataFrame, id_column: str, existing: DataFrame | None = None,
                 key_column: str = KEY_COLUMN) -> DataFrame:
    """One new key per distinct non-null subject id missing from ``existing``
    (G2, G3). Lazy and nondeterministic: write it before use."""
    ids = df.select(id_column).where(F.col(id_column).isNotNull()).distinct()
    if existing is not None:
        ids = ids.join(existing.select(id_column), id_column, "left_anti")
    return ids.withColumn(key_column, new_key(F.col(id_column)))


def read_keys(spark: SparkSession, key_path: str, id_column: str,
              key_column: str = KEY_COLUMN) -> DataFrame:
    """The key table, one key per subject: a plain scan of the committed parts
    (see :func:`store_keys`), so a join with it needs no aggregate and adaptive
    execution can split a hot subject."""
    paths = [versioned.version_path(key_path, n) for n in versioned.versions(spark, key_path)]
    if not paths:
        raise FileNotFoundError(f"no key table under {key_path}")
    return spark.read.parquet(*paths).select(id_column, key_column)


def register_keys_view(spark: SparkSession, view: str, key_path: str, id_column: str,
                       key_column: str = KEY_COLUMN, persistent: bool = False) -> None:
    """:func:`read_keys` as a SQL view over the parts of the key table's folder,
    later ones included, so views (also persistent ones) can join one key per
    subject."""
    kind = "VIEW" if persistent else "TEMPORARY VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {view} AS SELECT `{id_column}`, `{key_column}` "
              f"FROM parquet.`{key_path.rstrip('/')}/v????????`")


#: Seconds to wait for another writer's part.
KEY_WAIT = 600.0


def store_keys(df: DataFrame, id_column: str, key_path: str,
               key_column: str = KEY_COLUMN) -> DataFrame:
    """Add keys for subjects of ``df`` that have none to the key table at
    ``key_path`` and return the stored table (read back, so fixed).

    The table is a row of numbered parts, each holding only new subjects. A
    writer claims the next number and computes its subjects against *all* parts
    before it, which are committed by then; a part can so never repeat a subject
    of another, whoever started first. A writer that finds the number claimed
    waits for that part; a writer that died holds it up for ``versioned.STALE``
    seconds."""
    import time

    spark = df.sparkSession
    deadline = time.time() + KEY_WAIT
    while True:
        with versioned.next_version(spark, key_path) as (number, current):
            if number is not None:
                existing = read_keys(spark, key_path, id_column, key_column) if current else None
                fresh = subject_keys(df, id_column, existing, key_column)
                versioned.write_version(fresh.withColumn("created_at", F.current_timestamp()),
                                        key_path, meta={}, number=number)
                break
        if time.time() > deadline:
            raise TimeoutError(f"another writer holds the next part of {key_path}")
        time.sleep(0.2)
    return read_keys(spark, key_path, id_column, key_column)


def _key_bytes(key: Column) -> Column:
    return F.unbase64(key)


def encrypt_value(value: Column, key: Column) -> Column:
    """base64(AES-GCM(value, key)); null stays null."""
    return F.base64(F.aes_encrypt(value.cast("string"), _key_bytes(key), F.lit("GCM")))


def decrypt_value(value: Column, key: Column, strict: bool = False) -> Column:
    """Inverse of :func:`encrypt_value`; '' passes through; a wrong key or
    damaged text gives null, or fails when ``strict`` (G5, U3)."""
    if strict:
        plain = F.aes_decrypt(F.unbase64(value), _key_bytes(key), F.lit("GCM"))
    else:
        plain = F.try_aes_decrypt(F.try_to_binary(value, F.lit("base64")),
                                  _key_bytes(key), F.lit("GCM"))
    return F.when(value == F.lit(""), value).otherwise(plain.cast("string"))


def _with_keys(df: DataFrame, keys: DataFrame, id_column: str, key_column: str,
               strategy: str, require: bool) -> DataFrame:
    """``df`` with its subject's key as ``__key``. With ``require``, a row
    whose subject has no key, or that has no subject id at all, fails the job
    (lazily, in the same pass): encrypting it would either lose or leak it."""
    k = keys.select(F.col(id_column), F.col(key_column).alias("__key"))
    joined = joins.join(df, k, id_column, "left", strategy=strategy)
    if not require:
        return joined
    who = F.coalesce(F.col(id_column).cast("string"), F.lit("NULL"))
    return joined.where(F.when(F.col("__key").isNull(), F.raise_error(
        F.concat(F.lit(f"no encryption key for {id_column} = "), who))).otherwise(F.lit(True)))


def encrypt_columns(df: DataFrame, keys: DataFrame, id_column: str, columns,
                    key_column: str = KEY_COLUMN, strategy: str = "auto") -> DataFrame:
    """Encrypt ``columns`` of each row with its subject's key.

    The key table has one row per subject. With ``auto`` Spark chooses the join:
    a small key table is broadcast; else both sides are shuffled into a merge
    join, where adaptive execution can split a hot subject's partition, since
    nothing stands between the exchanges and the join."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    j = _with_keys(df, keys, id_column, key_column, strategy, require=True)
    out = [encrypt_value(F.col(c), F.col("__key")).alias(c)
           if c.lower() in {x.lower() for x in columns} else F.col(c) for c in df.columns]
    return j.select(*out)


def decrypt_columns(df: DataFrame, keys: DataFrame, id_column: str, columns,
                    key_column: str = KEY_COLUMN, strict: bool = False,
                    strategy: str = "auto") -> DataFrame:
    """Decrypt ``columns`` with each subject's key (G5). A row without a key
    decrypts to null, or fails the job when ``strict``."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    j = _with_keys(df, keys, id_column, key_column, strategy, require=strict)
    low = {x.lower() for x in columns}
    out = [decrypt_value(F.col(c), F.col("__key"), strict).alias(c)
           if c.lower() in low else F.col(c) for c in df.columns]
    return j.select(*out)


DECRYPT_SQL = ("CASE WHEN text IS NULL OR text = '' THEN text ELSE "
               "CAST(try_aes_decrypt(try_to_binary(text, 'base64'), unbase64(key), 'GCM') "
               "AS STRING) END")


def register_sql_functions(spark: SparkSession, persistent: bool = False,
                           name: str = "decrypt_val") -> None:
    """SQL ``decrypt_val(text STRING, key STRING) RETURNS STRING``.

    ``persistent=True`` stores it in the catalog (needs a persistent catalog,
    e.g. Hive support) so persistent views can use it."""
    kind = "FUNCTION" if persistent else "TEMPORARY FUNCTION"
    spark.sql(f"CREATE OR REPLACE {kind} {name}(text STRING, key STRING) "
              f"RETURNS STRING RETURN {DECRYPT_SQL}")
    # Key generation for SQL users, e.g.
    # SELECT ID, new_encryption_key(ID) FROM (SELECT DISTINCT ID FROM t)
    spark.udf.register("new_encryption_key", new_key)


def create_clear_view(spark: SparkSession, table: str, keys_table: str, id_column: str,
                      columns, view: str, key_column: str = KEY_COLUMN,
                      persistent: bool = False, function: str = "decrypt_val") -> None:
    """A view showing ``table`` with ``columns`` decrypted (G8, K10); the base
    table stays encrypted for everyone else."""
    columns = {c.lower() for c in ([columns] if isinstance(columns, str) else columns)}
    cols = spark.table(table).columns
    select = ", ".join(
        f"{function}(t.`{c}`, k.`{key_column}`) AS `{c}`" if c.lower() in columns
        else f"t.`{c}`" for c in cols)
    kind = "VIEW" if persistent else "TEMPORARY VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {view} AS SELECT {select} FROM {table} t "
              f"LEFT JOIN {keys_table} k ON t.`{id_column}` = k.`{id_column}`")


def create_masked_and_clear_views(spark: SparkSession, table: str, keys_table: str,
                                  id_column: str, columns, schema: str | None = None,
                                  persistent: bool = False) -> tuple[str, str]:
    """Two views over one encrypted table (G8): ``<table>_masked`` as stored
    (cipher text) for ordinary readers and ``<table>_admin`` decrypted, both in
    ``schema`` when given. Returns their names."""
    prefix = f"{schema}." if schema else ""
    base_name = table.split(".")[-1]
    masked, clear = f"{prefix}{base_name}_masked", f"{prefix}{base_name}_admin"
    kind = "VIEW" if persistent else "TEMPORARY VIEW"
    if schema and persistent:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    if not persistent:
        masked, clear = masked.replace(".", "_"), clear.replace(".", "_")
    spark.sql(f"CREATE OR REPLACE {kind} {masked} AS SELECT * FROM {table}")
    fn = f"{schema}.decrypt_val" if (schema and persistent) else "decrypt_val"
    register_sql_functions(spark, persistent=persistent, name=fn)
    create_clear_view(spark, table, keys_table, id_column, columns, clear,
                      persistent=persistent, function=fn)
    return masked, clear


def refuse_encrypted(spark: SparkSession, base: str, columns) -> set[str]:
    """The encrypted columns of a versioned table; fails if one of ``columns`` is
    among them."""
    done = {c.lower() for c in versioned.read_meta(spark, base).get("encrypted", [])}
    again = [c for c in columns if c.lower() in done]
    if again:
        raise ValueError(f"already encrypted: {again}")
    return done


def encrypt_table(base: str, keys: DataFrame, id_column: str, columns,
                  table: str | None = None, key_column: str = KEY_COLUMN) -> str:
    """Encrypt the current version of a versioned table into its next version
    (the read-transform-overwrite of G4 + K4). Refuses a second pass over a
    column that is already encrypted. Earlier versions, which hold clear text, are
    removed once the encrypted one is committed and ``table`` points at it."""
    v = versioned
    spark = keys.sparkSession
    columns = [columns] if isinstance(columns, str) else list(columns)
    done = refuse_encrypted(spark, base, columns)
    meta = v.read_meta(spark, base)
    current = v.read_current(spark, base)
    out = encrypt_columns(current, keys, id_column, columns, key_column)
    meta = dict(meta, encrypted=sorted(done | {c.lower() for c in columns}))
    path = v.write_version(out, base, table=table, meta=meta)
    v.remove_old_versions(spark, base, keep=1)
    return path
