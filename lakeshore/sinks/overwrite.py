"""Predicate overwrite, ``replaceWhere`` for plain parquet.

Semantics: every incoming row must satisfy the predicate, else the job fails
before anything is committed. Existing rows for which the predicate is TRUE are
replaced; FALSE *or NULL* rows stay. An empty incoming set deletes the matching
rows, and running the same replacement twice equals running it once.

The incoming check is an expression in the same plan (``raise_error`` on the
first violating row), so it costs no extra scan.

Two physical forms:

* :func:`replace_where_version` rewrites the table into a new version folder
  (any predicate);
* :func:`replace_where_partitions` rewrites only the partitions the predicate
  selects when it refers to partition columns alone: a dynamic partition
  overwrite of the incoming rows plus removal of selected partitions that
  receive no rows. Its cost is the incoming rows plus a folder listing, not
  the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lakeshore.sinks import versioned


def _pred(predicate) -> Column:
    return F.expr(predicate) if isinstance(predicate, str) else predicate


def checked_incoming(incoming: DataFrame, predicate) -> DataFrame:
    """``incoming`` with a lazy check that each row satisfies ``predicate``. The check
    counts as not deterministic, so that it stays above the filters of ``incoming``:
    below them it would see rows that they leave out."""
    ok = F.coalesce(_pred(predicate), F.lit(False)) & (F.spark_partition_id() >= 0)
    return incoming.where(F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.lit("replace_where: an incoming row does not satisfy the predicate"))))


def replace_where(existing: DataFrame, incoming: DataFrame, predicate) -> DataFrame:
    """Rows of ``existing`` where the predicate is not TRUE, plus ``incoming``."""
    kept = existing.where(~F.coalesce(_pred(predicate), F.lit(False)))
    return kept.unionByName(checked_incoming(incoming, predicate))


def replace_where_version(base: str, incoming: DataFrame, predicate,
                          table: str | None = None, partition_by=None,
                          encrypted: bool = False) -> str:
    """Apply :func:`replace_where` to the current version of ``base`` and
    commit the result as the next version, which keeps the metadata. A table
    with encrypted columns takes only rows that the caller says are encrypted
    (``encrypted=True``): clear rows among them would stay clear."""
    spark = incoming.sparkSession
    hidden = versioned.read_meta(spark, base).get("encrypted", [])
    if hidden and not encrypted:
        raise ValueError(f"columns {hidden} are encrypted: encrypt the incoming rows, "
                         "then pass encrypted=True")
    existing = versioned.read_current(spark, base)
    _same_columns(existing, incoming)
    out = replace_where(existing, incoming.select(*existing.columns), predicate)
    return versioned.write_version(out, base, table=table, partition_by=partition_by)


def _same_columns(existing: DataFrame, incoming: DataFrame) -> None:
    """Columns that the table does not have would be lost: refuse them."""
    known = {c.lower() for c in existing.columns}
    extra = [c for c in incoming.columns if c.lower() not in known]
    if extra:
        raise ValueError(f"replace_where: the table has no columns {extra}")


_NULL_DIR = "__HIVE_DEFAULT_PARTITION__"


def _partition_dirs(spark, path: str, partition_cols) -> list[tuple[list, str]]:
    """(values as text, folder) of every leaf partition folder under ``path``,
    read from the folder names (``col=value``, Spark's escaping undone)."""
    from urllib.parse import unquote

    level = [([], path.rstrip("/"))]
    for col in partition_cols:
        nxt = []
        for values, folder in level:
            fs, p = versioned._fs(spark, folder)
            if not fs.exists(p):
                continue
            for st in fs.listStatus(p):
                name = st.getPath().getName()
                if st.isDirectory() and name.startswith(col + "="):
                    text = name[len(col) + 1:]
                    value = None if text == _NULL_DIR else unquote(text)
                    nxt.append((values + [value], f"{folder}/{name}"))
        level = nxt
    return level


def replace_where_partitions(path: str, incoming: DataFrame, predicate, partition_cols,
                             existing: StructType | None = None) -> list[dict]:
    """In-place replacement of the partitions of a ``partitionBy`` table at
    ``path`` selected by a predicate on partition columns only.

    The selected partitions are found from the folder names alone (the
    predicate runs over a small table of partition values, no data file is
    opened); the incoming rows are written with a dynamic partition overwrite,
    which replaces exactly the partitions they fall in; selected partitions
    whose files are still those of before are then removed. Cost: the incoming rows plus a
    listing, whatever the table's size. Returns the emptied partitions.

    Empty text in a partition column is refused before anything is replaced: Spark
    writes it to the folder of null, whose rows would go (``replace_where_version``
    takes it). Columns that the table does not have are refused, unless ``existing``
    says what its columns are from now on (older files read as null there)."""
    spark = incoming.sparkSession
    partition_cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    existing = spark.read.parquet(path) if existing is None else spark.createDataFrame([], existing)
    _same_columns(existing, incoming)
    types = {f.name: f.dataType for f in existing.schema.fields}
    given = {f.name: f.dataType for f in incoming.schema.fields}
    pred = _pred(predicate)
    # Folder names are text; Spark guesses a type when it reads them ("2024" is
    # an int). The incoming rows know the real one, so the predicate sees the
    # same type on both sides, and folders are compared as folders.
    dirs = _partition_dirs(spark, path, partition_cols)
    selected = []
    if dirs:
        schema = ", ".join(f"`{c}` string" for c in partition_cols) + ", `__dir` string"
        values = spark.createDataFrame([tuple(v) + (d,) for v, d in dirs], schema)
        typed = values.select(*[F.col(c).cast(given[c]).alias(c) for c in partition_cols],
                              "__dir")
        selected = typed.where(F.coalesce(pred, F.lit(False))).collect()
    before = {row["__dir"]: _file_names(spark, row["__dir"]) for row in selected}
    staged = incoming.select(*[F.col(c) if c in partition_cols else F.col(c).cast(types[c]).alias(c)
                               for c in existing.columns])
    checked = checked_incoming(staged, pred)
    for c in partition_cols:
        if isinstance(given[c], StringType):
            checked = checked.withColumn(c, F.when(F.col(c) == "", F.raise_error(F.lit(
                f"replace_where: empty text in the partition column {c}"))).otherwise(F.col(c)))
    (checked.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))
    emptied = []
    for row in selected:
        # A folder that this write filled has new files and none of the old ones.
        if _file_names(spark, row["__dir"]) != before[row["__dir"]]:
            continue
        fs, p = versioned._fs(spark, row["__dir"])
        if fs.exists(p):
            fs.delete(p, True)
        emptied.append({c: row[c] for c in partition_cols})
    return emptied


def _file_names(spark, folder: str) -> set[str]:
    fs, p = versioned._fs(spark, folder)
    if not fs.exists(p):
        return set()
    return {st.getPath().getName() for st in fs.listStatus(p)}
