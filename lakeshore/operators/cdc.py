"""Change apply: a change feed stored as slowly changing dimension type 1 or 2
(C1, C2, C4, W1, W2).

A change row carries keys K, a sequence S (one or more columns), a payload and
an optional delete predicate D. Order is by S, never by arrival:

* rows with a null key or sequence are quarantined, never applied;
* the same (K, S) twice collapses to one row, chosen by a fixed order
  (a delete wins, then the greatest payload);
* SCD 1 keeps, per K, the change of greatest S, and no row if that is a delete;
* SCD 2 turns every non-delete change into a version ``[__START_AT, __END_AT)``
  where ``__END_AT`` is the next sequence value of K over *all* changes,
  deletes included; a delete so closes the open version and opens none.

Plan shape. Building either form runs no job. SCD 1 ranks the changes of a key
and keeps the first; Spark limits the rank inside each task before the shuffle
(``WindowGroupLimit``), so a hot key or a flood of replayed copies shrinks to one
row per task. SCD 2 first does the same per (K, S), which collapses copies before
any shuffle, then needs the next S per key, i.e. an ordered window on K. A key
holding a large share of all rows would make that window one huge task, so keys
above ``rows_per_task`` (found in the same plan from a small sample of the key and
sequence columns) are split into chunks at sampled sequence values; the window runs
on (K, chunk), and the last row of a chunk takes the head of the next chunk, which
is the split point itself, looked up before the shuffle. Filters on the key reach
the scan; a lookup of a few keys passes ``rows_per_task=None`` and samples nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from lakeshore.operators.joins import read_bytes

# The validity columns of an SCD 2 history.
START_AT = "__START_AT"
END_AT = "__END_AT"
_DEL = "__is_delete"
_CHUNK = "__chunk"
_SPLITS = "__splits"
_NEXT = "__next"
_FROM, _TO, _BASE = "__from", "__to", "__base"

# Rows of one key above which the SCD 2 window is split (per window task).
DEFAULT_ROWS_PER_TASK = 20_000_000
# Sampled rows per chunk used to place the split points.
_SAMPLES_PER_CHUNK = 64
# Split points that are broadcast at most, a row being a byte of the sources or more.
MAX_SPLIT_POINTS = 8_000_000


def _names(cols) -> list[str]:
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def with_sequence(source: DataFrame, sequence_by) -> tuple[DataFrame, list[str]]:
    """Column names of the sequence. A sequence given as a Column expression
    (``col("ModifiedDate")``, ``to_timestamp(...)``) is added as a hidden
    column ``__seq<i>``, which output never shows."""
    items = [sequence_by] if isinstance(sequence_by, (str, Column)) else list(sequence_by)
    names = []
    for i, item in enumerate(items):
        if isinstance(item, Column):
            name = f"__seq{i}"
            source = source.withColumn(name, item)
            names.append(name)
        else:
            names.append(item)
    return source, names


def _delete_flag(apply_as_deletes) -> Column:
    if apply_as_deletes is None:
        return F.lit(False)
    cond = F.expr(apply_as_deletes) if isinstance(apply_as_deletes, str) else apply_as_deletes
    return F.coalesce(cond, F.lit(False))


def split_changes(source: DataFrame, keys, sequence_by, apply_as_deletes=None):
    """Mark deletes and split off rows that can never be applied.

    Returns ``(valid, quarantined)``; ``valid`` has a boolean ``__is_delete``."""
    keys, seq = _names(keys), _names(sequence_by)
    marked = source.withColumn(_DEL, _delete_flag(apply_as_deletes))
    bad = F.lit(False)
    for c in keys + seq:
        bad = bad | F.col(c).isNull()
    return marked.where(~bad), marked.where(bad).drop(_DEL)


def _payload(df: DataFrame, keys, seq) -> list[str]:
    skip = {c.lower() for c in keys + seq + [_DEL]}
    return [c for c in df.columns if c.lower() not in skip]


def _has_map(dt: DataType) -> bool:
    if isinstance(dt, MapType):
        return True
    if isinstance(dt, ArrayType):
        return _has_map(dt.elementType)
    if isinstance(dt, StructType):
        return any(_has_map(f.dataType) for f in dt.fields)
    return False


def _orderable(df: DataFrame, name: str) -> Column:
    """The column as a sort key: maps are not orderable in Spark, so a column
    holding one is compared through its JSON text."""
    if _has_map(df.schema[name].dataType):
        return F.to_json(F.col(name))
    return F.col(name)


def latest_of(df: DataFrame, cols: Sequence[str]) -> Column:
    """Aggregate: the struct of ``cols`` of the greatest row, ordered by
    ``cols`` in turn (nulls lowest). ``max(struct)`` when every column is
    orderable, else ``max_by`` with map columns compared as JSON text."""
    value = F.struct(*[F.col(c) for c in cols])
    if any(_has_map(df.schema[c].dataType) for c in cols):
        return F.max_by(value, F.struct(*[_orderable(df, c).alias(c) for c in cols]))
    return F.max(value)


def _dedupe(valid: DataFrame, keys, seq) -> DataFrame:
    """One row per (K, S): a delete wins, then the greatest payload. The
    aggregate combines map-side, so replayed copies never reach the shuffle."""
    payload = _payload(valid, keys, seq)
    picked = latest_of(valid, [_DEL] + payload).alias("__r")
    return (valid.groupBy(*keys, *seq).agg(picked)
            .select(*keys, *seq, *[F.col(f"__r.{c}") for c in [_DEL] + payload]))


def _first_per(df: DataFrame, part: Sequence[str], order: list[Column]) -> DataFrame:
    """The first row of each group. The rank filter lets Spark keep one row per
    group and task before the shuffle."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def scd1(source: DataFrame, keys, sequence_by, apply_as_deletes=None,
         except_columns: Sequence[str] = ()) -> DataFrame:
    """Current state per key (SCD type 1)."""
    visible = source.columns
    source, seq = with_sequence(source, sequence_by)
    keys = _names(keys)
    valid, _ = split_changes(source, keys, seq, apply_as_deletes)
    payload = _payload(valid, keys, seq)
    order = [F.col(c).desc() for c in seq] + _latest_first(valid, payload)
    out = _first_per(valid, keys, order).where(~F.col(_DEL))
    return _finish(out, visible, except_columns)


def _finish(df: DataFrame, source_cols, except_columns, extra=()) -> DataFrame:
    drop = {c.lower() for c in except_columns}
    cols = [c for c in source_cols if c.lower() not in drop] + list(extra)
    return df.select(*cols)


def rows_a_task(valid: DataFrame, rows_per_task: int) -> int:
    """``rows_per_task``, raised where the bytes that the plan reads would allow more
    than ``MAX_SPLIT_POINTS`` split points (rows / rows_per_task), so that a small
    value on a large feed does not let the broadcast grow with it. Runs no job. A
    source of unknown size (an RDD, a micro-batch) is not counted."""
    return max(rows_per_task, -(-read_bytes(valid) // MAX_SPLIT_POINTS))


def _hot_key_splits(valid: DataFrame, keys, seq, rows_per_task: int) -> DataFrame:
    """Sampled split points for keys with more than about ``rows_per_task`` rows:
    (keys, ``__from``, ``__to``, ``__base``, ``__splits``), lazily, as part of the
    caller's plan. A key's points stand in pages of ``_PAGE``: a page has those of its
    rows' range [``__from``, ``__to``) and the number of points before it.

    One pass over the key and sequence columns only: a Bernoulli sample of
    about ``_SAMPLES_PER_CHUNK`` rows per ``rows_per_task`` rows; a key with at
    least that many sampled rows is hot and every ``_SAMPLES_PER_CHUNK``-th
    sampled sequence value of it becomes a split point. The result holds at most
    ``total rows / rows_per_task`` points (50,000 for 10^12 rows), and
    :func:`rows_a_task` bounds them whatever ``rows_per_task`` is."""
    rows_per_task = rows_a_task(valid, rows_per_task)
    fraction = min(1.0, _SAMPLES_PER_CHUNK / float(rows_per_task))
    seq_struct = F.struct(*[F.col(c) for c in seq])
    sample = valid.select(*keys, seq_struct.alias("__s")).sample(fraction=fraction, seed=17)
    ranked = sample.withColumn("__rn", F.row_number().over(
        Window.partitionBy(*keys).orderBy("__s")))
    every = (ranked.where(F.col("__rn") % _SAMPLES_PER_CHUNK == 0).groupBy(*keys)
             .agg(F.array_sort(F.collect_set("__s")).alias("__all")))
    paged = every.withColumn(_BASE, F.explode(F.sequence(F.lit(0), F.size("__all") - 1, F.lit(_PAGE))))
    return paged.select(
        *keys, F.when(F.col(_BASE) > 0, F.try_element_at("__all", F.col(_BASE) + 1)).alias(_FROM),
        F.try_element_at("__all", F.col(_BASE) + 1 + _PAGE).alias(_TO), _BASE,
        F.slice("__all", F.col(_BASE) + 1, F.lit(_PAGE)).alias(_SPLITS))


#: Steps of the search for a row's chunk in its page, and the split points that they
#: reach. (Twice the steps make a method that the JVM leaves uncompiled.)
_STEPS = 16
_PAGE = (1 << _STEPS) - 1


def _with_page(df: DataFrame, pages: DataFrame, keys, seq_value: Column) -> DataFrame:
    """Each row with the page of split points that its sequence falls in, if its key
    has any; nearly every key with split points has one page."""
    names = [f"__key{i}" for i in range(len(keys))]
    pages = pages.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], _FROM, _TO, _BASE, _SPLITS)
    here = ((F.col(_FROM).isNull() | (F.col(_FROM) <= seq_value))
            & (F.col(_TO).isNull() | (seq_value < F.col(_TO))))
    for k, n in zip(keys, names):
        here = (F.col(k) == F.col(n)) & here
    return df.join(F.broadcast(pages), here, "left").drop(*names, _FROM)


def _with_chunk(df: DataFrame, seq_value: Column, first: str) -> DataFrame:
    """Add ``__chunk`` = number of split points <= the row's sequence, and
    ``__next`` = the head of the chunk after it, and drop the page, so that a
    row carries two values through the shuffle and not the list. A binary search
    over the sorted array, one projection per step (as one nested expression, each
    step would hold the previous one twice); keys without splits skip it."""
    out = df.withColumn(_CHUNK, F.lit(0)).withColumn("__size", F.coalesce(F.size(F.col(_SPLITS)), F.lit(0)))
    for i in reversed(range(_STEPS)):
        cand = F.col(_CHUNK) + F.lit(1 << i)
        ok = (cand <= F.col("__size")) & (F.try_element_at(F.col(_SPLITS), cand) <= seq_value)
        out = out.withColumn(_CHUNK, F.when(ok, cand).otherwise(F.col(_CHUNK)))
    out = out.withColumn(_CHUNK, F.coalesce(F.col(_CHUNK), F.lit(0)))
    out = out.withColumn(_NEXT, F.coalesce(F.try_element_at(F.col(_SPLITS), F.col(_CHUNK) + 1), F.col(_TO))[first])
    out = out.withColumn(_CHUNK, F.col(_CHUNK) + F.coalesce(F.col(_BASE), F.lit(0)))
    return out.drop("__size", _SPLITS, _TO, _BASE)


def _latest_first(df: DataFrame, payload) -> list[Column]:
    """Order inside one (K, S): a delete first, then the greatest payload
    (nulls last), the same total order as :func:`latest_of` in
    :func:`_dedupe`."""
    return [F.col(_DEL).desc()] + [_orderable(df, c).desc() for c in payload]


def scd2(source: DataFrame, keys, sequence_by, apply_as_deletes=None,
         except_columns: Sequence[str] = (),
         rows_per_task: int | None = DEFAULT_ROWS_PER_TASK,
         assume_unique: bool = False) -> DataFrame:
    """Full history per key (SCD type 2) with ``__START_AT`` / ``__END_AT``.

    Two shuffles: the (K, S) dedupe, which keeps one copy per task before it, and
    the ``lead`` window on K (plus the chunk of a hot key).
    ``rows_per_task=None`` turns the hot-key split off (one window task per
    key); ``assume_unique`` skips the dedupe when (K, S) is known unique."""
    visible = source.columns
    source, seq = with_sequence(source, sequence_by)
    keys = _names(keys)
    valid, _ = split_changes(source, keys, seq, apply_as_deletes)
    payload = _payload(valid, keys, seq)
    first = seq[0]
    part = list(keys)
    staged = valid if assume_unique else _first_per(
        valid, part + seq, _latest_first(valid, payload))
    if rows_per_task:
        # At most MAX_SPLIT_POINTS points, so broadcast; other keys find no row and
        # stay in chunk 0.
        splits = _hot_key_splits(valid, keys, seq, rows_per_task)
        at = F.struct(*[F.col(c) for c in seq])
        staged = _with_chunk(_with_page(staged, splits, keys, at), at, first)
        part.append(_CHUNK)
    end = F.lead(first).over(Window.partitionBy(*part).orderBy(*seq))
    if rows_per_task:
        end = F.coalesce(end, F.col(_NEXT))
    hist = staged.withColumn(END_AT, end)
    out = hist.where(~F.col(_DEL)).withColumn(START_AT, F.col(first))
    return _finish(out, visible, except_columns, extra=(START_AT, END_AT))


def apply_changes(source: DataFrame, keys, sequence_by, scd_type: int | str = 1,
                  apply_as_deletes=None, except_columns: Sequence[str] = (),
                  stored_as_scd_type: int | str | None = None,
                  except_column_list: Sequence[str] | None = None,
                  **kwargs) -> DataFrame:
    """Declared change apply: SCD type 1 or 2 of a change feed (batch form).

    ``stored_as_scd_type`` and ``except_column_list`` are accepted as the
    declarative-pipeline spellings of ``scd_type`` and ``except_columns``."""
    if stored_as_scd_type is not None:
        scd_type = stored_as_scd_type
    if except_column_list is not None:
        except_columns = except_column_list
    if str(scd_type) == "1":
        return scd1(source, keys, sequence_by, apply_as_deletes, except_columns)
    if str(scd_type) == "2":
        return scd2(source, keys, sequence_by, apply_as_deletes, except_columns, **kwargs)
    raise ValueError(f"scd_type must be 1 or 2, not {scd_type!r}")


def current_rows(history: DataFrame) -> DataFrame:
    """Open versions of an SCD 2 history: the "gold" table (C4)."""
    return history.where(F.col(END_AT).isNull())
