"""Pipeline event log.

One row per flow event: ``id, timestamp, sequence, event_type, message, level,
details`` where ``details`` is JSON text shaped as::

    {"flow_progress": {"status": ...,
                       "metrics": {"num_output_rows": n},
                       "data_quality": {"dropped_records": n,
                                        "expectations": [{"dataset", "name",
                                                          "passed_records",
                                                          "failed_records"}]}}}

The log is an append-only parquet table; the report reads it with one
``from_json`` of the whole ``details`` shape per row instead of re-parsing the
text once per path.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (the event-log contract): the expectations element type, and
# the log's columns in order.
EXPECTATIONS_DDL = ("array<struct<dataset: string, failed_records: bigint, "
                    "name: string, passed_records: bigint>>")
DETAILS_DDL = (
    "struct<flow_progress: struct<status: string, "
    "metrics: struct<num_output_rows: bigint>, "
    f"data_quality: struct<dropped_records: bigint, expectations: {EXPECTATIONS_DDL}>>>")
LOG_COLUMNS = ("id", "timestamp", "sequence", "event_type", "message", "level", "details")


def details_json(status: Column, num_output_rows: Column, dropped_records: Column,
                 expectations: Column) -> Column:
    """Build the ``details`` JSON text from columns (Q3)."""
    return F.to_json(F.struct(F.struct(
        status.alias("status"),
        F.struct(num_output_rows.cast("long").alias("num_output_rows")).alias("metrics"),
        F.struct(dropped_records.cast("long").alias("dropped_records"),
                 expectations.alias("expectations")).alias("data_quality"),
    ).alias("flow_progress")))


def flow_event(spark: SparkSession, dataset: str, status: str, output_rows: int,
               dropped_records: int = 0, expectations: list[dict] | None = None,
               message: str | None = None, level: str = "INFO",
               timestamp: _dt.datetime | None = None) -> DataFrame:
    """One ``flow_progress`` event as a one-row DataFrame, ready to append. A
    timestamp without a zone is UTC, whatever the driver's zone; ``sequence`` is
    the time it was made in nanoseconds as text of fixed width, so events of one
    instant keep their order."""
    ts = timestamp or _dt.datetime.now(_dt.timezone.utc)
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=_dt.timezone.utc)
    exp = expectations or []
    row = spark.createDataFrame(
        [(str(uuid.uuid4()), ts, status, int(output_rows), int(dropped_records), exp)],
        f"id string, timestamp timestamp, status string, out bigint, dropped bigint, "
        f"exp {EXPECTATIONS_DDL}")
    exp_col = F.when(F.size("exp") > 0, F.col("exp"))
    return row.select(
        "id", "timestamp",
        F.lit(f"{time.time_ns():020d}").alias("sequence"),
        F.lit("flow_progress").alias("event_type"),
        F.lit(message or f"Flow '{dataset}' is {status}.").alias("message"),
        F.lit(level).alias("level"),
        details_json(F.col("status"), F.col("out"), F.col("dropped"), exp_col).alias("details"))


_APPEND = "__append"


def append_events(events: DataFrame, log_path: str, files: int | None = None) -> None:
    """Append events to the log (parquet). Each append is its own small
    partition folder ``tail/__append=<time>_<id>`` (a one-row flow event is one
    file); :func:`compact_log` folds them into one table version so the folder
    count stays small."""
    tag = f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    out = events.select(*LOG_COLUMNS)
    if files:
        out = out.coalesce(files)
    (out.write.mode("append").parquet(f"{log_path.rstrip('/')}/tail/{_APPEND}={tag}"))


def _tail_parts(spark: SparkSession, log_path: str) -> list[str]:
    from lakeshore.sinks import versioned

    fs, p = versioned._fs(spark, f"{log_path.rstrip('/')}/tail")
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p)
                  if st.isDirectory() and st.getPath().getName().startswith(_APPEND + "="))


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The whole log: the compacted base version plus the appends it does not
    hold yet."""
    from lakeshore.sinks import versioned

    base = f"{log_path.rstrip('/')}/base"
    folded = set(versioned.read_meta(spark, base).get("appends", []))
    parts = [f"{log_path.rstrip('/')}/tail/{n}" for n in _tail_parts(spark, log_path)
             if n not in folded]
    frames = []
    if versioned.current_path(spark, base):
        frames.append(versioned.read_current(spark, base).select(*LOG_COLUMNS))
    if parts:
        frames.append(spark.read.parquet(*parts).select(*LOG_COLUMNS))
    if not frames:
        raise FileNotFoundError(f"no events under {log_path}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def compact_log(spark: SparkSession, log_path: str) -> str | None:
    """Fold all appends into a new base version (recording which), then
    remove the folded append folders. Safe to interrupt: readers skip appends
    the current base already holds. Only one compaction runs at a time; another
    leaves the work to it (None). The rewrite is rebalanced by adaptive
    execution into files of the advisory partition size, however large the
    log has grown (no single-task funnel)."""
    from lakeshore.sinks import versioned

    base = f"{log_path.rstrip('/')}/base"
    with versioned.next_version(spark, base) as (number, _):
        parts = _tail_parts(spark, log_path) if number else []
        if not parts:
            return None
        folded = read_log(spark, log_path)  # base + unfolded tails listed now
        # those listed now, folded before or not; names of folders long gone are let go
        path = versioned.write_version(folded.hint("rebalance"), base, meta={"appends": parts}, number=number)
        for name in parts:
            fs, p = versioned._fs(spark, f"{log_path.rstrip('/')}/tail/{name}")
            if fs.exists(p):
                fs.delete(p, True)
        versioned.remove_old_versions(spark, base, keep=2)
    return path


def ordered_log(log: DataFrame) -> DataFrame:
    """The raw log in time order (Q4)."""
    return log.select(*LOG_COLUMNS).orderBy(F.col("timestamp").asc())


def expectation_report(log: DataFrame) -> DataFrame:
    """``COMPLETED`` flow events that carry expectations, one row per
    expectation, with output and dropped counts as text (Q5, X3-X5, F4, F5).

    ``details`` is parsed once per row. The status test sits inside the
    exploded array (a null array yields no row, as a null or malformed
    ``expectations`` does) rather than in a filter: a filter would be pushed
    below the parse and repeat it once per condition."""
    parsed = log.select("id", "timestamp",
                        F.from_json("details", DETAILS_DDL).alias("__d"))
    fp = F.col("__d.flow_progress")
    completed = F.when(fp["status"] == F.lit("COMPLETED"),
                       fp["data_quality"]["expectations"])
    return parsed.select(
        "id", "timestamp",
        fp["metrics"]["num_output_rows"].cast("string").alias("output_records"),
        fp["data_quality"]["dropped_records"].cast("string").alias("dropped_records"),
        fp["status"].alias("status_update"),
        F.explode(completed).alias("expectations"))


def json_path(column: str | Column, path: str) -> Column:
    """Text of a JSON path such as ``flow_progress.status``."""
    col = F.col(column) if isinstance(column, str) else column
    return F.get_json_object(col, "$." + path.lstrip("$."))


# The report in SQL, over a log table or view, for SQL users. ``details`` is
# parsed once into a VARIANT and read with path syntax; as in the DataFrame
# form, the status test sits in the exploded array, not in a WHERE that would
# be pushed below the parse.
EXPECTATION_REPORT_SQL = f"""
SELECT id, timestamp,
       CAST(d:flow_progress.metrics.num_output_rows AS STRING) AS output_records,
       CAST(d:flow_progress.data_quality.dropped_records AS STRING) AS dropped_records,
       CAST(d:flow_progress.status AS STRING) AS status_update,
       explode(CASE WHEN CAST(d:flow_progress.status AS STRING) = 'COMPLETED'
                    THEN from_json(to_json(d:flow_progress.data_quality.expectations),
                                   '{EXPECTATIONS_DDL}') END) AS expectations
FROM (SELECT id, timestamp, try_parse_json(details) AS d FROM {{log}})
"""


def expectation_report_sql(spark: SparkSession, log_table: str) -> DataFrame:
    """:func:`expectation_report` written in SQL over a named log (Q5)."""
    return spark.sql(EXPECTATION_REPORT_SQL.format(log=log_table))
