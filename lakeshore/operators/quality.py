"""Data-quality expectations (Q1, Q2, A4).

An expectation is a named SQL predicate. A row passes when the predicate is
TRUE; FALSE and NULL both fail. Three actions, as in declarative pipelines:

* ``drop``  keep only rows that pass every expectation (``expect_or_drop``);
* ``warn``  keep every row, only count;
* ``fail``  stop the job at the first failing row.

Counting never costs a second scan: :func:`expect` attaches the pass/fail sums
to the same plan through ``DataFrame.observe``, so they are computed as partial
aggregates inside the tasks that already read the rows and merged on the driver
as one tiny row per task. :func:`quality_counts` gives the same counts grouped by
a dataset column as an ordinary (map-side combined) aggregate.
"""

from __future__ import annotations

import itertools
import threading
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_ACTIONS = ("drop", "warn", "fail")
_observation_ids = itertools.count()


def _rules(rules) -> list[tuple[str, Column]]:
    """Normalise ``{name: predicate}`` or ``[(name, predicate)]``; a predicate
    is SQL text or a Column."""
    items = rules.items() if isinstance(rules, Mapping) else rules
    out = []
    for name, pred in items:
        out.append((name, F.expr(pred) if isinstance(pred, str) else pred))
    if not out:
        raise ValueError("at least one expectation is needed")
    return out


def passes(predicate: Column) -> Column:
    """TRUE only when the predicate is TRUE (NULL fails)."""
    return F.coalesce(predicate, F.lit(False))


def all_pass(rules) -> Column:
    cond = F.lit(True)
    for _, pred in _rules(rules):
        cond = cond & passes(pred)
    return cond


def expect(df: DataFrame, rules, dataset: str = "dataset", action: str = "drop",
           observation: Observation | None = None) -> tuple[DataFrame, Observation]:
    """Apply expectations; returns the result and an ``Observation`` whose
    ``get`` (after the first action on the result) holds, per rule,
    ``passed:<name>`` / ``failed:<name>``, plus ``input_rows`` and
    ``output_rows``. The counts belong to the first action that runs the
    result (normally the write of the dataset). For a streaming DataFrame the
    second value is the metric name instead; :class:`StreamCounts` adds the
    counts of its micro-batches up."""
    if action not in _ACTIONS:
        raise ValueError(f"action must be one of {_ACTIONS}, not {action!r}")
    rules = _rules(rules)
    name = f"expect_{dataset}_{next(_observation_ids)}_{uuid.uuid4().hex[:8]}"
    # A stream reports the counts per micro-batch in its progress
    # (``observedMetrics[name]``); see :class:`StreamCounts`.
    obs = name if df.isStreaming else (observation or Observation(name))
    ok_all = all_pass(rules)
    metrics = [F.count(F.lit(1)).alias("input_rows")]
    for name, pred in rules:
        passed = F.sum(F.when(passes(pred), 1).otherwise(0)).cast("long")
        metrics.append(passed.alias(f"passed:{name}"))
        metrics.append((F.count(F.lit(1)) - passed).alias(f"failed:{name}"))
    kept = F.sum(F.when(ok_all, 1).otherwise(0)) if action == "drop" else F.count(F.lit(1))
    metrics.append(kept.cast("long").alias("output_rows"))
    observed = df.observe(obs, *metrics)
    if action == "drop":
        out = observed.where(ok_all)
    elif action == "fail":
        names = ", ".join(n for n, _ in rules)
        out = observed.where(F.when(ok_all, F.lit(True)).otherwise(
            F.raise_error(F.lit(f"expectation failed on dataset {dataset}: {names}"))))
    else:
        out = observed
    return out, obs


def expect_or_drop(df: DataFrame, name: str, predicate, dataset: str = "dataset"):
    """The single-rule drop form used by pipelines (Q1)."""
    return expect(df, [(name, predicate)], dataset=dataset, action="drop")


def observed_expectations(obs: Observation, rules, dataset: str) -> list[dict]:
    """Observation result → expectation records for the event log."""
    got = obs.get
    return [{"dataset": dataset, "name": name,
             "passed_records": int(got[f"passed:{name}"] or 0),
             "failed_records": int(got[f"failed:{name}"] or 0)}
            for name, _ in _rules(rules)]


class StreamCounts(StreamingQueryListener):
    """Adds up every micro-batch of one streaming query: rows read, and the counts
    of a streaming :func:`expect`. (``query.recentProgress`` holds only the last
    batches.) Attach before the start, ``wait`` after the end::

        with StreamCounts(spark, metric) as counts:
            q = start(...)
            q.awaitTermination()
            counts.wait(q)
    """

    def __init__(self, spark: SparkSession, metric: str | None = None):
        self.spark, self.metric = spark, metric
        self.batches: dict[str, dict[int, dict]] = {}
        self.ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> StreamCounts:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counts = {"rows": int(p.numInputRows)}
        row = (p.observedMetrics or {}).get(self.metric) if self.metric else None
        if row is not None:
            counts |= {k: int(v or 0) for k, v in row.asDict().items()}
        self.batches.setdefault(str(p.runId), {})[int(p.batchId)] = counts

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, query, seconds: float = 600.0) -> dict[str, int]:
        """Totals of ``query``, which has ended. Its end is reported after all its
        batches."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError("the end of the streaming query was not reported")
        totals: dict[str, int] = {}
        for counts in self.batches.get(str(query.runId), {}).values():
            for k, v in counts.items():
                totals[k] = totals.get(k, 0) + v
        return totals


def stream_expectations(totals: Mapping[str, int], rules, dataset: str) -> list[dict]:
    """Totals of :class:`StreamCounts` → expectation records for the event log."""
    return [{"dataset": dataset, "name": n, "passed_records": totals.get(f"passed:{n}", 0),
             "failed_records": totals.get(f"failed:{n}", 0)} for n, _ in _rules(rules)]


def quality_counts(df: DataFrame, rules, dataset_col: str | None = None,
                   dataset: str = "dataset") -> DataFrame:
    """Pass/fail counts per (dataset, expectation) as a DataFrame (Q2, A4).

    One aggregate over the data, grouped by ``dataset_col`` when given (it
    combines map-side, so a hot dataset value costs one row per task before the
    shuffle), then one output row per rule. Columns: dataset, name,
    passed_records, failed_records."""
    rules = _rules(rules)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, (_, pred) in enumerate(rules):
        aggs.append(F.sum(F.when(passes(pred), 1).otherwise(0)).cast("long").alias(f"__p{i}"))
    if dataset_col:
        grouped = df.groupBy(F.col(dataset_col).alias("dataset")).agg(*aggs)
    else:
        grouped = df.agg(*aggs).withColumn("dataset", F.lit(dataset))
    per_rule = F.array(*[
        F.struct(F.lit(name).alias("name"),
                 F.col(f"__p{i}").alias("passed_records"),
                 (F.col("__n") - F.col(f"__p{i}")).alias("failed_records"))
        for i, (name, _) in enumerate(rules)])
    return grouped.select("dataset", F.inline(per_rule))


def rule_names(rules) -> Sequence[str]:
    return [n for n, _ in _rules(rules)]
