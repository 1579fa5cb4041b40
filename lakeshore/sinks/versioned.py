"""Whole-table replacement without a transaction log (K1, K4, K6, K9).

A table is a base folder of immutable version folders ``v00000001``,
``v00000002``, ... A version is committed when Spark's job commit has written
its ``_SUCCESS`` marker; a failed or lost job leaves a folder without the marker,
which readers ignore and the next write skips over. So a read-transform-write of
the same table never reads and overwrites one folder (which would delete the
input first), a reader that already resolved a version keeps it, and a crash
mid-write leaves the previous version current. Version numbers are reserved
by creating a claim file exclusively, so concurrent writers get distinct
folders (the last committed one is current).

The catalog name is a view over the current version folder; re-pointing the
view after the write is the commit visible to SQL users. A schema change in the
new version is seen at once, unlike a table whose location is altered.
"""

from __future__ import annotations

import json
import re
import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_VERSION = re.compile(r"^v(\d{8})$")
_NUMBERED = re.compile(r"^v(\d{8})(?:\.claim)?$")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _version_dirs(spark: SparkSession, base: str) -> list[tuple[int, bool]]:
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _VERSION.match(st.getPath().getName())
        if st.isDirectory() and m:
            done = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
            out.append((int(m.group(1)), bool(done)))
    return sorted(out)


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed version numbers, oldest first."""
    return [n for n, done in _version_dirs(spark, base) if done]


def version_path(base: str, n: int) -> str:
    return f"{base.rstrip('/')}/v{n:08d}"


def current_path(spark: SparkSession, base: str) -> str | None:
    vs = versions(spark, base)
    return version_path(base, vs[-1]) if vs else None


def read_current(spark: SparkSession, base: str) -> DataFrame:
    path = current_path(spark, base)
    if path is None:
        raise FileNotFoundError(f"no committed version under {base}")
    return spark.read.parquet(path)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Small metadata file, written through the Hadoop file system API (no job)."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_meta(spark: SparkSession, base: str) -> dict:
    """Metadata stored with the current version ({} when none)."""
    path = current_path(spark, base)
    if path is None:
        return {}
    text = _read_text(spark, path + ".meta.json")
    return json.loads(text) if text else {}


def try_claim(spark: SparkSession, base: str, n: int) -> bool:
    """Reserve version number ``n`` by creating its claim file exclusively;
    False when another writer has it."""
    fs, p = _fs(spark, f"{version_path(base, n)}.claim")
    try:
        fs.create(p, False).close()
        return True
    except Exception as e:  # FileAlreadyExistsException from the JVM
        if "AlreadyExists" not in str(e) and "already exists" not in str(e):
            raise
        return False


def last_number(spark: SparkSession, base: str) -> int:
    """The highest version number that was ever claimed or written (0: none).
    Claims of writers that died count, so they are stepped over at once."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return 0
    numbers = [int(m.group(1)) for st in fs.listStatus(p)
               if (m := _NUMBERED.match(st.getPath().getName()))]
    return max(numbers, default=0)


def _claim(spark: SparkSession, base: str, n: int) -> int:
    """Reserve version number ``n``, or the next free one."""
    while not try_claim(spark, base, n):
        n = max(n, last_number(spark, base)) + 1
    return n


def give_up(spark: SparkSession, base: str, n: int) -> None:
    """Remove an uncommitted version and its claim, so its number is free."""
    path = version_path(base, n)
    for target in (path, path + ".meta.json", path + ".claim"):
        fs, p = _fs(spark, target)
        if fs.exists(p):
            fs.delete(p, True)


def claim_age(spark: SparkSession, base: str, n: int) -> float | None:
    """Seconds since version ``n`` was claimed; None when it is not."""
    import time

    fs, p = _fs(spark, f"{version_path(base, n)}.claim")
    if not fs.exists(p):
        return None
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


#: Seconds between signs of life of a claim's writer, and without one after which the
#: writer is taken for dead.
BEAT, STALE = 20.0, 180.0


@contextmanager
def next_version(spark: SparkSession, base: str):
    """Sole right to write the version after the current one: gives its number and
    the current one's (0: none), or (None, current) when another writer has it. The
    claim shows signs of life while it is held; one without any for ``STALE`` seconds
    belongs to a writer that died and is removed with what it wrote. Nothing is left
    if the block fails or does not commit."""
    done = versions(spark, base)
    current = done[-1] if done else 0
    number = current + 1
    if not try_claim(spark, base, number):
        age = claim_age(spark, base, number)
        if age is not None and age > STALE:
            give_up(spark, base, number)
        if age is None or age <= STALE or not try_claim(spark, base, number):
            yield None, current
            return
    stop = threading.Event()

    def beat() -> None:
        fs, p = _fs(spark, f"{version_path(base, number)}.claim")
        while not stop.wait(BEAT):
            try:
                fs.create(p, True).close()
            except Exception:  # the store is away for a moment: the next beat counts
                continue

    thread = threading.Thread(target=beat, daemon=True)
    thread.start()
    try:
        now = versions(spark, base)
        # committed by another between our look and our claim: nothing to do here
        yield (number if now == done else None), (now[-1] if now else 0)
    finally:
        stop.set()
        thread.join()
        if number not in versions(spark, base):
            give_up(spark, base, number)


def write_version(df: DataFrame, base: str, table: str | None = None,
                  partition_by=None, meta: dict | None = None, number: int | None = None) -> str:
    """Write ``df`` as the next version of ``base`` and re-point ``table``.

    ``meta`` is stored with the version; None carries over what the current
    version has, so a rewrite never forgets, say, which columns are encrypted.
    ``number`` is a version number that the caller has claimed. Returns the new
    version's path."""
    spark = df.sparkSession
    if meta is None:
        meta = read_meta(spark, base) or None
    n = number or _claim(spark, base, last_number(spark, base) + 1)
    path = version_path(base, n)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str)
                                      else partition_by))
    if meta is not None:
        # Written first: a version is only current once _SUCCESS exists.
        _write_text(spark, path + ".meta.json", json.dumps(meta, sort_keys=True))
    writer.parquet(path)
    if table:
        register(spark, table, path)
    return path


def register(spark: SparkSession, table: str, path: str, persistent: bool = False) -> None:
    """Point a catalog name at a parquet folder (K6, K9): a temp view by default,
    a persistent view when the session has a persistent catalog."""
    kind = "VIEW" if persistent else "TEMPORARY VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {table} AS SELECT * FROM parquet.`{path}`")


def register_current(spark: SparkSession, table: str, base: str) -> str:
    path = current_path(spark, base)
    if path is None:
        raise FileNotFoundError(f"no committed version under {base}")
    register(spark, table, path)
    return path


def remove_old_versions(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` committed versions, and uncommitted
    folders older than the current one. Readers still on a removed version
    fail, so keep at least as many as there are long-running readers."""
    dirs = _version_dirs(spark, base)
    done = [n for n, ok in dirs if ok]
    if len(done) <= keep:
        return []
    cutoff = done[-keep]
    removed = []
    for n, _ in dirs:
        if n < cutoff:
            path = version_path(base, n)
            for target in (path, path + ".meta.json", path + ".claim"):
                fs, p = _fs(spark, target)
                if fs.exists(p):
                    fs.delete(p, True)
            removed.append(path)
    return removed
