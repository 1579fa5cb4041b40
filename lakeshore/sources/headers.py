"""CSV by header: every file is read by the names in its own first line.

Spark applies one schema to all files of a CSV read by position, so files whose
columns stand in another order, or that have more or fewer of them, are silently
misread. Here the first line of every file is found first (one more pass over the
files as text; one line a file leaves a task), files are grouped by it, and each
distinct header gets a read and a projection of its own: known columns by name
(letter case does not matter), missing ones null, and the rest by choice in a
*rescue* column, as new columns, or as an error.

The rescue column is JSON text, null for a row that lost nothing: values of columns
that the schema does not have, values that their type cannot hold (the column itself
is null then), ``_raw`` for a line with more or fewer values than its header, and
``_file_path``. A name that comes again in one header counts as another unknown
column, ``name#<place>``. Headers are one line each; blank lines before them are
skipped. An empty file has no rows.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: The usual name of the rescue column.
RESCUED = "_rescued_data"
#: Distinct headers that one read may meet; each is a part of the plan.
MAX_HEADERS = 500
_CORRUPT = "__corrupt"
_POLICIES = ("rescue", "add", "fail")


def _literal(path: str) -> str:
    """A path as a pattern that matches only itself."""
    return re.sub(r"([\\\[\]{}*?^])", r"\\\1", path)


def file_headers(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """{columns of a header: its files}, in order of the files' names.

    The files' names reach the driver, as Spark's own listing of them does."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value",
        F.monotonically_increasing_id().alias("n"))
    lines = lines.where((F.col("at") == 0) & (F.trim("value") != ""))
    first = lines.groupBy("file").agg(F.min_by("value", "n").alias("line")).collect()
    uri = spark._jvm.java.net.URI
    as_path = lambda u: spark._jvm.org.apache.hadoop.fs.Path(uri(u)).toString()
    out: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted((r["file"], r["line"]) for r in first):
        names = next(csv.reader([line.removeprefix("﻿").rstrip("\r")], delimiter=sep))
        out.setdefault(tuple(n.strip() for n in names), []).append(as_path(file))
    if len(out) > MAX_HEADERS:
        raise ValueError(f"{len(out)} distinct headers, at most {MAX_HEADERS} can be read at once")
    return out


def header_schema(headers, schema: StructType | None = None) -> StructType:
    """``schema`` and after it, as text, what else the headers name, each once."""
    fields = list(schema.fields) if schema is not None else []
    known = {f.name.lower() for f in fields}
    for names in headers:
        for name in names:
            if name and name.lower() not in known:
                known.add(name.lower())
                fields.append(StructField(name, StringType()))
    return StructType(fields)


def _of(schema: StructType | str | None, spark: SparkSession) -> StructType | None:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _projection(names: tuple[str, ...], schema: StructType, rescue: str | None) -> list[Column]:
    """The columns of ``schema`` and the rescue column, over a read whose columns are
    called by their places."""
    place: dict[str, int] = {}
    extra: list[tuple[str, Column]] = []
    known = {f.name.lower() for f in schema.fields}
    for i, name in enumerate(names):
        if name.lower() in known and name.lower() not in place:
            place[name.lower()] = i
        else:
            label = name if name and name.lower() not in place else f"{name}#{i}"
            place.setdefault(name.lower(), i)
            extra.append((label, F.col(f"c{i}")))
    out = []
    for f in schema.fields:
        i = place.get(f.name.lower())
        if i is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.col(f"c{i}")
        if isinstance(f.dataType, StringType):
            out.append(text.alias(f.name))
            continue
        value = text.try_cast(f.dataType)
        out.append(value.alias(f.name))
        extra.append((f.name, F.when(value.isNull(), text)))
    if rescue:
        extra.append(("_raw", F.col(_CORRUPT)))
        pairs = F.map_filter(F.map_from_arrays(F.array(*[F.lit(n) for n, _ in extra]), F.array(*[c for _, c in extra])),
                             lambda _, v: v.isNotNull())
        path = F.create_map(F.lit("_file_path"), F.col("_metadata.file_path"))
        out.append(F.when(F.size(pairs) > 0, F.to_json(F.map_concat(pairs, path))).alias(rescue))
    return out


def read_by_header(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None,
                   rescue: str | None = RESCUED, unknown: str | None = None, sep: str = ",",
                   options: dict[str, str] | None = None,
                   headers: dict[tuple[str, ...], list[str]] | None = None) -> DataFrame:
    """CSV files, folders or patterns read by their headers.

    Without a ``schema`` all columns of all headers are read, as text. With one,
    ``unknown`` says what becomes of other columns: ``rescue`` (the default if there
    is a rescue column), ``add`` (text columns after the schema's; the default
    without one), or ``fail``."""
    unknown = unknown or ("rescue" if rescue else "add")
    if unknown not in _POLICIES or (unknown == "rescue" and not rescue):
        raise ValueError(f"unknown columns can't be handled by {unknown!r} with rescue column {rescue!r}")
    schema = _of(schema, spark)
    headers = file_headers(spark, paths, sep) if headers is None else headers
    full = header_schema(headers, schema)
    if schema is not None and unknown == "fail" and len(full) > len(schema):
        raise ValueError(f"columns {full.names[len(schema):]} are not in the schema")
    if schema is None or unknown == "add":
        schema = full
    parts = []
    for names, files in headers.items():
        places = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))]
                            + [StructField(_CORRUPT, StringType())])
        part = (spark.read.schema(places).options(**(options or {})).option("header", True).option("sep", sep)
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
                .csv([_literal(f) for f in files]))
        parts.append(part.select(*_projection(names, schema, rescue)))
    if not parts:
        return spark.createDataFrame([], StructType(
            list(schema.fields) + ([StructField(rescue, StringType())] if rescue else [])))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
