"""File sources: CSV batch and incremental stream, schema capture, and the
synthetic people generator (S1, S2, S5, S6, S7, S10, X7).

Without ``inferSchema`` a CSV read gives string columns. Files with a header are
read by it, each by its own (``headers.py``): columns in another order, missing or
added ones are never taken for each other. A streaming DataFrame has one schema,
applied by position, so :func:`stream_csv` refuses files whose header differs from
it; ``streaming.ingest`` takes those. The header option is always set on the stream
too: without it header lines arrive as data rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeshore.sources import headers

# Text form of timestamps in CSV: full microseconds, so a round trip is exact
# (Spark's default writes milliseconds only).
CSV_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_csv(spark: SparkSession, path: str, header: bool = True,
             schema: StructType | str | None = None, rescue: str | None = None,
             unknown: str | None = None) -> DataFrame:
    """Batch CSV scan of a file, folder or glob; all strings unless a schema
    is given (S1, S2). With a header, columns are found by name in every file;
    columns that a given schema does not have come after it as text, or go where
    ``rescue`` and ``unknown`` say (:func:`headers.read_by_header`). Without a rescue
    column a value that its type cannot hold is null, as in Spark's own reader."""
    if header:
        return headers.read_by_header(spark, path, schema, rescue, unknown, options=CSV_OPTIONS)
    reader = spark.read.option("header", False).options(**CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def capture_schema(spark: SparkSession, path: str, header: bool = True,
                   sample_files: str | None = None) -> StructType:
    """Schema of the CSV files under ``path`` as a batch read sees it (S7): the
    columns of all headers, in the order in which the files, by name, bring them."""
    if header:
        return headers.header_schema(headers.file_headers(spark, sample_files or path))
    return read_csv(spark, sample_files or path, header=False).schema


def stream_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
               header: bool = True, max_files: int | None = None,
               archive_dir: str | None = None) -> DataFrame:
    """Incremental CSV source over a folder (S5, S6, T1): each micro-batch
    takes files not seen before; the checkpoint of the sink remembers them. A file
    whose header differs from the schema ends the stream with an error.

    The source lists the folder every micro-batch, so a landing folder that
    only grows makes listing ever slower; ``archive_dir`` moves files out once
    their batch is committed (Spark's ``cleanSource=archive``), which keeps the
    listing to what has not been ingested yet."""
    if schema is None:
        schema = capture_schema(spark, path, header=header)
    reader = (spark.readStream.schema(schema).option("header", header).option("enforceSchema", not header)
              .options(**CSV_OPTIONS))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.csv(path)


# Fixed values of the people generator: ages 10 to 60 and these six countries.
PEOPLE_MIN_AGE = 10
PEOPLE_MAX_AGE = 60
PEOPLE_COUNTRIES = ("USA", "UK", "Australia", "Canada", "India", "dummy")
#: Names are three of these.
PEOPLE_SYLLABLES = ("an", "bel", "cor", "da", "el", "fin", "gus", "ha", "ir", "jo")


def people_from_ids(ids: DataFrame, id_column: str = "id") -> DataFrame:
    """People rows (Name, Age, Country) derived deterministically from ids
    (S10, X7): arithmetic on the id instead of a driver-side random generator,
    so the rows are reproducible, computed where the ids live, and checkable.
    ``Name`` is made of syllables by the digits of the id."""
    i = F.col(id_column).cast("long")
    span = PEOPLE_MAX_AGE - PEOPLE_MIN_AGE + 1
    age = (F.lit(PEOPLE_MIN_AGE) + F.pmod(i * F.lit(7919), F.lit(span))).cast("int")
    countries = F.array(*[F.lit(c) for c in PEOPLE_COUNTRIES])
    country = F.element_at(countries, (F.pmod(i * F.lit(31) + F.lit(7),
                                              F.lit(len(PEOPLE_COUNTRIES))) + 1).cast("int"))
    syllables = F.array(*[F.lit(s) for s in PEOPLE_SYLLABLES])
    n = len(PEOPLE_SYLLABLES)
    pick = lambda k: F.element_at(syllables, (F.pmod(F.floor(i / n ** k), F.lit(n)) + 1).cast("int"))
    name = F.initcap(F.concat(pick(0), pick(1), pick(2)))
    return ids.select(F.col(id_column).alias("id"), name.alias("Name"),
                      age.alias("Age"), country.alias("Country"))


def people(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """``n`` generated people rows over ``spark.range``."""
    return people_from_ids(spark.range(0, n, numPartitions=partitions))


def write_csv_files(df: DataFrame, path: str, files: int, header: bool = True,
                    by: str | None = None) -> None:
    """Land ``df`` as about ``files`` CSV files (a producer for the stream).

    ``by`` spreads rows by a hash of that column so each file holds a random
    slice of the data."""
    if by:
        out = df.repartition(files, F.col(by))
    else:
        out = df.repartition(files)
    out.write.mode("append").option("header", header).options(**CSV_OPTIONS).csv(path)
