"""Raw quote snapshots: one JSON document per snapshot (bronze layer)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The snapshot document layout of the quotes API.
RAW_SCHEMA = T.StructType([
    T.StructField("result", T.StringType()),
    T.StructField("documentation", T.StringType()),
    T.StructField("terms_of_use", T.StringType()),
    T.StructField("time_last_update_unix", T.LongType()),
    T.StructField("time_last_update_utc", T.StringType()),
    T.StructField("time_next_update_unix", T.LongType()),
    T.StructField("time_next_update_utc", T.StringType()),
    T.StructField("base_code", T.StringType()),
    # read as a map: new codes need no schema change; rates stay text until
    # they are cast one by one, so a bad one can't take its neighbours along
    T.StructField("conversion_rates", T.MapType(T.StringType(), T.StringType())),
])

INDEX_COLS = [f.name for f in RAW_SCHEMA.fields if f.name != "conversion_rates"]

# Column that holds the text of a document that can't be read (kept only when
# bad documents are to be quarantined).
CORRUPT = "_corrupt_record"
CHECKED_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])

# Separator that makes a file one record.  No JSON text in UTF-8 holds a NUL, so
# nothing is cut; a text in UTF-16 or UTF-32 does have it and is malformed.
# Spark's multiLine mode opens the file again for every number that it reads as
# text (about 5 kB from a local disk, a request to a store): a record that is in
# memory gives the number's digits from there.
WHOLE_FILE = "{\0"


def _reader(reader, multiline: bool, quarantine: bool):
    schema = CHECKED_SCHEMA if quarantine else RAW_SCHEMA
    mode = "PERMISSIVE" if quarantine else "FAILFAST"
    if multiline:
        reader = reader.option("lineSep", WHOLE_FILE)
    return reader.schema(schema).option("mode", mode).option("columnNameOfCorruptRecord", CORRUPT)


def read_snapshots(spark: SparkSession, path: str | list[str], multiline: bool = True,
                   quarantine: bool = False) -> DataFrame:
    """Scan snapshot documents with the fixed schema (no inference pass).

    ``multiline=True`` for pretty-printed API files (one document per file, in
    UTF-8); ``False`` for JSON-lines folders written by ``land_snapshots``.

    A document that can't be read ends the job.  With ``quarantine`` it comes
    as a row that holds only its text, in the column ``_corrupt_record``
    (``silver.rejected`` collects those).
    """
    return _reader(spark.read, multiline, quarantine).json(path)


def stream_snapshots(spark: SparkSession, path: str, multiline: bool = True,
                     max_files_per_trigger: int | None = None,
                     archive_dir: str | None = None, quarantine: bool = False) -> DataFrame:
    """The same scan as a Structured Streaming file source.

    A file source lists its whole input folder on every trigger.  With
    ``archive_dir`` (outside ``path``), files of committed batches are moved
    there (``cleanSource=archive``), so the folder the stream lists holds only
    recent, unprocessed files and the listing does not grow with history.
    """
    r = _reader(spark.readStream, multiline, quarantine)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.json(path)


def snapshot_days(raw: DataFrame) -> list:
    """The distinct payload days of raw snapshots, from their headers only
    (no rate is parsed or exploded); a small list reaches the driver."""
    from tidemark.functions.timeparse import parse_rfc2822

    day = F.to_date(parse_rfc2822("time_last_update_utc"))
    return [r[0] for r in raw.select(day.alias("d")).distinct().collect()]


def land_snapshots(payloads: DataFrame, path: str, date_col: str = "ingest_date") -> None:
    """Write payload rows as JSON under ``<path>/<date_col>=<day>/``.

    Dynamic partition overwrite: a re-run for the same day replaces only that
    day's folder, other days stay.
    """
    (
        # rebalance: about one file per day, a hot day split by AQE
        payloads.hint("rebalance", date_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .json(path)
    )


def dated_snapshot_path(root: str, run_date=None, prefix: str = "exchange_rates") -> str:
    """Path of one day's snapshot file, ``<root>/<prefix>_<YYYY-MM-DD>.json``.

    ``run_date`` is a job parameter (a ``date`` or ISO text); default today.
    """
    import datetime as _dt

    day = run_date or _dt.date.today()
    return f"{root.rstrip('/')}/{prefix}_{day}.json"


#: Column that holds a document whose fields no schema fixes.
DOCUMENT = "document"


def read_variants(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Snapshot documents as one VARIANT each (column ``document``): nothing that
    a document holds is lost, whatever fields it has, and no schema is inferred.
    A document that can't be read ends the job."""
    reader = spark.read.option("singleVariantColumn", DOCUMENT).option("multiLine", multiline)
    return reader.option("mode", "FAILFAST").json(path)


def from_variants(variants: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """The raw snapshots (columns of ``RAW_SCHEMA``) in documents landed as
    VARIANT, and further ``fields`` (name -> type) that only some documents have;
    a field that is absent, or no such type, is NULL.  A name with dots leads
    into objects (``meta.source``)."""
    get = lambda name, kind: F.try_variant_get(DOCUMENT, f"$.{name}", kind)
    wanted = {f.name: f.dataType.simpleString() for f in RAW_SCHEMA.fields} | (fields or {})
    return variants.select(*[get(name, kind).alias(name.replace(".", "_")) for name, kind in wanted.items()])


def fields_of(variants: DataFrame) -> DataFrame:
    """(field, documents, of_type): the top-level fields that documents hold, how
    many hold them and of which types: what drifted, before anything is lost."""
    entries = variants.lateralJoin(variants.sparkSession.tvf.variant_explode(F.col(DOCUMENT).outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), r"^\w+", 0)
    return entries.groupBy(F.col("key").alias("field"), kind.alias("of_type")).agg(F.count(F.lit(1)).alias("documents"))
