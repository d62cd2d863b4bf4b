"""Landing: files -> raw tables, typed flatten, bad-file handling, sinks.

S1 ingest_json, S2 ingest_rates_csv, S3 split_bad_files, S6 base views,
S8 append (schema kept beside the table), S10 rebuild, S12 write_clustered and
land_by_date, P1 flatten_messages, O5 report.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S
from . import files

# Typed payload fields of a deal message (path -> Spark type).
# Ids are text and the event time carries its own offset; the producer's
# ``status`` field is deliberately not carried.
MESSAGE_FIELDS = (
    ("trade_id", "string"), ("version", "bigint"), ("message_id", "string"), ("source_system", "string"),
    ("event_timestamp", "timestamp"), ("trade_date", "date"), ("maturity_date", "date"),
    ("product_type", "string"), ("counterparty", "string"), ("trader", "string"), ("book", "string"),
    ("currency", "string"), ("notional", "double"), ("price", "double"),
)

# The feeds derived from the given tables have numeric trade ids.
ADAPTER_FIELDS = tuple((n, "bigint" if n == "trade_id" else t) for n, t in MESSAGE_FIELDS)

FX_SCHEMA = "as_of_date date, currency string, rate_to_usd double"


# --- S1 ----------------------------------------------------------------------------
def ingest_json(spark: SparkSession, path: str, loaded_at: Column | None = None,
                file_name: Column | None = None) -> DataFrame:
    """JSON lines -> (raw VARIANT, line, file_name, loaded_at).

    Each line is parsed with ``try_parse_json`` so a malformed line gives a
    NULL ``raw`` instead of failing the load (the file-level decision is
    :func:`split_bad_files`). ``file_name`` defaults to the file's name from
    the scan metadata, ``loaded_at`` to the file's modification time.
    """
    df = spark.read.text(path)
    fn = file_name if file_name is not None else F.col("_metadata.file_name")
    la = loaded_at if loaded_at is not None else F.col("_metadata.file_modification_time").cast("timestamp_ntz")
    return df.select(F.try_parse_json("value").alias("raw"), F.col("value").alias("line"),
                     fn.alias("file_name"), la.alias("loaded_at"), *[c for c in df.columns if c != "value"])


def flatten(raw: Column, fields, strict: bool = True) -> list[Column]:
    """Typed columns from variant paths; ``strict`` raises on a bad cast
    (like a failing load), otherwise a bad value becomes NULL."""
    get = F.variant_get if strict else F.try_variant_get
    return [get(raw, f"$.{name}", typ).alias(name) for name, typ in fields]


def flatten_messages(landing: DataFrame, strict: bool = True, raw_col: str = "raw", fields=MESSAGE_FIELDS) -> DataFrame:
    """The 14 typed message fields plus file name and load time. The event
    time is converted from its own offset to UTC wall-clock time."""
    extra = [c for c in landing.columns if c not in (raw_col, "line")]
    out = landing.select(*flatten(F.col(raw_col), fields, strict), *extra)
    return out.withColumn("event_timestamp", utc_time("event_timestamp"))


def utc_time(instant: str) -> Column:
    """Wall-clock time in UTC of an instant, whatever the session's zone (no hour of it is doubled or skipped)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), S.lit_ts(dt.datetime(1970, 1, 1)))


# JSON is read as strictly as the variant reads it; a record of which from_json cannot read all is kept in CORRUPT
CORRUPT = "_corrupt"
QUICK_OPTIONS = {"columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
SPELLED = r'(?m)^(?:[-"\[{]|[0-9]+[.eE][-+.eE0-9]*$|[0-9]{19,}$)'  # a line that may be a number or nested value, as text spelled otherwise by the variant


def _quick_holds(read: Column, value: Column, typ: str) -> Column:
    """Whether ``value``, from a field that is no text as from_json ``read`` it in a valid record, is surely the cast of its variant."""
    if typ == "bigint":
        return F.lit(True)
    if typ == "double":
        return read.isNull() | (read != 0) | (read.cast("string") != "-0.0")
    if typ in ("date", "timestamp"):  # a number or truth value casts otherwise, but has no "-" there if its text casts at all
        return read.isNull() | (value.isNotNull() & (F.substring(read, 5, 1) == "-"))
    return read.isNull()


def _colons(text: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(":"), F.lit("")))


def flagged_messages(landing: DataFrame, raw_col: str = "raw", fields=MESSAGE_FIELDS) -> DataFrame:
    """P1 and the record test of S3 in one pass: every line typed, with ``bad`` set where it is not JSON or a field
    does not cast to its type (a typed field is NULL although the payload has a value for it).

    A line gives what its variant and the variant's casts give. As these cost several times a plain read, a record is
    typed by ``from_json``, and goes through them only where that might give something else: then all colons of the line
    but those in the values read are not one a value, so a key is unknown, nested, NULL or there twice, or a value is
    spelled otherwise. The steps stay small: a generated method over 8,000 bytes is never compiled."""
    extra = [c for c in landing.columns if c != raw_col]
    as_read = ", ".join(f"`{name}` {typ if typ in ('bigint', 'double') else 'string'}" for name, typ in fields)
    parsed = landing.withColumn("_q", F.from_json(raw_col, f"{as_read}, `{CORRUPT}` string", QUICK_OPTIONS))
    read = {name: F.col(f"_q.{name}") for name, _ in fields}
    cast = [(name, typ) for name, typ in fields if typ not in ("bigint", "double", "string")]
    texts = F.concat_ws("\n", *[read[name] for name, typ in fields if typ not in ("bigint", "double")])
    tried = parsed.select(F.col(raw_col).alias("_line"), "_q", texts.alias("_texts"), *[read[name].try_cast(typ).alias(f"_q_{name}") for name, typ in cast], *extra)
    value = {**read, **{name: F.col(f"_q_{name}") for name, _ in cast}}
    found = sum((read[name].isNotNull().cast("int") for name, _ in fields), F.lit(0))
    sure = (F.startswith("_line", F.lit("{")) & F.col(f"_q.{CORRUPT}").isNull() & ~F.contains("_line", F.lit("\\"))
            & (_colons("_line") - _colons("_texts") == found) & ~F.col("_texts").rlike(SPELLED))
    for name, typ in fields:
        if typ != "string":
            sure = sure & _quick_holds(read[name], value[name], typ)
    quick = F.struct(*[value[name].alias(name) for name, _ in fields])
    # all fields in one walk through the record; a field that does not cast is NULL
    record = F.try_variant_get("_v", "$", "struct<" + ",".join(f"{name}:{typ}" for name, typ in fields) + ">")
    tested = tried.withColumn("_sure", F.coalesce(sure, F.lit(False))).select(
        "_sure", F.when(~F.col("_sure"), F.try_parse_json("_line")).alias("_v"), F.when(F.col("_sure"), quick).alias("_q"), *extra)
    picked = tested.select("_sure", "_v", F.when(F.col("_sure"), F.col("_q")).otherwise(record).alias("_f"), *extra)
    typed = picked.select("_v", "_sure", *[F.col(f"_f.{name}").alias(name) for name, _ in fields], *extra)
    bad = F.col("_v").isNull()
    for name, typ in fields:
        if typ != "string":
            bad = bad | (F.col(name).isNull() & F.try_variant_get("_v", f"$.{name}", "string").isNotNull())
    out = typed.withColumn("bad", ~F.col("_sure") & bad).drop("_v", "_sure")
    return out.withColumn("event_timestamp", utc_time("event_timestamp"))


def unreadable(raw: Column, fields=MESSAGE_FIELDS) -> Column:
    """A record that cannot be loaded: not JSON, or a field that does not cast to its type."""
    bad = raw.isNull()
    for name, typ in fields:
        if typ != "string":
            bad = bad | (F.try_variant_get(raw, f"$.{name}", "string").isNotNull() & F.try_variant_get(raw, f"$.{name}", typ).isNull())
    return bad


# --- S3 ------------------------------------------------------------------------------
def split_bad_files(landing: DataFrame, bad: Column | None = None, file_col: str = "file_name"):
    """Skip-file semantics: one bad record excludes its whole file, other
    files load. Returns (good rows, per-file report of skipped files).

    One aggregation per file finds the bad files (a count per file: small);
    the rows of those files are removed with a left anti join, which AQE
    broadcasts when the bad-file list is small.
    """
    bad = bad if bad is not None else F.col("raw").isNull()
    flagged = landing.withColumn("_bad", bad)
    per_file = flagged.groupBy(file_col).agg(F.count(F.lit(1)).alias("row_count"),
                                             F.count_if("_bad").alias("error_count"))
    bad_files = per_file.filter(F.col("error_count") > 0)
    good = flagged.join(bad_files.select(file_col), file_col, "left_anti").drop("_bad")
    return good, bad_files


def load_report(landing: DataFrame, line_no: Column, file_col: str = "file_name") -> DataFrame:
    """Files not fully loaded: rows, parsed, errors, first error (by line)."""
    lines = landing.select(file_col, "loaded_at", line_no.alias("line_no"),
                           F.col("raw").isNotNull().alias("parsed_ok"))
    lines = lines.withColumn("error", F.when(~F.col("parsed_ok"), F.concat(
        F.lit("malformed JSON at line "), F.col("line_no").cast("string"))))
    g = lines.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("parsed_ok").alias("row_parsed"),
        F.count_if(~F.col("parsed_ok")).alias("error_count"),
        F.min_by("error", F.when(~F.col("parsed_ok"), F.col("line_no"))).alias("first_error_message"),
        F.max("loaded_at").alias("last_load_time"))
    return g.filter(F.col("error_count") > 0).withColumn("status", F.lit("LOAD_SKIPPED"))


# --- S2 ------------------------------------------------------------------------------
def ingest_rates_csv(spark: SparkSession, path: str, loaded_at: Column | None = None,
                     file_name: Column | None = None) -> DataFrame:
    """Rate files: one header line, positional (date, currency, rate) with an
    explicit schema (no inference); malformed rows are kept in
    ``_corrupt_record`` (PERMISSIVE) so a file-level skip can be applied."""
    schema = FX_SCHEMA + ", _corrupt_record string"
    df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))
    fn = file_name if file_name is not None else F.col("_metadata.file_name")
    la = loaded_at if loaded_at is not None else F.col("_metadata.file_modification_time").cast("timestamp_ntz")
    # the reader refuses a query on the corrupt column alone, so it is read together with the others
    beside = F.length(F.concat_ws(",", F.col("as_of_date").cast("string"), "currency", F.col("rate_to_usd").cast("string"))) >= 0
    return df.select("as_of_date", "currency", "rate_to_usd", fn.alias("file_name"), la.alias("loaded_at"),
                     F.when(beside, F.col("_corrupt_record")).alias("_corrupt_record"), *[c for c in df.columns if c not in
                                          ("as_of_date", "currency", "rate_to_usd", "_corrupt_record")])


# --- S6 ------------------------------------------------------------------------------
def base_view(df: DataFrame, name: str) -> DataFrame:
    """Raw passthrough view: the single place downstream code reads raw data from."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


# --- S8 / S10 / S12 ---------------------------------------------------------------------
def append(df: DataFrame, path: str, epoch: int, options: dict | None = None) -> None:
    """Append sink: every run (micro-batch) owns one ``epoch=`` folder. A
    replayed run overwrites its own folder only, so it neither duplicates its
    rows nor touches those of another run, whatever batches they belong to.

    The schema is kept beside the table, one small file a change: a run may
    bring new columns (older rows read NULL in them) or lack known ones, but
    not change a column's type."""
    spark, root = df.sparkSession, path.rstrip("/")
    known = stored_schema(spark, root)
    merged = list(known.fields) if known else []
    types = {f.name: f.dataType for f in merged}
    for f in df.schema.fields:
        if f.name not in types:
            merged.append(T.StructField(f.name, f.dataType, True))
        elif types[f.name] != f.dataType:
            raise ValueError(f"column {f.name} is {types[f.name].simpleString()} in {root}, not {f.dataType.simpleString()}")
    if not known or len(merged) > len(known.fields):
        version = len(files.finished(spark, f"{root}/_schema", "v="))
        text = spark.createDataFrame([(T.StructType(merged).json(),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{root}/_schema/v={version:06d}")
    df.write.mode("overwrite").options(**(options or {})).parquet(f"{root}/epoch={int(epoch)}")


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept beside an appended table, None before its first run."""
    versions = files.finished(spark, f"{path.rstrip('/')}/_schema", "v=")
    if not versions:
        return None
    return T.StructType.fromJson(json.loads(spark.read.text(f"{path.rstrip('/')}/_schema/{versions[-1]}").first()[0]))


def epochs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished runs of an appended table."""
    return sorted(map(int, complete(spark, path, "epoch=")))


def read_appended(spark: SparkSession, path: str, before: int | None = None, since: int | None = None) -> DataFrame:
    """All runs (or those with ``since`` <= epoch < ``before``; other folders are pruned), read with the stored schema: no footer is opened to learn it."""
    df = spark.read.schema(stored_schema(spark, path).add("epoch", T.IntegerType())).parquet(path)
    if before is not None:
        df = df.filter(F.col("epoch") < before)
    if since is not None:
        df = df.filter(F.col("epoch") >= since)
    return df.drop("epoch")


def complete(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Sorted names ``prefix...`` under ``root`` whose write has finished, from one listing."""
    return [n[len(prefix):] for n in files.finished(spark, root, prefix)]


def rebuild(df: DataFrame, path: str, version: str | None = None, keep: int = 3) -> str:
    """Full rebuild into a new version folder. The newest finished folder is
    the current table, so there is no pointer to lose: a crash leaves either
    the old version or the new one current. The ``keep`` newest stay, for
    readers that have begun and for a replay of the last run."""
    import uuid

    version = version or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S.%f") + "-" + uuid.uuid4().hex[:8]
    target = f"{path.rstrip('/')}/v={version}"
    df.write.mode("overwrite").parquet(target)
    for old in complete(df.sparkSession, path, "v=")[:-keep]:
        files.remove(df.sparkSession, f"{path.rstrip('/')}/v={old}")
    return target


def read_current(spark: SparkSession, path: str, before: str | None = None) -> DataFrame | None:
    """The newest finished version (before ``before``), None if there is none."""
    versions = [v for v in complete(spark, path, "v=") if before is None or v < before]
    return spark.read.parquet(f"{path.rstrip('/')}/v={versions[-1]}") if versions else None


def write_clustered(df: DataFrame, path: str, key: str, partitions: int | None = None) -> None:
    """Layout by key: range-partitioned and sorted within files so each file
    covers a narrow key range and row-group min/max statistics prune."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, F.col(key)).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


# --- raw landing by load date (S12) ------------------------------------------------------
def land_by_date(df: DataFrame, path: str, loaded: str = "loaded_at") -> None:
    """Raw rows appended to a landing with one folder a load date, so that a day is read, kept or removed as a whole."""
    df.withColumn("load_date", F.to_date(loaded)).write.mode("append").partitionBy("load_date").parquet(path)


def read_landed(spark: SparkSession, path: str, schema: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Rows loaded from ``first`` to ``last``: a filter on the folders, none else is opened."""
    df = spark.read.schema(schema + ", load_date date").parquet(path)
    if first is not None:
        df = df.filter(F.col("load_date") >= F.lit(first))
    if last is not None:
        df = df.filter(F.col("load_date") <= F.lit(last))
    return df


# --- landing writers (feed the given tables through the file path) ---------------------
def write_json_lines(df: DataFrame, path: str, line: Column, partition_cols=()) -> None:
    """Write one text line per row (the JSON-lines form of a landing)."""
    out = df.select(line.alias("value"), *partition_cols)
    w = out.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.text(path)


def events_json_line(bad: Column) -> Column:
    """An event as a JSON line; lines matching ``bad`` lose their closing
    brace (a corrupt record)."""
    body = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"),
        F.lit(',"ts":"'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.lit('","user_id":'), F.col("user_id").cast("string"),
        F.lit(',"event_type":"'), F.col("event_type"),
        F.lit('","value":'), F.col("value").cast("string"),
        F.lit(',"k":'), F.get_json_object("props", "$.k"))
    return F.when(bad, body).otherwise(F.concat(body, F.lit("}")))


EVENT_FIELDS = (("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
                ("event_type", "string"), ("value", "double"), ("k", "int"))


def line_number(line: Column) -> Column:
    """The event id of a line, also for a corrupt one (first number in it)."""
    return F.regexp_extract(line, r'"event_id":(\d+)', 1).cast("bigint")


def lit_ts(value: dt.datetime) -> Column:
    return S.lit_ts(value)
