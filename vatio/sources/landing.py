"""Landing files: JSONL batches (A5, A6), loading them into raw tables
(A1-A4), page envelopes (A7, A8) and the file inventory (A17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LANDING, RAW
from ..session import path_exists
from .catalog import SOURCES, write_table

#: Rows of a landed file: gzip is read by one task a file.
RECORDS_PER_FILE = 500_000
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def _instant_text(c: Column) -> Column:
    return F.date_format(c, ISO_UTC)


def landing_dir(root: str, source: str, run_date: str) -> str:
    return f"{root.rstrip('/')}/{source}/{run_date}"


def write_landing(df: DataFrame, root: str, source: str, entity: str, run_date: str | None = None,
                  batch_ts: str | None = None, batch_num: int = 0) -> str:
    """Write one landed batch as JSON lines, in gzip, under {root}/{source}/{date}/.
    ``entity`` may be an endpoint path: '/' becomes '_'.

    ``_extracted_at`` is one value for the whole batch (it replaces any
    existing stamp); instants are written as ISO-8601 text in UTC. The batch
    suffix is added only for batch numbers above 0; writing the same name
    again replaces it. Without ``run_date`` / ``batch_ts`` the current UTC
    date and instant are used.
    """
    if batch_ts is None or run_date is None:
        from datetime import UTC, datetime  # noqa: PLC0415
        now = datetime.now(UTC)
        batch_ts = batch_ts or now.strftime("%Y-%m-%d %H:%M:%S.%f")
        run_date = run_date or now.strftime("%Y-%m-%d")
    entity = entity.strip("/").replace("/", "_")
    name = f"{entity}_{batch_num:05d}" if batch_num > 0 else entity
    path = f"{landing_dir(root, source, run_date)}/{name}.jsonl"
    stamped = df.withColumn("_extracted_at", F.lit(batch_ts).cast("timestamp_ntz"))
    cols = []
    for f in stamped.schema.fields:
        c = F.col(f.name)
        if f.name == "_extracted_at" or f.name == "valid_time":
            c = _instant_text(c)
        cols.append(c.alias(f.name))
    stamped.select(*cols).write.mode("overwrite").option("ignoreNullFields", "false") \
        .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).json(path)
    return path


def to_utc_ntz(c: Column) -> Column:
    """Zoned timestamp -> UTC wall-clock timestamp_ntz (session-zone free)."""
    return F.convert_timezone(None, F.lit("UTC"), c.cast("timestamp_ntz"))


def read_landing(spark: SparkSession, root: str, table: str, run_date: str) -> DataFrame:
    """Landed JSON of one raw table for one landing date, in its raw contract.
    A broken line, or a value of another type, fails the read: a load is whole
    or does not happen."""
    src = SOURCES[table]
    path = f"{landing_dir(root, src.landing_source, run_date)}/{src.landing_glob}"
    return typed_landing(spark.read.schema(LANDING[table]).option("mode", "FAILFAST").json(path), table)


def typed_landing(df: DataFrame, table: str) -> DataFrame:
    """Landed columns in the types of the raw contract, instants in UTC."""
    cols = []
    for f in RAW[table].fields:
        c = F.col(f.name)
        if isinstance(LANDING[table][f.name].dataType, T.TimestampType):
            c = to_utc_ntz(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def load_landing(spark: SparkSession, root: str, table: str, run_date: str, table_path: str) -> DataFrame:
    """Load one landing date into a raw table: append (day-partitioned on
    the time column) or replace, per the source registry. Returns the rows
    written, read back from the table."""
    src = SOURCES[table]
    df = read_landing(spark, root, table, run_date)
    if src.partition_column:
        df = df.withColumn(src.partition_column, F.to_date(F.col(src.time_column)))
        write_table(df, table_path, partition_by=[src.partition_column], cluster_by=src.cluster_by,
                    mode=src.mode)
    else:
        write_table(df, table_path, cluster_by=src.cluster_by, mode=src.mode)
    return spark.read.parquet(table_path)


# ---- pages ----------------------------------------------------------------------
#: Column of a page's text where it is no JSON value of the page's shape.
BROKEN = "__broken"


def _page_schema(row_schema: T.StructType, results_key: str | None) -> T.StructType:
    return T.StructType([T.StructField(results_key or "data", T.ArrayType(row_schema)), T.StructField("page", T.LongType()),
                         T.StructField("totalCount", T.LongType()), T.StructField("total", T.LongType()),
                         T.StructField("count", T.LongType()), T.StructField(BROKEN, T.StringType())])


def _parsed(text: DataFrame, row_schema: T.StructType, results_key: str | None) -> DataFrame:
    """``env`` for each page of ``value``: one parse. A bare list is put into an envelope first."""
    key = results_key or "data"
    envelope = F.when(F.substring(F.ltrim(F.translate("value", "\t\r\n", "   ")), 1, 1) == "[",
                      F.concat(F.lit('{"%s":' % key), F.col("value"), F.lit("}"))).otherwise(F.col("value"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    return text.withColumn("env", F.from_json(envelope, _page_schema(row_schema, results_key), options))


def _page_facts(parsed: DataFrame, row_schema: T.StructType, results_key: str | None) -> DataFrame:
    """A row for each page: file, position, page, declared total, number of rows, and the rows."""
    page, total, items = _page_columns(row_schema, results_key)
    return parsed.select("file", "position", page, total, items.alias("items")).withColumn("page_rows", F.size("items"))


def _page_columns(row_schema: T.StructType, results_key: str | None) -> tuple[Column, Column, Column]:
    """Page, declared total and rows of ``env``."""
    total = F.coalesce(F.nullif("env.totalCount", F.lit(0)), F.nullif("env.total", F.lit(0)), F.nullif("env.count", F.lit(0)))
    items = F.coalesce(f"env.{results_key or 'data'}", F.array().cast(T.ArrayType(row_schema)))
    return F.col("env.page").alias("page"), total.alias("declared_total"), items


def read_pages(spark: SparkSession, path: str, row_schema: T.StructType,
               results_key: str | None = "data") -> DataFrame:
    """Page files -> rows. A file holds one page per line, or one page over
    several lines (its first line is no page of its own). A page is a bare JSON list of
    rows or an envelope object whose ``results_key`` holds the list (missing key -> no
    rows). Adds the file, the page's place in it, its declared total and its number of
    rows. Every line is parsed once; a page that is not JSON, or not of this shape,
    fails the read, also where other pages of its file are sound."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), place.alias("at")) \
        .filter(F.length(F.trim("value")) > 0)
    parsed = _parsed(lines, row_schema, results_key).withColumn("broken", F.col("env").isNull() | F.col(f"env.{BROKEN}").isNotNull())
    # Files with a broken line: pages over several lines if the first line is broken, else an error.
    # A row a file at most, as the driver's listing has them: sent to the pages, which are not shuffled.
    spread = parsed.groupBy("file").agg(F.max("broken").alias("some"), F.min_by("broken", "at").alias("first")).filter("some")
    whole = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file")) \
        .join(F.broadcast(spread.filter("first").select("file")), "file").withColumn("position", F.lit(0).cast("bigint"))
    whole = _parsed(whole, row_schema, results_key)
    fine = parsed.join(F.broadcast(spread.select("file", "first")), "file", "left").filter(~F.coalesce("first", F.lit(False)))
    fine = fine.withColumn("position", F.col("at.line"))
    both = fine.select("file", "position", "value", "env").unionByName(whole.select("file", "position", "value", "env"))
    sound = F.col("env").isNotNull() & F.col(f"env.{BROKEN}").isNull()
    checked = both.withColumn("env", F.when(sound, F.col("env")).otherwise(F.raise_error(
        F.concat(F.lit("malformed page in "), F.col("file"), F.lit(": "), F.substring("value", 1, 200)))))
    return _page_facts(checked, row_schema, results_key).select(
        "file", "position", "page", "declared_total", "page_rows", F.explode_outer("items").alias("row"))


def landed_pages(files: DataFrame, row_schema: T.StructType, results_key: str | None = "data") -> DataFrame:
    """A row for each page of whole files (``value``; a stream or a table): file, page,
    declared_total, page_rows. A file whose text is no page as it stands holds a page a line.
    A file of one line is parsed once."""
    named = files.select("value", F.col("_metadata.file_path").alias("file"), F.lit(0).alias("position"))
    first = F.regexp_extract("value", r"^\s*([^\r\n]*)", 1)
    broken = F.col("env").isNull() | F.col(f"env.{BROKEN}").isNotNull()
    page, total, items = _page_columns(row_schema, results_key)
    facts = F.struct(page, total, F.size(items).alias("page_rows"))
    by_line = _parsed(named.withColumn("whole", F.col("value")).withColumn("value", first), row_schema, results_key)
    by_line = by_line.select("file", "whole", "value", broken.alias("broken"), facts.alias("head")) \
        .withColumn("lines", F.filter(F.split("whole", r"\r?\n"), lambda x: F.trim(x) != ""))
    # The first line alone is a page: a page a line. The only line: its facts are known, no text is left to parse.
    alone = ~F.col("broken") & (F.size("lines") == 1) & (F.trim(F.get("lines", F.lit(0))) == F.trim("value"))
    parts = F.when(F.col("alone"), F.array(F.lit(None).cast("string"))).when(F.col("broken"), F.array("whole")) \
        .otherwise(F.col("lines"))
    text = by_line.withColumn("alone", alone).select("file", "alone", "head", F.explode(parts).alias("value"))
    parsed = _parsed(text, row_schema, results_key)
    sound = F.when(F.col("alone") | ~broken, F.col("env")).otherwise(
        F.raise_error(F.concat(F.lit("malformed page in "), F.col("file"))))
    known = F.when(F.col("alone"), F.col("head")).otherwise(facts)
    return parsed.withColumn("env", sound).select("file", known.alias("k")).select("file", "k.page", "k.declared_total", "k.page_rows")


def series_of(file: str) -> Column:
    """The landing folder of a page file."""
    return F.regexp_extract(file, r"^(.*)/[^/]*$", 1)


def _audited(per_page: DataFrame, keys: list[str], page_size: int, max_pages: int | None) -> DataFrame:
    """The audit over a row for each page: batch groups and stream state alike."""
    place = F.struct(F.col("page").alias("p"), F.col("file").alias("f"), F.col("position").alias("i"))
    short = F.col("n") < page_size
    aggs = [
        F.count(F.lit(1)).alias("pages"),
        F.sum("n").alias("rows"),
        F.max("t").alias("declared_total"),
        F.count_if(short).alias("short_pages"),
        F.count_if(F.col("n") == 0).alias("empty_pages"),
        F.max(place).alias("__last"), F.min(F.when(short, place)).alias("__short"),
    ]
    out = per_page.groupBy(*keys).agg(*aggs) if keys else per_page.agg(*aggs)
    out = out.select(
        *keys, "pages", "rows", "declared_total",
        F.ceil(F.col("declared_total") / F.lit(page_size)).cast("bigint").alias("expected_pages"),
        "short_pages", "empty_pages", "__last", "__short")
    out = out.withColumn(
        "complete", (F.col("rows") == F.col("declared_total")) & (F.col("pages") == F.col("expected_pages"))
        & (F.col("__short").isNull() | (F.col("__short") == F.col("__last")))).drop("__last", "__short")
    if max_pages is not None:
        out = out.withColumn("reached_max_pages", F.col("pages") >= F.lit(max_pages))
    return out


def audit_pages(pages: DataFrame, page_size: int, by_series: bool = False,
                max_pages: int | None = None) -> DataFrame:
    """Completeness of page series: pages seen, rows, declared total,
    expected pages = ceil(total / page_size), short and empty pages, and
    ``complete``: all declared rows and pages are present and a short page, which
    ends a series, is its last (by page number; files and places order pages
    without one). ``by_series`` audits each landing folder separately; with
    ``max_pages`` a series that reached the cap is flagged."""
    per_page = pages.groupBy("file", "position", "page").agg(F.max("page_rows").alias("n"),
                                                             F.max("declared_total").alias("t"))
    keys = ["series"] if by_series else []
    if by_series:
        per_page = per_page.withColumn("series", series_of("file"))
    return _audited(per_page, keys, page_size, max_pages)


def inventory(spark: SparkSession, root: str, source: str, run_date: str) -> DataFrame:
    """Objects landed for a source and date: name, files, bytes, lines. A landed
    object is one entry of the date's folder, whether a file or a folder of part
    files. No such folder means none; any other error is raised."""
    folder = landing_dir(root, source, run_date)
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "name string, files bigint, bytes bigint, lines bigint")

    def name(path: str) -> Column:
        inside = F.element_at(F.split(path, f"/{source}/{run_date}/"), -1)
        return F.element_at(F.split(inside, "/"), 1).alias("name")

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    objects = files.select(name("path"), "length").groupBy("name").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"))
    text = spark.read.option("recursiveFileLookup", "true").text(folder)
    lines = text.select(F.input_file_name().alias("path")).select(name("path")).groupBy("name").agg(
        F.count("*").alias("lines"))
    return objects.join(lines, "name", "left").select("name", "files", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"))
