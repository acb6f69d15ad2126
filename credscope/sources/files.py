"""File sources and sinks.

* S1  loan CSV: header, every column a string, RFC-4180 quoting (embedded
      newlines, doubled quotes), invalid UTF-8 decoded as U+FFFD, blank lines
      skipped, no trimming.  A multi-line CSV is not splittable, so it is
      landed once as Parquet (``land_parquet``) and every analysis reads the
      Parquet copy (column pruning + pushdown of the status filter).
* S2  input discovery: exact file name first, else any ``*.csv`` whose name
      contains a word (case-insensitive); lexicographically first match.
* S3  monthly macro CSV (``observation_date,FEDFUNDS,UNRATE,CPIAUCSL``).
* S4/S5 long state CSVs with their file line order as ``pos``.
* S7  table sink: header, NULL as empty, nothing written for an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MACRO_COLUMNS = ("observation_date", "FEDFUNDS", "UNRATE", "CPIAUCSL")
UNEMPLOYMENT_COLUMNS = ("FIPS_Code", "State", "Area_Name", "Attribute", "Value")
POVERTY_COLUMNS = ("FIPS_Code", "Stabr", "Area_Name", "Attribute", "Value")


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def csv_reader(spark: SparkSession, multiline: bool = True):
    """CSV options matching Python's ``csv`` module defaults."""
    return (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                     multiline: bool = True) -> DataFrame:
    """All-string CSV scan; the header defines the columns unless given."""
    reader = csv_reader(spark, multiline)
    if columns:
        reader = reader.schema(string_schema(columns))
    return reader.csv(path)


#: Fields that a record has, where that differs from the header; else null.
FIELD_COUNT = "__field_count"


def read_loans_csv(spark: SparkSession, path: str, multiline: bool = True, field_count: bool = False) -> DataFrame:
    """Raw loan file, header-defined columns, all strings.

    ``multiline=False`` is for files without line breaks inside quotes: Spark
    then splits one file over many tasks; otherwise a file is one task.
    ``field_count`` adds ``FIELD_COUNT``, which tells the fields that a short
    row lacks from empty ones."""
    if not field_count:
        return read_csv_strings(spark, path, multiline=multiline)
    df = _with_record(spark, path, multiline)
    return df.withColumn(FIELD_COUNT, fields_in(F.col(_RECORD))).drop(_RECORD)


_RECORD = "_corrupt_record"


def _with_record(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    """The parsed columns, and the raw record where its field count isn't the header's."""
    header = read_csv_strings(spark, path, multiline=multiline).columns
    schema = string_schema(header).add(_RECORD, StringType(), True)
    return csv_reader(spark, multiline).schema(schema).option("columnNameOfCorruptRecord", _RECORD).csv(path)


def fields_in(record: Column) -> Column:
    """Number of fields of a raw CSV record: one more than the commas outside
    quoted fields (a quote inside an unquoted field is text)."""
    plain = F.regexp_replace(record, r'(^|,)"(?:[^"]|"")*+"?', "$1")
    return (F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1).cast("int")


def ragged_rows(spark: SparkSession, path: str) -> DataFrame:
    """Audit of rows whose field count differs from the header (too short or
    too long): the parsed columns plus the raw line as ``record``.  Spark
    fills a short row with NULLs and drops extra fields.  (Spark refuses scans
    that read only the corrupt-record column, hence the parsed columns are
    returned too.)"""
    return _with_record(spark, path, True).filter(F.col(_RECORD).isNotNull()).withColumnRenamed(_RECORD, "record")


def find_source(spark: SparkSession, root: str, exact_name: str, contains: str | None = None) -> str:
    """Locate an input file under ``root`` (recursively).

    The listing is a distributed metadata scan (``binaryFile`` with only the
    ``path`` column selected, so no file content is read); only the single
    chosen path reaches the driver.  Raises ``FileNotFoundError`` if nothing
    matches.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(root)
        .select("path")
    )
    name = F.element_at(F.split("path", "/"), -1)
    exact = listing.filter(name == exact_name).orderBy("path").limit(1).collect()
    if exact:
        return exact[0]["path"]
    if contains:
        loose = listing.filter(F.lower(name).contains(contains.lower())).orderBy("path").limit(1).collect()
        if loose:
            return loose[0]["path"]
    raise FileNotFoundError(f"no {exact_name!r} (or *{contains}*.csv) under {root}")


def read_macro_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: monthly macro series as text (empty cells become NULL)."""
    return read_csv_strings(spark, path, MACRO_COLUMNS)


def with_file_order(df: DataFrame, files: Sequence[str]) -> DataFrame:
    """Add ``pos``: one number that follows file line order.

    It packs the file's place among ``files`` (paths in order), the start of
    the split (below 2**47) and the row id within the task (below 2**33): row
    ids are increasing within a task, and splits of one file are ordered by
    their start.  A number, unlike a struct, can be kept by a hash aggregate.
    """
    place = F.array_position(F.lit([_plain_uri(f) for f in files]).cast("array<string>"), F.regexp_replace("_metadata.file_path", "^([a-z0-9]+):/+", "$1:/"))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    number = lambda c: c.cast("decimal(38,0)")
    packed = (number(place) * F.lit(1 << 47) + number(F.col("_metadata.file_block_start"))).cast("decimal(28,0)") * F.lit(1 << 33).cast("decimal(10,0)") + row.cast("decimal(19,0)")
    return df.withColumn("pos", packed.cast("decimal(38,0)"))


def _plain_uri(path: str) -> str:
    scheme, colon, rest = path.partition(":/")
    return f"{scheme}:/{rest.lstrip('/')}" if colon else path


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The files under ``path`` in order; a listing, no content is read."""
    return sorted(r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").collect())


def read_state_long(spark: SparkSession, path: str, state_column: str = "State") -> DataFrame:
    """S4 (``State``) / S5 (``Stabr``): long state/county file with ``pos``."""
    columns = UNEMPLOYMENT_COLUMNS if state_column == "State" else POVERTY_COLUMNS
    return with_file_order(read_csv_strings(spark, path, columns), list_files(spark, path))


def land_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write once as Parquet (overwrite) and return the Parquet-backed frame.

    Landing also cuts the lineage: a lost executor re-reads the files.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def land_observed(df: DataFrame, path: str, metrics: Sequence[Column]) -> tuple[DataFrame, dict]:
    """:func:`land_parquet`, and aggregates of the rows by name, gathered by
    the tasks that write them, so that no scan of their own is needed.  A task
    that runs again counts once, as only the result of a partition is taken."""
    seen = Observation()
    return land_parquet(df.observe(seen, *metrics), path), seen.get


def write_table(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> bool:
    """Write a result table; returns False if it turned out to be empty.

    The plan runs once: rows are counted while they are written, and an empty
    table leaves its header at most.  ``single_file`` keeps the rows in their
    sorted order in one CSV part and is meant for the small published result
    tables only.
    """
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    out = out.coalesce(1) if single_file else out
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)
    else:
        writer.format(fmt).save(path)
    return seen.get["rows"] > 0
