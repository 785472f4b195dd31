"""Readers: explicit files, declared schemas, counted errors, provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_parquet(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """An explicit list of files, no wildcard; with a schema only its columns are scanned."""
    if not paths or any("*" in p for p in paths):
        raise ValueError("name every file; wildcards are refused")
    r = spark.read
    return (r.schema(schema) if schema else r).parquet(*paths)


def read_csv(spark: SparkSession, paths: list[str], schema: T.StructType, strict: bool = True) -> DataFrame:
    """CSV, plain or gzipped, one header row, quote ``"`` (doubled within a field, which may hold line ends). Strict reading fails at the first bad row; otherwise bad rows keep their text in ``_corrupt_record``."""
    r = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    if strict:
        return r.schema(schema).option("mode", "FAILFAST").option("enforceSchema", False).csv(paths)
    s = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return r.schema(s).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(paths)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound rows, one-row count of malformed rows) of a permissive read."""
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.agg(F.count(F.lit(1)).alias("rows"), F.count(CORRUPT).alias("malformed"))


def read_jsonl(spark: SparkSession, paths: list[str], schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, one-row count of lines and parse errors); blank lines do not count."""
    lines = spark.read.text(paths).where(F.trim("value") != "")
    s = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    s = T.StructType([*s.fields, T.StructField(CORRUPT, T.StringType())])
    j = lines.select(F.from_json("value", s, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}).alias("j")).select("j.*")
    bad = F.count(CORRUPT)
    return j.where(F.col(CORRUPT).isNull()).drop(CORRUPT), j.agg(F.count(F.lit(1)).alias("lines"), bad.alias("parse_errors"))


#: how a null stands in tab-separated text, where an empty text is an empty field
NULL = "\\N"
_TSV = {"sep": "\t", "quote": "", "escape": "\u0000", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_tsv(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Tab-separated rows as ``ordered_export`` writes them; a row of another width, or a value that is not of its type, fails the read."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    d = spark.read.schema(text).options(**_TSV).option("mode", "FAILFAST").csv(paths)
    own = lambda f: F.when(F.col(f.name) == NULL, None).otherwise(F.coalesce(f.name, F.lit(""))).cast(f.dataType).alias(f.name)
    return d.select(*[own(f) for f in schema.fields])


def ordered_export(df: DataFrame, by: list[str], path: str) -> None:
    """Tab-separated files, gzipped, whose rows in the order of the files' names are in the order of ``by``: divided by ranges, then sorted within each.

    Tabs, line ends and backslashes within a text are refused, as the format has no place for them; a row of one empty text alone is no row.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    bad = F.lit(False)
    for c in texts:
        bad = bad | F.coalesce(F.col(c).rlike(r"[\t\n\r\\]"), F.lit(False))
    keys = [F.col(c).asc_nulls_first() for c in by]
    checked = df.select(*[F.when(bad, F.raise_error(F.lit("a text holds a tab, line end or backslash"))).otherwise(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns])
    checked = checked.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*[F.coalesce(F.col(c).cast("string"), F.lit(NULL)).alias(c) for c in df.columns])
    checked.write.options(**_TSV).option("compression", "gzip").csv(path)


def with_source_file(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Adds the file each row came from, by the reader's metadata column."""
    return df.select("*", F.col("_metadata.file_path").alias(column))


def read_period(spark: SparkSession, path: str, column: str, start: str, end: str) -> DataFrame:
    """Rows of a half-open period [start, end); the bound is required, so no reader scans a whole partitioned table by accident."""
    if not start or not end or start >= end:
        raise ValueError("a period needs start < end")
    df = spark.read.parquet(path)
    kind = df.schema[column].dataType
    return df.where((F.col(column) >= F.lit(start).cast(kind)) & (F.col(column) < F.lit(end).cast(kind)))


def firewall(df: DataFrame, allowed: list[str], banned: list[str] = ()) -> DataFrame:
    """Only the allowed columns, in their order; raises when one is missing or banned."""
    missing, hit = [c for c in allowed if c not in df.columns], [c for c in allowed if c in banned]
    if missing or hit:
        raise ValueError(f"columns missing {missing}, banned {hit}")
    return df.select(*allowed)


def verify_manifest(spark: SparkSession, folder: str, manifest: dict[str, str | tuple[str, int]]) -> DataFrame:
    """(name, state, bytes) of every file in the folder or in ``manifest`` (name -> SHA-256, or SHA-256 and size): ok, missing, unexpected, size, differs.

    Contents are hashed on the executors, a file a row; a file whose size is wrong is not read.
    """
    want = [(k, *(v if isinstance(v, tuple) else (v, None))) for k, v in sorted(manifest.items())]
    want = spark.createDataFrame(want, "name string, want string, want_bytes long")
    sizes = spark.read.format("binaryFile").load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))
    j = sizes.join(want, "name", "full_outer")
    right_size = F.coalesce(F.col("want_bytes") == F.col("bytes"), F.lit(True))
    read = j.where(F.col("want").isNotNull() & F.col("path").isNotNull() & right_size).select("path")
    sha = spark.read.format("binaryFile").load(folder).join(read, "path", "left_semi").select("path", F.sha2("content", 256).alias("sha"))
    j = j.join(sha, "path", "left")
    state = F.when(F.col("path").isNull(), "missing").when(F.col("want").isNull(), "unexpected").when(~right_size, "size").when(F.col("sha") != F.col("want"), "differs").otherwise("ok")
    return j.select("name", state.alias("state"), "bytes")


def manifest_totals(states: DataFrame) -> DataFrame:
    """One row of a verified manifest: files there, files wanted, bytes there, and files not ok."""
    return states.agg(F.count("bytes").alias("files"), F.count_if(F.col("state") != "unexpected").alias("wanted"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count_if(F.col("state") != "ok").alias("not_ok"))
