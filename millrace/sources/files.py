"""JSON-lines scans and sinks, digests, caches, appends and the ingest of raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..operators import splits as S


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType, bad: str = "fail") -> DataFrame:
    """Objects of a JSON-lines file: bad lines fail the job, are dropped, or make null rows (bad = fail, drop or null)."""
    mode = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "null": "PERMISSIVE"}[bad]
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The file, or no rows if there is none."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_object(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object a file; globs give a row for each file."""
    return spark.read.option("multiLine", True).json(path)


def read_json_objects(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The objects of a JSON-lines file; blank lines and lines that hold another value, or none, are left out."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"\A[\t\n\x0B\f\r ]*\{"))
    return lines.select(F.from_json("value", schema if isinstance(schema, str) else schema.simpleString()).alias("o")).where("o is not null").select("o.*")


def read_texts(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, text) of whole files below a folder."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("wholetext", True).text(folder).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, by Spark's commit protocol; mode append adds files."""
    df.write.mode(mode).json(path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder a split; existing output is refused."""
    df.write.mode("errorifexists").partitionBy(split).json(path)


def write_kept_and_rejected(df: DataFrame, reasons: str, kept: str, rejected: str) -> None:
    """Rows without reasons to one place, the others with theirs to another."""
    df.where(F.size(reasons) == 0).drop(reasons).write.mode("errorifexists").json(kept)
    df.where(F.size(reasons) > 0).write.mode("errorifexists").json(rejected)


def fingerprint(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, length, sha256) of each file's bytes."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def names_fingerprint(spark: SparkSession, *paths: str) -> DataFrame:
    """One row: a digest of all files' names and bytes, in order of names."""
    files = fingerprint(spark, list(paths)).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "length", "sha256")
    own = F.array_sort(F.collect_list(F.struct("name", "sha256")))
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("length"), F.sha2(F.array_join(F.transform(own, lambda x: F.concat(x["name"], F.lit("\n"), x["sha256"])), "\n"), 256).alias("digest"))


def write_object(df: DataFrame, path: str) -> None:
    """A one-row table as one JSON file, by renaming a finished one: readers see the old object or the new one."""
    rows = df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("an object is one row")
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, made = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".new")
    system = target.getFileSystem(conf)
    out = system.create(made, True)
    out.write(bytearray(rows[0][0].encode() + b"\n"))
    out.close()
    system.delete(target, False)
    if not system.rename(made, target):
        raise OSError(f"{path} could not be written")


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """An unchanging copy: written once to a new folder, refused if there is one, and read from there."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_figure(old: DataFrame, spark: SparkSession, path: str, description: str, source: str) -> DataFrame:
    """Records (sample_id, source, description, code) with the one of a code file added, unless its code is there."""
    code = T.filled(F.col("text"))
    new = read_texts(spark, path).select(code.alias("code")).where("code is not null").select(S.stable_id(F.lit(source), F.col("code")).alias("sample_id"), F.lit(source).alias("source"), F.lit(description).alias("description"), "code")
    hashed = old.select(F.sha2("code", 256).alias("h")).distinct()
    return old.unionByName(new.join(hashed, F.sha2("code", 256) == F.col("h"), "left_anti"))


def row_fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many rows, and an order-free digest of them."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*columns)).alias("digest"))


def ids_digest(df: DataFrame, key: str, width: int = 1 << 16) -> DataFrame:
    """One row: a digest of all ids in order, as a tree of three levels.

    Ids are digested by ranges of `width` values, these digests by runs of `width` ranges, and
    those in turn: a task holds one range's ids, or one run's digests.
    """
    joined = lambda order, value: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value].cast("string")), "\n"), 256)
    own = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(key).alias("v"), F.floor(F.col(key) / width).alias("b"))
    ranges = own.groupBy("b").agg(joined("k", "v").alias("d")).withColumn("c", F.floor(F.col("b") / width))
    runs = ranges.groupBy("c").agg(joined("b", "d").alias("d"))
    return runs.agg(joined("c", "d").alias("digest"))


def complete(df: DataFrame, truncated: Column) -> DataFrame:
    """Rows that are not marked as truncated."""
    return df.where(~F.coalesce(truncated, F.lit(False)))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The new rows, and the old ones whose key they do not have."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def append_new(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Of the new rows those whose key is not there yet, the first of several in input order."""
    return new.join(old.select(key).distinct(), key, "left_anti").dropDuplicates([key])


def allowed(df: DataFrame, sources: list[str] | None, most: int | None = None) -> DataFrame:
    """Rows of allowed sources, `most` at most."""
    own = df if sources is None else df.where(F.col("source").isin(sources))
    return own if most is None else own.limit(most)


def readiness(df: DataFrame, n: int, order: str) -> DataFrame:
    """One row on the first n raw rows: how many, with code, with a description, usable."""
    code, text = T.filled(F.col("code")).isNotNull(), T.filled(F.col("description")).isNotNull()
    head = df.orderBy(order).limit(n)
    return head.agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(x) for x, c in (("with_code", code), ("with_description", text), ("usable", code & text))))


def ingest_reasons(low: int = 100, high: int = 4000) -> Column:
    """Why a raw row is not taken."""
    code, text = T.filled(F.col("code")), T.filled(F.col("description"))
    n = F.length(code)
    return T.reasons(("missing_code", code.isNull()), ("missing_description", text.isNull()), ("external_dependency", F.coalesce(T.external(code), F.lit(False))), ("too_short", n < low), ("too_long", n > high))


def ingest(df: DataFrame, known: DataFrame | None = None, most_tokens: int = 1536) -> DataFrame:
    """Samples of raw rows (ord, source, code, description): checked, deduplicated against known content and among themselves, then cut to length."""
    own = df.withColumn("reasons", ingest_reasons()).where(F.size("reasons") == 0).drop("reasons")
    code = T.filled(F.col("code"))
    own = own.withColumn("content_hash", F.sha2(code, 256)).withColumn("sample_id", S.stable_id(F.col("source"), code))
    if known is not None:
        own = own.join(known.select("content_hash").distinct(), "content_hash", "left_anti")
    from ..operators.leakage import first_wins

    own = first_wins(own, F.col("content_hash"), "ord")
    length = F.size(T.tokens(code))
    return own.select("sample_id", "source", "ord", "content_hash", code.alias("code"), T.filled(F.col("description")).alias("description"), T.generation_mode(code).alias("mode"), length.alias("token_length")).where(F.col("token_length") <= most_tokens)
