"""Readers and writers of landed files: drifting monthly files, CSV anchors and logs, JSON documents and protocols."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import timegrid as tg
from tidewatch.operators.cleaning import fold_by_time

#: One run of the daily job; nested lists and maps as such.
RUN = {
    "run_id": "string",
    "run_ts": "string",
    "target_day": "string",
    "candidate": "string",
    "rank": "int",
    "accepted": "boolean",
    "reasons": "array<string>",
    "gaps": "array<struct<group:string,hours:int,plan:string>>",
    "source_ages": "map<string,double>",
    "versions": "map<string,string>",
    "runtime_seconds": "double",
}
ANCHORS = "anchor_date date, production_type string, capacity_mw double"


def read_drifting(spark: SparkSession, path: str, start: Column | None = None, end: Column | None = None, ts: str = "ts") -> DataFrame:
    """Files whose columns differ, folded to one row a timestamp; a slice is pushed into the scan (A1)."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    if start is not None:
        df = df.where(F.col(ts) >= start)
    if end is not None:
        df = df.where(F.col(ts) <= end)
    return fold_by_time(df, ts)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, or an empty one of that schema where the path is absent (A2)."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df if it has exactly these columns and types."""
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in schema}
    if have != want:
        wrong = sorted(k for k in have.keys() | want.keys() if have.get(k) != want.get(k))
        raise ValueError(f"columns differ from the schema: {wrong}")
    return df.select(*want)


def write_runs(df: DataFrame, path: str) -> None:
    """A weather store by model and run date (A3)."""
    df.withColumn("run_date", F.to_date("run")).write.mode("append").partitionBy("model", "run_date").parquet(path)


def read_runs(spark: SparkSession, path: str, days: DataFrame, model: str) -> DataFrame:
    """Only the runs that the days need; the join prunes partitions (A3)."""
    need = days.select(F.to_date(tg.run_init(F.col("day"))).alias("run_date")).distinct()
    return spark.read.parquet(path).where(F.col("model") == model).join(need, "run_date", "left_semi")


def read_anchors(spark: SparkSession, path: str, production_type: str) -> DataFrame:
    """Anchors of one type from CSV with # comments (A4)."""
    return spark.read.csv(path, header=True, comment="#", schema=ANCHORS).where(F.col("production_type") == production_type).orderBy("anchor_date")


def append_log(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Rows added to a CSV log in a fixed order of columns (A5)."""
    df.select(*columns).write.mode("append").option("header", True).csv(path)


def write_protocol(df: DataFrame, path: str) -> None:
    df.select(*[c for c in RUN if c in df.columns]).write.mode("append").json(path)


def read_protocol(spark: SparkSession, path: str) -> DataFrame:
    """Runs from JSON lines: what a line lacks is null, what it has besides is dropped."""
    return spark.read.schema(", ".join(f"{k} {v}" for k, v in RUN.items())).json(path)


def write_monthly(df: DataFrame, path: str, ts: str = "ts") -> None:
    """By UTC month; months written again are replaced, others stay."""
    out = df.withColumns({"year": F.year(ts), "month": F.month(ts)})
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)


FORECAST = "array<struct<latitude:double,longitude:double,hourly:struct<time:array<string>,values:map<string,array<double>>>>>"


def flatten_forecast(docs: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Readings (run, valid, point, variable, value) of forecast documents, and the documents with a problem (A10).

    A document is a list of locations with an array of hours and one array for each variable.
    """
    parsed = docs.withColumn("doc", F.from_json(body, FORECAST))
    places = parsed.select("run", F.posexplode("doc").alias("point", "loc")).select("run", "point", F.col("loc.hourly.time").alias("time"), F.explode("loc.hourly.values").alias("variable", "values"))
    short = places.where(F.size("time") != F.size("values")).select("run", F.lit("length").alias("problem")).distinct()
    empty = parsed.where(F.coalesce(F.size("doc"), F.lit(0)) <= 0).select("run", F.lit("empty").alias("problem"))
    rows = places.where(F.size("time") == F.size("values")).select("run", "point", "variable", F.inline(F.arrays_zip("time", "values")))
    return rows.select("run", F.to_timestamp_ntz("time").alias("valid"), "point", "variable", F.col("values").cast("float").alias("value")), short.unionByName(empty)


def flatten_series(docs: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(source, ts, value) of paired arrays, and the documents whose arrays differ in length."""
    parsed = docs.withColumn("doc", F.from_json(body, "unix_seconds array<bigint>, values array<double>"))
    fits = F.size("doc.unix_seconds") == F.size("doc.values")
    rows = parsed.where(fits).select("source", F.inline(F.arrays_zip(F.col("doc.unix_seconds").alias("s"), F.col("doc.values").alias("v"))))
    at = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("s").cast("decimal(18,6)"))
    return rows.select("source", at.alias("ts"), F.col("v").alias("value")), parsed.where(~F.coalesce(fits, F.lit(False))).select("source")


def melt_capacity(docs: DataFrame, as_of: Column, body: str = "body") -> DataFrame:
    """(anchor_date, production_type, capacity_mw) of monthly GW arrays; only months that are over."""
    parsed = docs.withColumn("doc", F.from_json(body, "time array<string>, types map<string,array<double>>"))
    kinds = parsed.select("doc.time", F.explode("doc.types").alias("production_type", "gw"))
    rows = kinds.select("production_type", F.inline(F.arrays_zip("time", "gw")))
    day = F.last_day(F.to_date(F.concat(F.lit("01."), F.col("time")), "dd.MM.yyyy"))
    return rows.select(day.alias("anchor_date"), "production_type", F.round(F.col("gw") * 1000).alias("capacity_mw")).where(F.col("anchor_date") < as_of)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(day, ts, value): archived payloads with their values on the quarter hours of the local day."""
    docs = spark.read.schema("challenge_id string, target_start string, values array<double>").option("multiLine", True).json(path)
    rows = docs.select(F.to_date(F.substring("target_start", 1, 10)).alias("day"), F.posexplode("values").alias("k", "value"))
    at = tg.day_start(F.col("day")) + F.make_dt_interval(mins=F.col("k") * 15)
    return rows.select("day", at.alias("ts"), "value").where(at < tg.day_end(F.col("day")))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha256) of the files under a path."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.sha2("content", 256).alias("sha256"))


def bad_checksums(spark: SparkSession, path: str, listed: DataFrame) -> DataFrame:
    """(file, problem): files that are missing, not listed or changed."""
    both = checksums(spark, path).join(listed.select("file", F.col("sha256").alias("want")), "file", "full")
    problem = F.when(F.col("sha256").isNull(), "missing").when(F.col("want").isNull(), "not listed").when(F.col("sha256") != F.col("want"), "changed")
    return both.select("file", problem.alias("problem")).where("problem IS NOT NULL")


def write_vintage(anchors: DataFrame, path: str, as_of: str) -> None:
    """Anchors as the vintage of a day, as_of=YYYY-MM-DD under path, and its files' checksums added to the list beside it (F10). A vintage that is there is never written again: Spark's writer raises."""
    spark, at = anchors.sparkSession, f"{path}/as_of={as_of}"
    anchors.orderBy("anchor_date", "production_type").coalesce(1).write.mode("errorifexists").option("header", True).csv(at)
    checksums(spark, f"{at}/*.csv").select(F.lit(as_of).alias("as_of"), "file", "sha256").coalesce(1).write.mode("append").option("header", True).csv(f"{path}/_checksums")


def read_vintages(spark: SparkSession, path: str) -> DataFrame:
    """(anchor_date, production_type, capacity_mw, as_of) of all vintages under path."""
    return spark.read.option("basePath", path).csv(f"{path}/as_of=*", header=True, schema=ANCHORS + ", as_of date")
