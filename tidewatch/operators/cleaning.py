"""Assembly, resampling, filling and merging of series. Timestamps are `timestamp_ntz` in UTC; missing is NULL, never NaN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import timegrid as tg


def fold_by_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """One row for each timestamp: the first value that isn't null, column by column (A1)."""
    return df.groupBy(ts).agg(*[F.first(c, ignorenulls=True).alias(c) for c in df.columns if c != ts])


def outer_assemble(parts: Sequence[DataFrame], required: str | None = None, ts: str = "ts") -> DataFrame:
    """All columns of all parts on their timestamps; without rows where `required` is null (B1). One aggregation, however many parts."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    out = fold_by_time(out, ts)
    return out.where(F.col(required).isNotNull()) if required else out


def live_assemble(parts: Sequence[DataFrame], days: DataFrame, ts: str = "ts") -> DataFrame:
    """All columns of all parts on their timestamps, hours without a price too, and every hour of days(day), the days to be predicted, even if no part has it."""
    spine = tg.spine(days.select("day").distinct(), 60).select(F.col("ts").alias(ts))
    return outer_assemble([*parts, spine], ts=ts)


def existing_wins(existing: DataFrame, fresh: DataFrame, keys: Sequence[str], value: str, tolerance: float = 0.0) -> DataFrame:
    """(keys, value): what is stored, and fresh rows of other keys; a null is filled.

    Where both have a value and they lie further apart than the tolerance, the query fails with the key and both values. The check is
    part of the value's own expression: it costs no pass, and can't be left out of a plan that reads the value.
    """
    a, b = existing.select(*keys, F.col(value).alias("_a")), fresh.select(*keys, F.col(value).alias("_b"))
    told = F.concat(F.lit(f"{value} disagrees at "), F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys]), F.lit(": stored "), F.col("_a").cast("string"), F.lit(", fresh "), F.col("_b").cast("string"))
    apart = F.abs(F.col("_a") - F.col("_b")) > tolerance
    kept = F.when(apart, F.raise_error(told).cast(existing.schema[value].dataType)).otherwise(F.coalesce("_a", "_b"))
    return a.join(b, list(keys), "full").select(*keys, kept.alias(value))


def resample(df: DataFrame, step_minutes: int, columns: Sequence[str], ts: str = "ts") -> DataFrame:
    """Means of the columns in each slot that has rows."""
    return df.groupBy(tg.truncate(F.col(ts), step_minutes).alias(ts)).agg(*[F.avg(c).alias(c) for c in columns])


def weighted_mean(price: Column, weight: Column, fallback: Column | None = None) -> Column:
    """Mean of price by weight, where a missing weight takes the fallback; the plain mean if weights add up to nothing or one is still missing."""
    w = weight if fallback is None else F.coalesce(weight, fallback)
    used = F.greatest(F.when(price.isNotNull(), w), F.lit(0.0))
    total = F.sum(used)
    return F.when((F.coalesce(total, F.lit(0.0)) == 0) | (F.count_if(price.isNotNull() & w.isNull()) > 0), F.avg(price)).otherwise(F.try_divide(F.sum(price * used), total))


def bounded_ffill(df: DataFrame, column: str, limit_hours: int, by: Sequence[str] = (), ts: str = "ts", out: str | None = None) -> DataFrame:
    """Null values of a column take the last one before, if it is at most limit_hours old.

    Series are apart by the columns `by`. They are filled in blocks of the limit's length, so no task holds a whole series: each row also
    reads the block before its own, and these two hold every value that is young enough.
    """
    name = out or f"{column}_filled"
    limit = limit_hours * 3600
    key = F.struct(*by) if by else F.lit(0)
    block = F.floor(tg.seconds(F.col(ts)) / limit)
    known = df.where(F.col(column).isNotNull()).select(key.alias("_key"), F.col(ts).alias("_at"), F.col(column).alias("_v"))
    known = known.groupBy("_key", (F.floor(tg.seconds(F.col("_at")) / limit) + 1).alias("_block")).agg(F.max(F.struct("_at", "_v")).alias("_last"))
    w = Window.partitionBy("_key", "_block").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    here = F.last(F.when(F.col(column).isNotNull(), F.struct(F.col(ts).alias("_at"), F.col(column).alias("_v"))), ignorenulls=True).over(w)
    own = df.withColumns({"_key": key, "_block": block}).withColumn("_here", here)
    both = own.join(known, ["_key", "_block"], "left").withColumn("_use", F.coalesce("_here", "_last"))
    young = tg.seconds(F.col(ts)) - tg.seconds(F.col("_use._at")) <= limit
    return both.withColumn(name, F.when(young, F.col("_use._v"))).drop("_key", "_block", "_here", "_last", "_use")


def coalesce_sources(first: DataFrame, second: DataFrame, column: str, keys: Sequence[str] = ("ts",), tolerance: float = 0.0) -> DataFrame:
    """Values of first, filled from second (B5, I15): (keys, column, from_second, conflict). A conflict is a key with two values further apart than the tolerance."""
    a, b = first.select(*keys, F.col(column).alias("_a")), second.select(*keys, F.col(column).alias("_b"))
    both = a.join(b, list(keys), "full")
    return both.select(*keys, F.coalesce("_a", "_b").alias(column), (F.col("_a").isNull() & F.col("_b").isNotNull()).alias("from_second"), F.coalesce(F.abs(F.col("_a") - F.col("_b")) > tolerance, F.lit(False)).alias("conflict"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in an order (B8). An aggregate, so copies are folded before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def drop_columns(df: DataFrame, columns: Sequence[str], *, strict: bool = True) -> DataFrame:
    """df without columns; strict names those that it lacks."""
    if strict and (unknown := sorted(set(columns) - set(df.columns))):
        raise ValueError(f"unknown columns: {unknown}")
    return df.drop(*columns)


def trim_warmup(df: DataFrame, hours: int, ts: str = "ts") -> DataFrame:
    """Rows from `hours` after the first timestamp on."""
    start = df.agg((F.min(ts) + tg.hours(hours)).alias("_from"))
    return df.join(F.broadcast(start), F.col(ts) >= F.col("_from"), "left_semi")


def blank(df: DataFrame, columns: Sequence[str], start: Column, end: Column, ts: str = "ts") -> DataFrame:
    """Columns set to null in [start, end)."""
    inside = (F.col(ts) >= start) & (F.col(ts) < end)
    return df.withColumns({c: F.when(~inside, F.col(c)) for c in columns})


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of new, and those of existing whose key new lacks."""
    return existing.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


SECRET = r"(?i)((?:token|key|secret|password)[=:]\s*)[^&\s\"']+"


def redact(text: Column) -> Column:
    """Secret values in a text replaced."""
    return F.regexp_replace(text, SECRET, "$1***")


def valid_days(df: DataFrame, columns: Sequence[str], ts: str = "ts") -> DataFrame:
    """Local days of which no value is missing."""
    whole = F.bool_and(F.lit(True))
    for c in columns:
        whole = whole & F.bool_and(F.col(c).isNotNull())
    return df.groupBy(tg.local_day(F.col(ts)).alias("day")).agg(whole.alias("_whole")).where("_whole").select("day")


def fingerprint(df: DataFrame, ts: str = "ts") -> DataFrame:
    """First and last timestamp, rows, and a checksum of the content that ignores order."""
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count("*").alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("content"))


def reject_invalid(df: DataFrame, source: str, valid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the sources that passed validation, and the rest."""
    return df.join(valid.select(source), source, "left_semi"), df.join(valid.select(source), source, "left_anti")


def generation_columns(long: DataFrame, named: dict[str, str], hydro: Sequence[str], keys: Sequence[str] = ("ts",), kind: str = "type", value: str = "mw") -> DataFrame:
    """Columns of long(keys, kind, value): those of named kinds, gen_hydro as the sum of the hydro kinds and gen_other of all kinds that are neither; a sum of nothing is null."""
    k, v = F.col(kind), F.col(value)
    one = [F.sum(F.when(k == src, v)).alias(dst) for src, dst in named.items()]
    rest = ~k.isin(*named, *hydro)
    return long.groupBy(*keys).agg(*one, F.sum(F.when(k.isin(*hydro), v)).alias("gen_hydro"), F.sum(F.when(rest, v)).alias("gen_other"))
