"""Length profiles, histograms, term counts and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def length_profile(df: DataFrame, length: str, by: str | None = None) -> DataFrame:
    """Count, mean, extremes and interpolated percentiles, over all rows or by a group."""
    p = F.percentile(length, F.array(*map(F.lit, (0.5, 0.9, 0.95, 0.99))))
    out = df.groupBy(*([by] if by else [])).agg(F.count(length).alias("n"), F.avg(length).alias("mean"), F.min(length).alias("least"), F.max(length).alias("most"), p.alias("p"))
    return out.select(*([by] if by else []), "n", F.round("mean", 6).alias("mean"), "least", "most", *(F.round(F.col("p")[i], 6).alias(x) for i, x in enumerate(("p50", "p90", "p95", "p99"))))


def nearest_rank(length: str, q: float) -> Column:
    """The smallest value with at least that share of the rows up to it."""
    return F.expr(f"percentile_disc({q}) within group (order by {length})")


def shares_from(df: DataFrame, length: str, floors: tuple[int, ...] = (512, 768, 1024, 1280, 1536)) -> DataFrame:
    """One row: the share of rows of at least each length."""
    return df.agg(*(F.round(F.coalesce(F.avg((F.col(length) >= n).cast("int")), F.lit(0.0)), 6).alias(f"ge_{n}") for n in floors))


def top_terms(df: DataFrame, text: str, pattern: str, k: int = 50) -> DataFrame:
    """The k most frequent matches, equal counts by term."""
    found = df.select(F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("term"))
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(k)


def marker_totals(df: DataFrame, text: str, markers: dict[str, str]) -> DataFrame:
    """One row: how often each pattern occurs over all rows."""
    return df.agg(*(F.coalesce(F.sum(T.count(F.col(text), p)), F.lit(0)).alias(name) for name, p in markers.items()))


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """(bin, n) over [0, 1], every bin listed, values outside in the outermost."""
    slot = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(F.col(value) * bins).cast("int")))
    own = df.where(F.col(value).isNotNull()).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(own), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def reason_counts(df: DataFrame, reasons: str, by: str | None = None) -> DataFrame:
    """How many rows each reason rejects."""
    keys = ["reason", *([by] if by else [])]
    return df.select(F.explode(reasons).alias("reason"), *([by] if by else [])).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def audit(df: DataFrame, reasons: str, by: str) -> DataFrame:
    """(by, total, kept, rejected) of rows with a reasons array."""
    kept = F.sum((F.size(reasons) == 0).cast("long"))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("total"), kept.alias("kept"), (F.count(F.lit(1)) - kept).alias("rejected"))


def audit_diff(raw: DataFrame, clean: DataFrame, by: str, length: str) -> DataFrame:
    """Per group: rows before and after, retention, and a warning for under a fifth kept, or a 99th percentile half as long again."""
    a = raw.groupBy(by).agg(F.count(F.lit(1)).alias("raw"), F.percentile(length, F.lit(0.99)).alias("raw_p99"))
    b = clean.groupBy(by).agg(F.count(F.lit(1)).alias("clean"), F.percentile(length, F.lit(0.99)).alias("clean_p99"))
    both = a.join(b, by, "full_outer").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("raw", "clean")})
    kept = F.when(F.col("raw") > 0, F.col("clean") / F.col("raw")).otherwise(F.lit(0.0))
    longer = F.coalesce(F.col("clean_p99") > 1.5 * F.col("raw_p99"), F.lit(False))
    return both.select(by, "raw", "clean", F.round(kept, 6).alias("retention"), F.array_join(T.reasons(("low_retention", kept < 0.2), ("longer_p99", longer)), ",").alias("warnings"))


def summary(df: DataFrame, ok: str, weight: str) -> DataFrame:
    """One row: rows, rate of ok, mean weight, rows of a weight above 0."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col(ok).cast("int")), 6).alias("ok_rate"), F.round(F.avg(weight), 6).alias("mean_weight"), F.sum((F.col(weight) > 0).cast("long")).alias("weighted"))
