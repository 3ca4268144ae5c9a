"""Checks before and after a run: floors, skips, refusals, audits, verdicts, plans and manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def length_floor(df: DataFrame, length: Column, least: int) -> DataFrame:
    """Rows whose length is a whole number of at least that; what is none is left out."""
    return df.where(F.try_to_number(F.regexp_extract(length.cast("string"), r"\A[\t\n\x0B\f\r ]*([0-9]{1,18})[\t\n\x0B\f\r ]*\z", 1), F.lit("9" * 18)) >= least)


def skip_reasons(tokens: Column, most: int, ratio: float = 0.20, n: int = 4, least: int = 40) -> Column:
    """over_length, and repetitive if one n-gram makes up over `ratio` of at least `least` tokens."""

    def found(own: Column) -> Column:
        # Equal n-grams are neighbours once their hashes are sorted.
        grams = F.transform(F.sequence(F.lit(1), F.size(own) - (n - 1)), lambda i: F.xxhash64(F.slice(own, i, n)).cast("string"))
        share = F.when(F.size(own) >= least, T.longest_run(F.array_sort(grams)) * n / F.size(own))
        return T.reasons(("over_length", F.size(own) > most), ("repetitive", F.coalesce(share > ratio, F.lit(False))))

    return T.let(tokens, found)


def refuse(df: DataFrame, held: Column, message: str) -> DataFrame:
    """The rows as they are; an error if the condition holds of any, for which one such row is enough."""
    if not df.where(held).limit(1).isEmpty():
        raise ValueError(message)
    return df


def reason_totals(df: DataFrame, reasons: str) -> DataFrame:
    """(reason, n): how many rows show each reason, all rows and those without any."""
    marks = F.concat(F.array(F.lit("rows")), F.when(F.size(reasons) == 0, F.array(F.lit("passed"))).otherwise(F.col(reasons)))
    return df.select(F.explode(marks).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def first_failures(df: DataFrame, reasons: str, order: str, rows: int, failures: int = 50) -> DataFrame:
    """Of the first rows in order those with reasons, the first `failures` of them."""
    return df.orderBy(order).limit(rows).where(F.size(reasons) > 0).orderBy(order).limit(failures)


def verdict(violations: dict[str, DataFrame]) -> DataFrame:
    """(kind, n) of each kind's violations, and a row `pass` of 1 if there is none at all."""
    out = None
    for kind, rows in violations.items():
        own = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = own if out is None else out.union(own)
    total = out.agg((F.sum("n") == 0).cast("long").alias("n")).select(F.lit("pass").alias("kind"), "n")
    return out.union(total)


def manifest(df: DataFrame, split: str, key: str) -> DataFrame:
    """(split, n, first, last, digest): each split's size, its extreme keys and an order-free digest of all its keys."""
    part = F.conv(F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 15), 16, 10).cast("long")
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.max(key).alias("last"), F.bit_xor(part).alias("digest"))


def prelaunch_failures(stages: DataFrame) -> DataFrame:
    """(stage, failures) of rows (stage, rows, cached, batch_size, accumulation, iterations, most_tokens, cached_tokens, digest, cached_digest).

    A stage takes batches of one, its rows rounded up to whole accumulations as iterations, and a cache
    of the same rows, token limit and source; nulls of the cache's audit are not compared.
    """
    c = F.col
    whole = F.ceil(c("rows") / c("accumulation")) * c("accumulation")
    failed = T.reasons(
        ("batch_size", c("batch_size") != 1), ("accumulation", c("accumulation") <= 0), ("iterations", F.coalesce(c("iterations") != whole, F.lit(True))),
        ("cache_missing", c("cached").isNull()), ("cache_length", F.coalesce(c("cached") != c("rows"), F.lit(False))),
        ("cache_tokens", F.coalesce(c("cached_tokens") != c("most_tokens"), F.lit(False))), ("cache_source", F.coalesce(c("cached_digest") != c("digest"), F.lit(False))),
    )
    return stages.select("stage", failed.alias("failures"))


def resumable(adapters: DataFrame, archive: DataFrame, digest: str, promoted: Column) -> DataFrame:
    """Adapters with resumable: promoted, and in the archive by digest."""
    known = archive.select(F.col(digest).alias("_d")).distinct().withColumn("_known", F.lit(True))
    return adapters.join(known, adapters[digest] == F.col("_d"), "left").withColumn("resumable", F.coalesce(promoted, F.lit(False)) & F.col("_known").isNotNull()).drop("_d", "_known")


def success_rate(df: DataFrame, code: Column, ok: Column, order: str, probe: int) -> DataFrame:
    """One row over the first rows that have code: attempted, successful and their rate, 0 without any."""
    head = df.orderBy(order).limit(probe).where(T.filled(code).isNotNull())
    n, good = F.count(F.lit(1)), F.coalesce(F.sum(F.coalesce(ok, F.lit(False)).cast("long")), F.lit(0))
    return head.agg(n.alias("attempted"), good.alias("successful"), F.when(n > 0, F.round(good / n, 6)).otherwise(0.0).alias("rate"))


def context_size(p95: Column, low: int = 512, high: int = 1536) -> Column:
    """The 95th percentile, its fraction cut off, up to a multiple of 128, between two limits."""
    return F.greatest(F.lit(low), F.least(F.lit(high), (F.ceil(F.floor(p95) / 128) * 128))).cast("int")


def iterations(rows: Column, epochs: float, batch: int, accumulation: int, given: int | None = None) -> Column:
    """Steps of so many epochs unless they are given, up to whole accumulations."""
    steps = F.lit(given) if given and given > 0 else F.ceil(rows * epochs / batch)
    return (F.ceil(steps / accumulation) * accumulation).cast("long")


def raised_temperature(base: Column, rounds: Column, step: float = 0.15, most: float = 0.90) -> Column:
    """A temperature raised a step a round to a limit; null counts as 0 once there is a round."""
    return F.when(rounds <= 0, base).otherwise(F.least(F.lit(most), F.coalesce(base, F.lit(0.0)) + rounds * step))


def learning_summary(df: DataFrame, run: str, step: str, loss: str, accumulation: int, least_updates: int, least_drop: float) -> DataFrame:
    """(run, reports, first, last, drop, updates, warning): a warning for enough updates with too small a drop of the loss."""
    own = df.where(F.col(loss).isNotNull()).groupBy(run).agg(F.count(F.lit(1)).alias("reports"), F.min_by(loss, step).alias("first"), F.max_by(loss, step).alias("last"), F.floor(F.max(step) / accumulation).alias("updates"))
    drop = F.col("first") - F.col("last")
    return own.select(run, "reports", "first", "last", F.round(drop, 6).alias("drop"), "updates", ((F.col("updates") >= least_updates) & (drop < least_drop)).alias("warning"))


def render_reasons(width: Column, height: Column, ink: Column) -> Column:
    """Why a rendering is no good: a side under 5 points (unless neither is known), under 32 pixels, under a thousandth of ink."""
    known = (width > 0) | (height > 0)
    return T.reasons(("invisible", known & ((width < 5) | (height < 5))), ("too_small", (width < 32) | (height < 32)), ("blank", ink < 0.001))


def audit_warnings(raw: DataFrame, clean: DataFrame, probe: DataFrame, mode: str, text: str, markers: dict[str, str]) -> DataFrame:
    """(warning, subject): one mode over 95 percent, markers left in the clean rows, modes whose share in the probe is over 0.30 off."""
    n, m, r = clean.count(), probe.count(), raw.count()
    shares = clean.groupBy(mode).agg(F.count(F.lit(1)).alias("c")).join(probe.groupBy(mode).agg(F.count(F.lit(1)).alias("p")), mode, "full_outer").withColumns({c: F.coalesce(c, F.lit(0)) for c in "cp"})
    out = shares.where(F.col("c") > 0.95 * n).select(F.lit("one_mode").alias("warning"), F.col(mode).alias("subject"))
    if n and m:
        skewed = shares.where((F.col("p") > 0) & (F.abs(F.col("p") / m - F.col("c") / n) > 0.30))
        out = out.union(skewed.select(F.lit("probe_skew"), mode))
    totals = clean.agg(*(F.coalesce(F.sum(T.count(F.col(text), p)), F.lit(0)).alias(k) for k, p in markers.items()))
    marks = totals.select(F.explode(F.array(*(F.struct(F.lit(k).alias("subject"), F.col(k).alias("n")) for k in markers))).alias("x")).where("x.n > 0")
    out = out.union(marks.select(F.lit("marker"), "x.subject"))
    if r and n < 0.20 * r:
        out = out.union(clean.sparkSession.range(1).select(F.lit("retention"), F.lit("rows")))
    return out


def stable_json(*columns: str) -> Column:
    """SHA-256 of a row's compact JSON with keys in order; null fields are written."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def compile_and_repair(df: DataFrame, code: str, compiles: Column, repair: Column, cache: DataFrame | None = None) -> DataFrame:
    """df with `final` and `outcome`: cached, ok, repaired or failed.

    Texts whose hash is in the cache (content_hash, final) are not compiled again; of the others those
    that fail are repaired and compiled once more. compiles is a condition on column `code`, repair a value of it;
    both may be plug-ins.
    """
    own = df.withColumn("content_hash", F.sha2(code, 256))
    if cache is not None:
        known = cache.groupBy("content_hash").agg(F.min("final").alias("_cached"))
        own = own.join(known, "content_hash", "left")
    else:
        own = own.withColumn("_cached", F.lit(None).cast("string"))
    new = own.withColumn("_mended", F.when(F.col("_cached").isNull() & ~compiles, repair))
    again = new.withColumn("_first", compiles).withColumn("_own", F.col(code)).withColumn(code, F.coalesce("_mended", code)).withColumn("_second", F.col("_mended").isNotNull() & compiles).withColumn(code, F.col("_own"))
    outcome = F.when(F.col("_cached").isNotNull(), "cached").when(F.col("_first"), "ok").when(F.col("_second"), "repaired").otherwise("failed")
    final = F.when(outcome == "cached", F.col("_cached")).when(outcome == "ok", F.col(code)).when(outcome == "repaired", F.col("_mended"))
    return again.withColumn("outcome", outcome).withColumn("final", final).select(*df.columns, "content_hash", "outcome", "final")
