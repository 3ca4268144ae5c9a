"""Run metrics, selections and gates: aggregates joined with tables of limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rates(df: DataFrame, by: str, flags: list[str], means: list[str]) -> DataFrame:
    """Per variant: the share of each flag and the mean of each number; 0 for what is never set."""
    share = [F.round(F.coalesce(F.avg(F.col(f).cast("int")), F.lit(0.0)), 6).alias(f"{f}_rate") for f in flags]
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *share, *(F.coalesce(F.avg(m), F.lit(0.0)).alias(f"avg_{m}") for m in means))


def against_base(metrics: DataFrame, by: str, base: str, means: list[str]) -> DataFrame:
    """Adds each mean's ratio to the base variant's, 1 where that is not above 0."""
    # One row: the base variant.
    own = metrics.where(F.col(by) == base).select(*(F.col(f"avg_{m}").alias(f"base_{m}") for m in means))
    ratio = {m: F.when(F.col(f"base_{m}") > 0, F.col(f"avg_{m}") / F.col(f"base_{m}")).otherwise(F.lit(1.0)) for m in means}
    both = metrics.join(F.broadcast(own), how="left")
    return both.select(*metrics.columns, *(F.round(r, 6).alias(f"{m}_ratio") for m, r in ratio.items()))


def long_form(df: DataFrame, key: str, names: list[str]) -> DataFrame:
    """(key, metric, value) rows."""
    pairs = F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names))
    return df.select(key, F.explode(pairs).alias("p")).select(key, "p.metric", "p.value")


def gate(metrics: DataFrame, limits: DataFrame, key: str) -> DataFrame:
    """Per key: passed, and the broken limits in order.

    limits has metric, kind (max or min), bound and missing: the value that stands in for a metric that
    is absent, null where absence breaks the limit.
    """
    every = metrics.select(key).distinct().crossJoin(F.broadcast(limits))
    both = every.join(metrics, [key, "metric"], "left").withColumn("seen", F.coalesce("value", "missing"))
    broken = F.col("seen").isNull() | F.when(F.col("kind") == "max", F.col("seen") > F.col("bound")).otherwise(F.col("seen") < F.col("bound"))
    names = F.array_sort(F.collect_list(F.when(broken, F.col("metric"))))
    return both.groupBy(key).agg(names.alias("v")).select(key, (F.size("v") == 0).alias("passed"), F.array_join("v", ",").alias("violations"))


# Default limits of a promotion.
PROMOTION = (
    ("preview_environment_rate", "max", 0.0, 0.0), ("assistant_documentclass_rate", "max", 0.0, 0.0), ("decorations_geometric_rate", "max", 0.0, 0.0), ("repetition_loop_rate", "max", 0.0, 0.0),
    ("assistant_usepackage_rate", "max", 0.02, 0.0), ("bad_pattern_pass_rate", "min", 0.98, 0.0), ("closing_fence_exactly_once_rate", "min", 0.95, 0.0), ("compile_rate", "min", 0.70, 0.0),
    ("substantive_rate", "min", 0.85, 0.0), ("avg_code_length_ratio_vs_base", "max", 1.6, 999.0), ("avg_raw_token_ratio_vs_base", "max", 1.6, 0.0), ("avg_code_token_ratio_vs_base", "max", 1.6, 0.0),
)
RELATIVE = {"compile_rate": 0.80, "substantive_rate": 0.90}


def promotion_limits(spark: SparkSession, base: dict[str, float] | None = None, overrides: dict[str, float] | None = None) -> DataFrame:
    """The limits of a promotion; a base raises the floors that are relative to it and caps repetition."""
    rows = []
    for metric, kind, bound, missing in PROMOTION:
        bound = (overrides or {}).get(metric, bound)
        if base and metric in RELATIVE and metric in base:
            bound = max(bound, RELATIVE[metric] * base[metric])
        if base and metric == "repetition_loop_rate":
            bound = min(bound, base.get(metric, 0.0))
        rows.append((metric, kind, float(bound), missing))
    return spark.createDataFrame(rows, "metric string, kind string, bound double, missing double")


def recovery_limits(spark: SparkSession, kind: str, base_compile: float | None = None) -> DataFrame:
    """The limits of a sentinel, ablation or promotion run; an absent metric fails."""
    rows = [("repetition_loop_rate", "max", 0.0 if kind == "sentinel" else 0.02, None), ("truncation_rate", "max", 0.10, None)]
    if kind != "sentinel":
        rows.append(("compile_rate", "min", max(0.20, 0.5 * (base_compile or 0.0)), None))
    return spark.createDataFrame(rows, "metric string, kind string, bound double, missing double")


def eligible() -> Column:
    """Whether a checkpoint's metrics allow it; what is absent does not."""
    worst = lambda name, value: F.coalesce(F.col(name), F.lit(value))
    clean = [worst(f"{n}_rate", 1.0) <= 0 for n in ("preview_environment", "assistant_usepackage", "assistant_documentclass", "decorations_geometric")]
    held = F.coalesce(~F.col("deterministic_loop"), F.lit(False)) & (worst("repetition_loop_rate", 1.0) <= 0.01) & (worst("substantive_rate", 0.0) >= 0.80)
    held = held & (worst("truncation_rate", 1.0) <= 0.05) & (worst("avg_code_length_ratio_vs_base", 99.0) <= 1.6)
    for c in clean:
        held = held & c
    return held


def checkpoint_order() -> list[Column]:
    """Least repetition, most substance, most compiled, length nearest to the base's, latest."""
    worst = lambda name, value: F.coalesce(F.col(name), F.lit(value))
    return [worst("repetition_loop_rate", 1.0), -worst("substantive_rate", 0.0), -worst("compile_rate", 0.0), F.abs(1 - worst("avg_code_length_ratio_vs_base", 2.0)), -worst("step", 0)]


def ranked(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first k rows of an order, with their rank from 1."""
    return df.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(W.orderBy(*order)))


def stable_checkpoint(df: DataFrame, base_emd: float, required: int = 5000) -> DataFrame:
    """The best checkpoint that did not collapse and is no farther than the base; the required iteration must be there."""
    if df.where(F.col("iteration") == required).isEmpty():
        raise ValueError(f"iteration {required} must be evaluated first")
    return df.where(~F.col("collapse") & (F.col("partial_emd") <= base_emd)).orderBy("partial_emd", F.desc("compile_rate"), "failure_rate", F.desc("iteration")).limit(1)


def best_attempt(df: DataFrame, group: str, keys: list[str], index: str) -> DataFrame:
    """Per group the attempt of the largest keys in turn; the later one of equals."""
    rest = F.struct(*df.columns)
    return df.groupBy(group).agg(F.max_by(rest, F.struct(*keys, index)).alias("r")).select("r.*")


def latest(df: DataFrame, group: str, order: str, keep: int, pinned: Column) -> DataFrame:
    """The newest rows of each group, and what is pinned."""
    rank = F.row_number().over(W.partitionBy(group).orderBy(F.desc(order)))
    return df.withColumn("_r", rank).where((F.col("_r") <= keep) | pinned).drop("_r")


def recently_used(df: DataFrame, key: str, step: str, keep: int) -> DataFrame:
    """(key, last): the keys last seen most recently."""
    return df.groupBy(key).agg(F.max(step).alias("last")).orderBy(F.desc("last"), key).limit(keep)


def series_summary(df: DataFrame, run: str, step: str, value: str, edge: int = 5) -> DataFrame:
    """Per run: first, last and least value, mean, and the means of the first and last `edge` points."""
    up, down = (F.row_number().over(W.partitionBy(run).orderBy(o)) for o in (F.asc(step), F.desc(step)))
    own = df.withColumn("_u", up).withColumn("_d", down)
    mean = lambda c: F.round(F.avg(c), 6)
    return own.groupBy(run).agg(
        F.count(F.lit(1)).alias("points"), F.min_by(value, step).alias("first"), F.max_by(value, step).alias("last"), F.min(value).alias("least"), mean(value).alias("mean"),
        mean(F.when(F.col("_u") <= edge, F.col(value))).alias("early"), mean(F.when(F.col("_d") <= edge, F.col(value))).alias("late"),
    )


def recent_window(df: DataFrame, run: str, step: str, values: list[str], n: int = 5) -> DataFrame:
    """Per run: the means of the last n points, and whether all of them are numbers."""
    last = df.withColumn("_d", F.row_number().over(W.partitionBy(run).orderBy(F.desc(step)))).where(F.col("_d") <= n)
    number = {v: F.col(v).cast("string").try_cast("double") for v in values}
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    whole = [F.bool_and(finite(c)) for c in number.values()]
    held = whole[0]
    for w in whole[1:]:
        held = held & w
    return last.groupBy(run).agg(F.count(F.lit(1)).alias("points"), held.alias("numeric"), *(F.round(F.avg(c), 6).alias(v) for v, c in number.items()))


def gradient_gate(recent: DataFrame, clipped: str, scale: str, n: int = 5, most_clipped: float = 1.0, least_scale: float = 0.05) -> Column:
    """Whether a recent window is full, numeric, not clipped too often nor scaled down too far."""
    return (F.col("points") >= n) & F.col("numeric") & (F.col(clipped) <= most_clipped) & (F.col(scale) >= least_scale)


def advantages(df: DataFrame, group: str, reward: str, scaled: bool = False) -> DataFrame:
    """Rewards less their group's mean, divided by its population deviation if that is above 1e-8."""
    own = W.partitionBy(group)
    centred = F.col(reward) - F.avg(reward).over(own)
    spread = F.stddev_pop(reward).over(own)
    return df.withColumn("advantage", F.when(spread > 1e-8, centred / spread).otherwise(centred) if scaled else centred)


def dominant(counts: list[str]) -> Column:
    """The name of the largest count, the first of equals, none if all are 0."""
    most = F.greatest(*counts)
    out = F.lit("none")
    for name in reversed(counts):
        out = F.when(F.col(name) == most, F.lit(name)).otherwise(out)
    return F.when(most > 0, out).otherwise("none")


def bad_steps(df: DataFrame, run: str, step: str, bad: Column) -> DataFrame:
    """Per run: the first bad step, and the last good one before it."""
    first = F.min(F.when(bad, F.col(step))).over(W.partitionBy(run))
    own = df.withColumn("first_bad", first)
    return own.groupBy(run).agg(F.first("first_bad").alias("first_bad"), F.max(F.when(~bad & (F.col("first_bad").isNull() | (F.col(step) < F.col("first_bad"))), F.col(step))).alias("last_good"))


def running_best(df: DataFrame, run: str, step: str, value: str) -> DataFrame:
    """Each point with the one before it, the best so far, and whether it is a new best."""
    own = W.partitionBy(run).orderBy(step)
    before = F.max(value).over(own.rowsBetween(W.unboundedPreceding, -1))
    return df.select(run, step, value, F.lag(step).over(own).alias("previous"), F.greatest(F.coalesce(before, F.col(value)), F.col(value)).alias("best"), (before.isNull() | (F.col(value) > before)).alias("new_best"))


def saturated_start(df: DataFrame, run: str, step: str, saturated: Column, k: int) -> DataFrame:
    """Per run with k windows or more: whether its first k are all saturated."""
    first = df.withColumn("_u", F.row_number().over(W.partitionBy(run).orderBy(step))).where(F.col("_u") <= k)
    return first.groupBy(run).agg(((F.count(F.lit(1)) >= k) & F.bool_and(saturated)).alias("saturated"))


def cursor(step: Column, n: Column) -> Column:
    """struct(epoch, cursor, remaining steps of the epoch) of a step over n examples."""
    return F.struct(F.floor(step / n).cast("long").alias("epoch"), (step % n).cast("long").alias("cursor"), (n - step % n).cast("long").alias("remaining"))


def learning_rate(step: Column, peak: float, warmup: int, total: int, floor: float = 0.0) -> Column:
    """Linear warm-up, then half a cosine down to the floor."""
    done = F.least(F.lit(1.0), (step - warmup) / F.lit(max(1, total - warmup)))
    return F.when(step < warmup, peak * step / F.lit(max(1, warmup))).otherwise(floor + (peak - floor) * 0.5 * (1 + F.cos(F.lit(3.141592653589793) * done)))


def scheduled(step: Column, points: dict[float, int], total: int) -> Column:
    """The value of the last breakpoint, a share of all steps, that is not after the step."""
    out = F.lit(points[min(points)])
    for share in sorted(points):
        out = F.when(step / total >= share, F.lit(points[share])).otherwise(out)
    return out


def tensor_norms(before: DataFrame, after: DataFrame) -> DataFrame:
    """(tensor, state, l2, delta_l2, mean_abs, max_abs) of rows (tensor, idx, value) in two states of a model."""
    a, b = (x.select("tensor", "idx", F.col("value").alias(n)) for x, n in ((before, "a"), (after, "b")))
    both = a.join(b, ["tensor", "idx"], "full_outer")
    state = F.when(F.count("a") == 0, "added").when(F.count("b") == 0, "removed").otherwise("kept")
    delta = F.coalesce("b", F.lit(0.0)) - F.coalesce("a", F.lit(0.0))
    r = lambda c: F.round(c, 6)
    return both.groupBy("tensor").agg(state.alias("state"), r(F.sqrt(F.sum(F.coalesce("b", F.lit(0.0)) ** 2))).alias("l2"), r(F.sqrt(F.sum(delta**2))).alias("delta_l2"), r(F.avg(F.abs(F.coalesce("b", F.lit(0.0))))).alias("mean_abs"), r(F.max(F.abs(F.coalesce("b", F.lit(0.0))))).alias("max_abs"))


def shaped_reward(base: Column, run: Column, share: Column, size: Column, truncated: Column) -> Column:
    """A reward less its penalties for repeated lines, one dominant command and truncation."""
    line = F.when(run >= 3, F.least(F.lit(0.35), (run - 2) * F.lit(0.03))).otherwise(0.0)
    command = F.when((size >= 20) & (share > 0.30), F.least(F.lit(0.20), (share - 0.30) * F.lit(0.75))).otherwise(0.0)
    return base - F.least(F.lit(0.45), line + command) - F.when(truncated, 0.08).otherwise(0.0)
