"""Deterministic splits, indices and samples. All orders come from hashes of keys, never from partition order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T


def unit(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 8 bytes of sha1(seed:key)."""
    digest = F.substring(F.sha1(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 16)
    return F.conv(digest, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)


def bucket(key: Column, seed: int = 17, val: float = 0.10, gold: float = 0.05) -> Column:
    """gold, val or train: a function of the key, so equal keys stay together without a shuffle."""
    x = unit(key, seed)
    return F.when(x < gold, "gold").when(x < gold + val, "val").otherwise("train")


def split_key(*parts: Column) -> Column:
    """The first part that is not empty."""
    return F.coalesce(*(T.filled(p.cast("string")) for p in parts))


def stable_id(source: Column, code: Column) -> Column:
    """16 hex digits of sha256(source, newline, code)."""
    return F.substring(F.sha2(F.concat_ws("\n", source, code), 256), 1, 16)


#: Ranges into which a global order is cut.
RANGES = 64


def _steps(value: Column, bounds: list[float]) -> Column:
    """How many of the ascending bounds lie below a value or equal it, by halving."""
    if not bounds:
        return F.lit(0)
    mid = len(bounds) // 2
    return F.when(value < bounds[mid], _steps(value, bounds[:mid])).otherwise(_steps(value, bounds[mid + 1 :]) + (mid + 1))


def ranked(df: DataFrame, order: list[Column], first: Column, second: Column | None = None, by: list[str] | None = None, bounds: list[float] | None = None, name: str = "position") -> DataFrame:
    """A rank from 0 in the order given, in each group or over all rows, that no single task has to make.

    first and second are numbers that ascend with the order's first two parts. Quantiles of the
    first cut the order into ranges, and where one value fills whole ranges, quantiles of the second cut
    it again; a row's rank is its rank in its range and the number of rows in the ranges before.
    Only quantiles and one count a range and group leave the tasks.
    """
    by = by or []
    cuts = [i / RANGES for i in range(1, RANGES)]
    if bounds is None:
        bounds = df.agg(F.percentile_approx(first.cast("double"), cuts, 1000)).first()[0] or []
    hot = sorted({b for i, b in enumerate(bounds) if i and bounds[i - 1] == b})
    # Twice the steps, one less at a bound itself: the values that are bounds are ranges of their own.
    x, steps = first.cast("double"), sorted(set(bounds))
    at = 2 * _steps(x, steps)
    slot = at - F.when(x.isin(steps), 1).otherwise(0) if hot else at
    inner = F.lit(0)
    if hot and second is not None:
        rows = df.where(x.isin(hot)).groupBy(x.alias("x")).agg(F.percentile_approx(second.cast("double"), cuts, 1000).alias("q")).collect()
        for row in rows:
            inner = F.when(x == row["x"], _steps(second.cast("double"), sorted(set(row["q"])))).otherwise(inner)
    own = df.withColumn("_slot", F.coalesce(slot, F.lit(-1))).withColumn("_inner", F.coalesce(inner, F.lit(-1)))
    sizes = own.groupBy(*by, "_slot", "_inner").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*by).orderBy("_slot", "_inner").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select(*(F.col(c).alias(f"_by{i}") for i, c in enumerate(by)), F.col("_slot").alias("_s"), F.col("_inner").alias("_i"), F.coalesce(before, F.lit(0)).alias("_before"))
    held = (F.col("_slot") == F.col("_s")) & (F.col("_inner") == F.col("_i"))
    for i, c in enumerate(by):
        held &= F.col(c).eqNullSafe(F.col(f"_by{i}"))
    inside = F.row_number().over(W.partitionBy(*by, "_slot", "_inner").orderBy(*order))
    joined = own.withColumn("_r", inside).join(starts, held)
    return joined.withColumn(name, (F.col("_before") + F.col("_r") - 1).cast("long")).select(*df.columns, name)


def indexed(df: DataFrame, split: str, order: str, name: str = "example_index") -> DataFrame:
    """A contiguous index from 0 in each split, in input order (a number)."""
    return ranked(df, [F.col(order)], F.col(order), by=[split], name=name)


def contiguity(df: DataFrame, split: str, index: str) -> DataFrame:
    """(split, n, contiguous): whether each split's index is 0 to n - 1, each once."""
    n = F.count(F.lit(1))
    held = (F.min(index) == 0) & (F.max(index) == n - 1) & (F.count_distinct(index) == n)
    return df.groupBy(split).agg(n.alias("n"), held.alias("contiguous"))


def paired(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """left with right's record of the same key, the last of several; unmatched ones carry matched = false."""
    last = right.groupBy(key).agg(F.max_by(F.struct(*[c for c in right.columns if c != key]), order).alias("pair"))
    return left.join(last, key, "left").withColumn("matched", F.col("pair").isNotNull())


def _rank(mode: str, key: str, seed: int) -> Column:
    """A record's place in its mode; with a filter to a fixed number, tasks hand on no more than that many a mode."""
    return F.row_number().over(W.partitionBy(mode).orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256), key))


def capped(df: DataFrame, mode: str, key: str, caps: dict[str, int | None], seed: int) -> DataFrame:
    """At most a cap of records a mode, chosen by hash; a mode without a cap, or with null, keeps all."""
    given = {k: v for k, v in caps.items() if v is not None}
    if not given:
        return df
    cap = F.create_map(*(F.lit(x) for pair in given.items() for x in pair))
    ruled = F.coalesce(F.col(mode).isin(list(given)), F.lit(False))
    chosen = df.where(ruled).withColumn("_r", _rank(mode, key, seed)).where((F.col("_r") <= max(given.values())) & (F.col("_r") <= F.try_element_at(cap, F.col(mode)))).drop("_r")
    return df.where(~ruled).unionByName(chosen)


def quotas(counts: dict[str, int], total: int, reserve: int = 0) -> dict[str, int]:
    """How many to take of each mode: equal shares, the remainder to the first modes, shortfalls to the smallest rests first."""
    modes = sorted(counts)
    if not modes:
        return {}
    free = {m: max(0, counts[m] - reserve) for m in modes}
    wanted = {m: total // len(modes) + (i < total % len(modes)) for i, m in enumerate(modes)}
    take = {m: min(wanted[m], free[m]) for m in modes}
    short = sum(wanted[m] - take[m] for m in modes)
    while short > 0:
        open_modes = sorted((m for m in modes if take[m] < free[m]), key=lambda m: (free[m] - take[m], m))
        if not open_modes:
            break
        for m in open_modes[:short]:
            take[m] += 1
        short -= min(short, len(open_modes))
    return take


def equal_sample(df: DataFrame, mode: str, key: str, total: int, seed: int, reserve: int = 0) -> DataFrame:
    """Equal numbers of each mode; only one count a mode reaches the driver."""
    counts = {r[0]: r[1] for r in df.groupBy(mode).count().collect()}
    take = quotas(counts, total, reserve)
    if not take:
        return df.limit(0)
    most = F.create_map(*(F.lit(x) for pair in take.items() for x in pair))[F.col(mode)]
    return df.withColumn("_r", _rank(mode, key, seed)).where((F.col("_r") <= max(take.values())) & (F.col("_r") <= most)).drop("_r")


def disjoint_sets(df: DataFrame, mode: str, key: str, sizes: dict[str, int], seed: int) -> DataFrame:
    """Equal-mode samples of given sizes that share no record; column eval_set names each."""
    out, rest = None, df
    for i, (name, size) in enumerate(sizes.items()):
        own = equal_sample(rest, mode, key, size, seed + i).withColumn("eval_set", F.lit(name))
        rest = rest.join(own.select(key), key, "left_anti")
        out = own if out is None else out.unionByName(own)
    return out


def round_robin(df: DataFrame, mode: str, key: str, n: int, seed: int) -> DataFrame:
    """n records, one of each mode in turn as long as the mode has any."""
    return df.withColumn("_r", _rank(mode, key, seed)).where(F.col("_r") <= n).orderBy("_r", mode).limit(n).drop("_r")


def fixed_sample(df: DataFrame, key: str, order: str, n: int, seed: int) -> DataFrame:
    """n records by hash, in input order."""
    return df.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256), key).limit(n).orderBy(order)


def epoch_order(df: DataFrame, index: str, seed: int, epoch: int) -> DataFrame:
    """(position, index): the order in which an epoch visits the examples."""
    digest = F.sha2(F.concat(F.lit(f"{seed + epoch}:"), F.col(index).cast("string")), 256)
    # Hashes are even: their ranges are known.
    first = F.conv(F.substring("_h", 1, 8), 16, 10).cast("double")
    own = df.select(index, digest.alias("_h"))
    return ranked(own, [F.col("_h"), F.col(index)], first, bounds=[i * 2.0**32 / RANGES for i in range(1, RANGES)]).select("position", index)


def whole_batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """Without the tail that fills no batch."""
    rest = df.count() % size
    # Fewer rows than a batch has.
    tail = df.select(order).orderBy(F.desc(order)).limit(rest)
    return df.join(F.broadcast(tail), order, "left_anti").select(*df.columns) if rest else df


def bridge(a: DataFrame, b: DataFrame, length: str, order: str) -> DataFrame:
    """The longer half of a and the shorter half of b."""
    late, early = (ranked(df, [F.col(length), F.col(order)], F.col(length), F.col(order), name="_r") for df in (a, b))
    return late.where(F.col("_r") >= a.count() // 2).unionByName(early.where(F.col("_r") < b.count() // 2)).drop("_r")


def apportion(sizes: list[int], total: int, n: int | None = None) -> list[int]:
    """Shares of total in proportion to sizes, largest remainders first; every size above 0 gets 1 if that many are to be had."""
    n = sum(sizes) if n is None else n
    out = [0] * len(sizes)
    some = [i for i, s in enumerate(sizes) if s > 0]
    if total <= 0 or n <= 0 or not some:
        return out
    if total < len(some):
        for i in some[:total]:
            out[i] = 1
        return out
    left = total - len(some)
    shares = {i: left * (sizes[i] / n) for i in some}
    for i in some:
        out[i] = 1 + int(shares[i])
    most = sorted(some, key=lambda i: int(shares[i]) - shares[i])
    for j in range(left - sum(int(s) for s in shares.values())):
        out[most[j % len(most)]] += 1
    return out


def length_centres(df: DataFrame, length: str, k: int, rounds: int = 100) -> list[float]:
    """Sorted 1-D k-means centres of whole-number lengths, from their histogram: a row for each length that occurs."""
    rows = sorted((r[0], r[1]) for r in df.where(f"{length} is not null").groupBy(length).count().collect())
    if not rows:
        return []
    low, high = rows[0][0], rows[-1][0]
    centres = [low + (high - low) * i / (k - 1) if k > 1 else float(low) for i in range(k)]
    for _ in range(rounds):
        total, times = [0] * k, [0] * k
        for value, n in rows:
            i = min(range(k), key=lambda j: (abs(value - centres[j]), j))
            total[i] += value * n
            times[i] += n
        new = [total[i] / times[i] if times[i] else centres[i] for i in range(k)]
        if new == centres:
            break
        centres = new
    return sorted(centres)


def stage_of(length: Column, centres: list[float]) -> Column:
    """Stage 1 to k by the midpoints between centres; a midpoint belongs to the lower stage."""
    out = F.lit(len(centres))
    for i in range(len(centres) - 2, -1, -1):
        out = F.when(length <= (centres[i] + centres[i + 1]) / 2, F.lit(i + 1)).otherwise(out)
    return out


def probe_split(df: DataFrame, mode: str, key: str, size: int, seed: int, keep: int = 0) -> DataFrame:
    """df with `probe`: an equal-mode sample held out, which leaves at least `keep` records of each mode where it has more."""
    probe = equal_sample(df.select(mode, key), mode, key, size, seed, keep).select(F.col(key).alias("_p"))
    return df.join(F.broadcast(probe), F.col(key) == F.col("_p"), "left").withColumn("probe", F.col("_p").isNotNull()).drop("_p")


def manifest_rows(records: DataFrame, ids: DataFrame, key: str, order: str, first: bool = False, most: int | None = None) -> DataFrame:
    """The records that (position, key) names, in its order, `most` of them; ids without a record are left out; of several records of a key the last, or the first."""
    pick = F.min_by if first else F.max_by
    own = records.groupBy(key).agg(pick(F.struct(*[c for c in records.columns if c != key]), order).alias("r"))
    found = ids.join(own, key).select("position", key, "r.*").orderBy("position")
    return found if most is None else found.limit(most)


def grid(spark: SparkSession, **options: list) -> DataFrame:
    """Every combination of small option lists."""
    out = spark.range(1).drop("id")
    for name, values in options.items():
        out = out.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return out
