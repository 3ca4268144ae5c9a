"""Run metrics, gates, telemetry and similarity."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import similarity as V
from ..session import ship
from .base import query, table

_VARIANTS = "v as (select case o_orderkey % 3 when 0 then 'base' when 1 then 'one' else 'two' end variant, o_orderstatus = 'F' compile, o_totalprice < 300000 bad_pattern_pass, o_orderpriority = '1-URGENT' repetition_loop, floor(o_totalprice) as code_length from orders)"
_RATES = "m as (select variant, count(*) n, round(avg(compile::int), 6) compile_rate, round(avg(bad_pattern_pass::int), 6) bad_pattern_pass_rate, round(avg(repetition_loop::int), 6) repetition_loop_rate, avg(code_length) avg_code_length from v group by 1)"


def _variants(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    name = F.when(F.col("o_orderkey") % 3 == 0, "base").when(F.col("o_orderkey") % 3 == 1, "one").otherwise("two")
    own = o.select(name.alias("variant"), (F.col("o_orderstatus") == "F").alias("compile"), (F.col("o_totalprice") < 300000).alias("bad_pattern_pass"), (F.col("o_orderpriority") == "1-URGENT").alias("repetition_loop"), F.floor("o_totalprice").cast("double").alias("code_length"))
    return M.rates(own, "variant", ["compile", "bad_pattern_pass", "repetition_loop"], ["code_length"])


@query(f"with {_VARIANTS}, {_RATES} select variant, n, compile_rate, bad_pattern_pass_rate, repetition_loop_rate, round(avg_code_length, 4) as avg_code_length, round(avg_code_length / (select avg_code_length from m where variant = 'base'), 6) as code_length_ratio from m")
def variant_metrics(spark, sf_dir):
    return M.against_base(_variants(spark, sf_dir), "variant", "base", ["code_length"]).withColumn("avg_code_length", F.round("avg_code_length", 4))


@query(f"""with {_VARIANTS}, {_RATES}, c as (select variant, list_sort(list_filter([case when bad_pattern_pass_rate < 0.98 then 'bad_pattern_pass_rate' end, case when compile_rate < 0.70 then 'compile_rate' end, 'avg_code_length_ratio_vs_base', 'closing_fence_exactly_once_rate',
case when repetition_loop_rate > 0 then 'repetition_loop_rate' end, 'substantive_rate'], lambda x: x is not null)) v from m) select variant, len(v) = 0 as passed, array_to_string(v, ',') as violations from c""")
def promotion_gate(spark, sf_dir):
    long = M.long_form(_variants(spark, sf_dir), "variant", ["compile_rate", "bad_pattern_pass_rate", "repetition_loop_rate"])
    return M.gate(long, M.promotion_limits(spark), "variant")


@query(f"""with {_VARIANTS}, {_RATES}, c as (select variant, list_sort(list_filter([case when compile_rate < greatest(0.20, 0.5 * (select compile_rate from m where variant = 'base')) then 'compile_rate' end, case when repetition_loop_rate > 0.02 then 'repetition_loop_rate' end, 'truncation_rate'], lambda x: x is not null)) v from m)
select variant, len(v) = 0 as passed, array_to_string(v, ',') as violations from c""")
def recovery_gate(spark, sf_dir):
    own = _variants(spark, sf_dir)
    base = own.where("variant = 'base'").first()["compile_rate"]
    return M.gate(M.long_form(own, "variant", ["compile_rate", "repetition_loop_rate"]), M.recovery_limits(spark, "promotion", base), "variant")


_SERIES = "s as (select user_id as run, row_number() over (partition by user_id order by ts, event_id) as step, value, event_type from events)"


def _series(spark, sf_dir):
    order = W.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.row_number().over(order).cast("long").alias("step"), "value", "event_type")


@query(f"""with {_SERIES}, d as (select *, row_number() over (partition by run order by step desc) d from s) select run, count(*) points, first(value order by step) as first, last(value order by step) as last, min(value) least, round(avg(value), 6) mean,
round(avg(value) filter (step <= 5), 6) early, round(avg(value) filter (d <= 5), 6) late from d group by 1""")
def telemetry_summary(spark, sf_dir):
    return M.series_summary(_series(spark, sf_dir), "run", "step", "value")


@query(f"""with {_SERIES}, d as (select *, row_number() over (partition by run order by step desc) d from s), w as (select run, count(*) points, bool_and(try_cast(value as double) is not null) as numeric, round(avg(value / 1000), 6) clipped, round(avg(value), 6) as scale from d where d <= 5 group by 1)
select run, points, clipped, scale, points >= 5 and numeric and clipped <= 1.0 and scale >= 0.05 as passed from w""")
def gradient_gate(spark, sf_dir):
    own = _series(spark, sf_dir).withColumn("clipped", F.col("value") / 1000).withColumn("scale", F.col("value"))
    recent = M.recent_window(own, "run", "step", ["clipped", "scale"])
    return recent.select("run", "points", "clipped", "scale", M.gradient_gate(F.col("run"), "clipped", "scale").alias("passed"))


@query("select o_orderkey, round(case when stddev_pop(o_totalprice) over w > 1e-8 then (o_totalprice - avg(o_totalprice) over w) / stddev_pop(o_totalprice) over w else 0 end, 4) as advantage from orders window w as (partition by o_custkey)")
def group_advantage(spark, sf_dir):
    own = M.advantages(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey", "o_totalprice", scaled=True)
    return own.select("o_orderkey", (F.round("advantage", 4) + F.lit(0.0)).alias("advantage"))


def _checkpoints(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    cols = {
        "step": F.col("p_partkey"), "repetition_loop_rate": (F.col("p_size") % 4) / 200.0, "substantive_rate": 0.75 + (F.col("p_partkey") % 26) / 100.0, "compile_rate": (F.col("p_partkey") % 11) / 10.0,
        "truncation_rate": (F.col("p_size") % 9) / 100.0, "avg_code_length_ratio_vs_base": F.when(F.col("p_partkey") % 7 > 0, 0.8 + (F.col("p_partkey") % 10) / 10.0), "deterministic_loop": F.col("p_partkey") % 5 == 0,
        "preview_environment_rate": F.lit(0.0), "assistant_usepackage_rate": F.lit(0.0), "assistant_documentclass_rate": F.lit(0.0), "decorations_geometric_rate": F.when(F.col("p_partkey") % 13 > 0, 0.0),
    }
    return p.select(*(c.alias(n) for n, c in cols.items()))


_CK = """k as (select p_partkey step, (p_size % 4) / 200.0 r, 0.75 + (p_partkey % 26) / 100.0 s, (p_partkey % 11) / 10.0 c, (p_size % 9) / 100.0 t, case when p_partkey % 7 > 0 then 0.8 + (p_partkey % 10) / 10.0 end l, p_partkey % 5 = 0 d, p_partkey % 13 > 0 ok from part),
e as (select * from k where not d and ok and r <= 0.01 and s >= 0.80 and t <= 0.05 and coalesce(l, 99) <= 1.6)"""


@query(f"with {_CK} select step, row_number() over (order by r, -s, -c, abs(1 - l), -step)::int as rank from e order by rank limit 5")
def best_checkpoint(spark, sf_dir):
    return M.ranked(_checkpoints(spark, sf_dir).where(M.eligible()), M.checkpoint_order(), 5).select("step", "rank")


@query(f"with {_SERIES}, b as (select *, min(step) filter (event_type = 'error') over (partition by run) f from s) select run, any_value(f) as first_bad, max(step) filter (event_type <> 'error' and (f is null or step < f)) as last_good from b group by 1")
def first_bad_step(spark, sf_dir):
    return M.bad_steps(_series(spark, sf_dir), "run", "step", F.col("event_type") == "error")


@query(f"with {_SERIES}, b as (select *, max(value) over (partition by run order by step rows between unbounded preceding and 1 preceding) p from s) select run, step, value, lag(step) over (partition by run order by step) as previous, greatest(coalesce(p, value), value) as best, p is null or value > p as new_best from b")
def checkpoint_chain(spark, sf_dir):
    return M.running_best(_series(spark, sf_dir), "run", "step", "value")


@query(f"with {_SERIES} select run, count(*) >= 3 and bool_and(value > 20) as saturated from s where step <= 3 group by 1")
def watchdog(spark, sf_dir):
    return M.saturated_start(_series(spark, sf_dir), "run", "step", F.col("value") > 20, 3)


@query(f"with {_SERIES}, r as (select *, row_number() over (partition by run order by step desc) d from s) select run, step from r where d <= 2 or step % 10 = 0")
def checkpoint_retention(spark, sf_dir):
    return M.latest(_series(spark, sf_dir), "run", "step", 2, F.col("step") % 10 == 0).select("run", "step")


@query("select user_id, max(event_id) as last from events group by 1 order by 2 desc, 1 limit 10")
def retention_queue(spark, sf_dir):
    return M.recently_used(table(spark, sf_dir, "events"), "user_id", "event_id", 10)


@query("select l_orderkey, max({'a': l_returnflag = 'A', 'q': l_quantity, 'l': l_linenumber}).l as attempt from lineitem group by 1")
def best_attempt(spark, sf_dir):
    own = table(spark, sf_dir, "lineitem").select("l_orderkey", (F.col("l_returnflag") == "A").alias("ok"), "l_quantity", "l_linenumber")
    return M.best_attempt(own, "l_orderkey", ["ok", "l_quantity"], "l_linenumber").select("l_orderkey", F.col("l_linenumber").alias("attempt"))


@query("""with c as (select user_id, count(*) filter (event_type = 'click') click, count(*) filter (event_type = 'error') error, count(*) filter (event_type = 'view') as view from events group by 1)
select user_id, case when greatest(click, error, view) = 0 then 'none' when click = greatest(click, error, view) then 'click' when error = greatest(click, error, view) then 'error' else 'view' end as reason from c""")
def dominant_failure(spark, sf_dir):
    kinds = ["click", "error", "view"]
    own = table(spark, sf_dir, "events").groupBy("user_id").agg(*(F.sum((F.col("event_type") == k).cast("long")).alias(k) for k in kinds))
    return own.select("user_id", M.dominant(kinds).alias("reason"))


@query("""with a as (select l_suppkey tensor, l_orderkey * 10 + l_linenumber idx, l_quantity v from lineitem where l_suppkey % 3 > 0), b as (select l_suppkey tensor, l_orderkey * 10 + l_linenumber idx, l_quantity + l_discount v from lineitem where l_suppkey % 3 < 2),
j as (select coalesce(a.tensor, b.tensor) tensor, a.v a, b.v b from a full join b on a.tensor = b.tensor and a.idx = b.idx)
select tensor, case when count(a) = 0 then 'added' when count(b) = 0 then 'removed' else 'kept' end state, round(sqrt(sum(coalesce(b, 0) ** 2)), 4) l2, round(sqrt(sum((coalesce(b, 0) - coalesce(a, 0)) ** 2)), 4) delta_l2, round(max(abs(coalesce(b, 0))), 6) max_abs from j group by 1""")
def tensor_norms(spark, sf_dir):
    own = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("tensor"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("idx"), "l_quantity", "l_discount")
    a = own.where("tensor % 3 > 0").withColumn("value", F.col("l_quantity"))
    b = own.where("tensor % 3 < 2").withColumn("value", F.col("l_quantity") + F.col("l_discount"))
    return M.tensor_norms(a, b).select("tensor", "state", F.round("l2", 4).alias("l2"), F.round("delta_l2", 4).alias("delta_l2"), "max_abs")


@query("""select s.range as step, round(case when s.range < 100 then 0.001 * s.range / 100 else 0.0001 + 0.0009 * 0.5 * (1 + cos(3.141592653589793 * least(1.0, (s.range - 100) / 900.0))) end, 9) as rate, case when s.range >= 800 then 2048 when s.range >= 300 then 1024 else 512 end as length, (s.range // 70)::bigint as epoch, s.range % 70 as cursor from range(0, 1200, 25) s""")
def schedules(spark, sf_dir):
    step = F.col("step")
    place = M.cursor(step, F.lit(70))
    return spark.range(0, 1200, 25).select(F.col("id").alias("step")).select("step", F.round(M.learning_rate(step, 0.001, 100, 1000, 0.0001), 9).alias("rate"), M.scheduled(step, {0.0: 512, 0.3: 1024, 0.8: 2048}, 1000).alias("length"), place["epoch"].alias("epoch"), place["cursor"].alias("cursor"))


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")


def _vector_pairs(spark, sf_dir, queries=None):
    ship(spark)
    # A row holds two blocks of vectors.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    # Labels meet their successors: the sets that are compared are given, not all pairs of vectors.
    return V.block_pairs(_vectors(spark, sf_dir), queries)


_COS = "p as (select a.label a, b.label b, a.vec_id i, b.vec_id j, list_cosine_similarity(a.embedding::double[], b.embedding::double[]) c from embeddings a join embeddings b on b.label = a.label + 1)"


@query(f"with {_COS} select i, j, round(c, 6) as cosine from p where i % 100 = 0")
def cosine_pairs(spark, sf_dir):
    # A search: its queries are the vectors whose id is divisible by 100, against all of the next label.
    return V.all_cosines(_vector_pairs(spark, sf_dir, F.col("vec_id") % 100 == 0)).select("i", "j", F.round("cosine", 6).alias("cosine"))


@query(f"with {_COS}, x as (select a, b, avg(m) x from (select a, b, i, max(c) m from p group by all) group by all), y as (select a, b, avg(m) y from (select a, b, j, max(c) m from p group by all) group by all) select a::bigint as a, b::bigint as b, round((x + y) / 2, 6) as score from x join y using (a, b)")
def selfsim_by_label(spark, sf_dir):
    return V.set_similarity(_vector_pairs(spark, sf_dir))


@query()
def emd_pairs(spark, sf_dir):
    ship(spark)
    sets = _vectors(spark, sf_dir).groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))), lambda x: x["embedding"]).alias("v"))
    other = sets.select((F.col("label") - 1).alias("label"), F.col("v").alias("w"))
    # Few rows of much work each: dealt one by one; by chance two would often meet in one task.
    return sets.join(other, "label").repartitionByRange(2 * spark.sparkContext.defaultParallelism, "label").select("label", V.transport("v", "w").alias("r")).select("label", F.round("r.score", 6).alias("score"), "r.backend")


@query("select user_id, count(*) n, round(coalesce(avg(value) filter (event_type = 'purchase'), 0), 6) as mean_purchase, round(avg((event_type = 'error')::int), 6) as error_rate from events group by 1")
def evaluation_summary(spark, sf_dir):
    mean = F.coalesce(F.avg(F.when(F.col("event_type") == "purchase", F.col("value"))), F.lit(0.0))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.round(mean, 6).alias("mean_purchase"), F.round(F.avg((F.col("event_type") == "error").cast("int")), 6).alias("error_rate"))


@query("select event_id, round(value / 100 - least(0.45, case when event_id % 9 >= 3 then least(0.35, (event_id % 9 - 2) * 0.03) else 0 end + case when user_id % 40 >= 20 and value / 100 > 0.30 then least(0.20, (value / 100 - 0.30) * 0.75) else 0 end) - case when event_type = 'error' then 0.08 else 0 end, 6) as reward from events")
def shaped_reward(spark, sf_dir):
    value = F.col("value") / 100
    return table(spark, sf_dir, "events").select("event_id", F.round(M.shaped_reward(value, F.col("event_id") % 9, value, F.col("user_id") % 40, F.col("event_type") == "error"), 6).alias("reward"))
