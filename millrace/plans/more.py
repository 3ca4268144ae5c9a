"""Sorts, rankings, alignments and counts that are one expression each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import metrics as M
from ..operators import profiles as P
from ..operators import splits as S
from .base import query, table
from .records import CODES, codes


@query("select o_orderkey, row_number() over (order by coalesce(case when o_orderkey % 4 > 0 then o_totalprice end, 1.0), o_orderkey) - 1 as position from orders")
def curriculum_sort(spark, sf_dir):
    score = F.coalesce(F.when(F.col("o_orderkey") % 4 > 0, F.col("o_totalprice")), F.lit(1.0))
    own = table(spark, sf_dir, "orders").select("o_orderkey", score.alias("score"))
    return S.ranked(own, [F.col("score"), F.col("o_orderkey")], F.col("score"), F.col("o_orderkey")).drop("score")


@query("select doc_id from documents order by doc_id limit 40")
def head_rows(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").orderBy("doc_id").limit(40)


@query("select l_suppkey, round(avg((l_returnflag = 'A')::int), 6) as rate, row_number() over (order by round(avg((l_returnflag = 'A')::int), 6) desc, l_suppkey)::int as rank from lineitem group by 1 order by rank limit 4")
def sweep_survivors(spark, sf_dir):
    rates = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.round(F.avg((F.col("l_returnflag") == "A").cast("int")), 6).alias("rate"))
    return M.ranked(rates, [F.desc("rate"), F.asc("l_suppkey")], 4)


@query("select event_id, event_type from events where event_type = 'error' and value > 10 order by value desc, event_id limit 20")
def worst_cases(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_type = 'error' and value > 10").orderBy(F.desc("value"), "event_id").limit(20).select("event_id", "event_type")


@query(rf"with {CODES} select l as library, count(*) n from (select unnest(list_filter(list_transform(string_split(array_to_string(regexp_extract_all(code, '\\usetikzlibrary\{{([^}}]+)\}}', 1), ','), ','), lambda x: trim(x)), lambda x: x <> '')) l from codes) group by 1")
def dependency_counts(spark, sf_dir):
    names = F.filter(F.transform(F.split(F.array_join(F.regexp_extract_all("code", F.lit(r"\\usetikzlibrary\{([^}]+)\}"), F.lit(1)), ","), ","), T.strip), lambda x: x != "")
    return codes(spark, sf_dir).select(F.explode(names).alias("library")).groupBy("library").agg(F.count(F.lit(1)).alias("n"))


@query(rf"with {CODES}, c as (select *, regexp_replace(code, '(?m)(^|[^\\])%[^\n]*', '\1', 'g') as new from codes) select count(*) n, count(*) filter (code <> new) as changed, count(*) filter (code = new) as unchanged, sum(length(code) - length(new))::bigint as characters from c")
def cleaning_counts(spark, sf_dir):
    own = codes(spark, sf_dir).withColumn("new", T.without_comments(F.col("code")))
    changed = (F.col("code") != F.col("new")).cast("long")
    return own.agg(F.count(F.lit(1)).alias("n"), F.sum(changed).alias("changed"), F.sum(1 - changed).alias("unchanged"), F.sum(F.length("code") - F.length("new")).cast("long").alias("characters"))


@query("select doc_id, row_number() over (order by doc_id) - 1 as row, quality from (select doc_id, max(quality) quality from labels group by 1) where doc_id not in (select item_id from benchmark)")
def metadata_alignment(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    skipped = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"))
    kept = labels.join(skipped, "doc_id", "left_anti")
    return S.ranked(kept, [F.col("doc_id")], F.col("doc_id"), name="row").select("doc_id", "row", "quality")


@query("with i as (select doc_id, row_number() over (order by sha256('3:' || doc_id), doc_id) - 1 as example_index from documents) select example_index, doc_id as row from i")
def index_row_map(spark, sf_dir):
    return S.epoch_order(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 3, 0).select(F.col("position").alias("example_index"), F.col("doc_id").alias("row"))


@query("select o_orderstatus as status, quantile_cont(length(o_orderpriority), [0.5, 0.95])[2]::int as p95, count(*) n from orders group by 1")
def whole_quantiles(spark, sf_dir):
    own = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.length("o_orderpriority").alias("l"))
    return own.groupBy("status").agg(F.percentile("l", F.lit(0.95)).cast("int").alias("p95"), F.count(F.lit(1)).alias("n"))


@query("with f as (select doc_id, list_filter(['toxic', 'secret'], lambda k: contains(text, k)) t from documents) select count(*) filter (len(t) > 0) as hits, count(*) n from f")
def forbidden_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.sum((F.contains("text", F.lit("toxic")) | F.contains("text", F.lit("secret"))).cast("long")).alias("hits"), F.count(F.lit(1)).alias("n"))


@query("select l_returnflag as mode, count(*) n, count(*) filter (l_linestatus = 'O') as open_lines from lineitem group by 1")
def grouped_counts(spark, sf_dir):
    own = table(spark, sf_dir, "lineitem").withColumn("reasons", T.reasons(("open", F.col("l_linestatus") == "O")))
    return P.audit(own, "reasons", "l_returnflag").select(F.col("l_returnflag").alias("mode"), F.col("total").alias("n"), F.col("rejected").alias("open_lines"))
