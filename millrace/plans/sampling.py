"""Samples, quotas, curricula and length profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import packing as K
from ..operators import profiles as P
from ..operators import splits as S
from .base import query, table

RANK = "row_number() over (partition by lang order by sha256('{seed}:' || doc_id), doc_id)"
COUNTED = "len(regexp_extract_all(text, '[^\\t\\n\\x0B\\f\\r ]+'))"


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")


def _lengths(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", "lang", F.size(T.words(F.col("text"))).alias("n"))


LENGTHS = f"l as (select doc_id, lang, {COUNTED}::int n from documents)"


@query(f"with r as (select doc_id, lang, {RANK.format(seed=7)} r from documents) select doc_id, lang from r where r <= case lang when 'en' then 100 when 'de' then 40 else r end")
def mode_capped(spark, sf_dir):
    return S.capped(_docs(spark, sf_dir), "lang", "doc_id", {"en": 100, "de": 40, "fr": None}, 7).select("doc_id", "lang")


@query(f"with r as (select doc_id, lang, {RANK.format(seed=3)} r from documents) select doc_id, lang from r where r <= case when lang in ('de', 'en') then 6 else 5 end")
def equal_mode_sample(spark, sf_dir):
    return S.equal_sample(_docs(spark, sf_dir), "lang", "doc_id", 22, 3).select("doc_id", "lang")


@query(f"with r as (select doc_id, lang, {RANK.format(seed=5)} r from documents) select doc_id, lang from r order by r, lang limit 30")
def round_robin_modes(spark, sf_dir):
    return S.round_robin(_docs(spark, sf_dir), "lang", "doc_id", 30, 5).select("doc_id", "lang")


@query(f"""with a as (select doc_id, lang, {RANK.format(seed=11)} r from documents), s1 as (select doc_id, lang from a where r <= 2),
b as (select doc_id, lang, row_number() over (partition by lang order by sha256('12:' || doc_id), doc_id) r from documents where doc_id not in (select doc_id from s1)), s2 as (select doc_id, lang from b where r <= 4)
select doc_id, lang, 'sentinel' as eval_set from s1 union all select doc_id, lang, 'ablation' from s2""")
def eval_sets_disjoint(spark, sf_dir):
    return S.disjoint_sets(_docs(spark, sf_dir).select("doc_id", "lang"), "lang", "doc_id", {"sentinel": 8, "ablation": 16}, 11)


@query("select doc_id from documents order by sha256('23:' || doc_id), doc_id limit 25")
def fixed_sample(spark, sf_dir):
    return S.fixed_sample(_docs(spark, sf_dir), "doc_id", "doc_id", 25, 23).select("doc_id")


@query("select row_number() over (order by sha256('20:' || event_id), event_id) - 1 as position, event_id from events")
def epoch_order(spark, sf_dir):
    return S.epoch_order(table(spark, sf_dir, "events"), "event_id", 17, 3)


@query("with n as (select count(*) c from documents) select doc_id from documents, n qualify row_number() over (order by doc_id) <= c - c % 16")
def whole_batches(spark, sf_dir):
    return S.whole_batches(_docs(spark, sf_dir), "doc_id", 16).select("doc_id")


@query(f"""with {LENGTHS}, a as (select *, row_number() over (order by n, doc_id) r, count(*) over () c from l where doc_id % 2 = 0), b as (select *, row_number() over (order by n, doc_id) r, count(*) over () c from l where doc_id % 2 = 1)
select doc_id, n from a where r > c // 2 union all select doc_id, n from b where r <= c // 2""")
def bridge_split(spark, sf_dir):
    own = _lengths(spark, sf_dir)
    return S.bridge(own.where("doc_id % 2 = 0"), own.where("doc_id % 2 = 1"), "n", "doc_id").select("doc_id", "n")


@query()
def stage_by_length(spark, sf_dir):
    own = _lengths(spark, sf_dir)
    centres = S.length_centres(own, "n", 3)
    return own.select("doc_id", "n", S.stage_of(F.col("n"), centres).alias("stage"))


@query("""with s as (select o_orderpriority p, count(*) n from orders group by 1), t as (select sum(n) total, count(*) k from s), e as (select p, n, (1000 - k) * (n::double / total) x, k, total from s, t),
f as (select *, floor(x) fl, row_number() over (order by x - floor(x) desc, p) r from e) select p as priority, (1 + fl + case when r <= 1000 - k - (select sum(fl) from f) then 1 else 0 end)::bigint as share from f""")
def apportion_iters(spark, sf_dir):
    rows = sorted((r[0], r[1]) for r in table(spark, sf_dir, "orders").groupBy("o_orderpriority").count().collect())
    shares = S.apportion([n for _, n in rows], 1000)
    return spark.createDataFrame([(p, s) for (p, _), s in zip(rows, shares, strict=True)], "priority string, share long")


@query(f"with {LENGTHS} select lang, count(n) n, round(avg(n), 6) mean, min(n) least, max(n) most, round(quantile_cont(n, 0.5), 6) p50, round(quantile_cont(n, 0.9), 6) p90, round(quantile_cont(n, 0.95), 6) p95, round(quantile_cont(n, 0.99), 6) p99 from l group by 1")
def token_length_profile(spark, sf_dir):
    return P.length_profile(_lengths(spark, sf_dir), "n", "lang")


@query(f"with {LENGTHS} select lang, quantile_disc(n, 0.99) as p99 from l group by 1")
def nearest_rank_p99(spark, sf_dir):
    return _lengths(spark, sf_dir).groupBy("lang").agg(P.nearest_rank("n", 0.99).cast("int").alias("p99"))


@query(f"with {LENGTHS} select " + ", ".join(f"round(avg((n >= {x})::int), 6) as ge_{x}" for x in (512, 768, 1024, 1280, 1536)) + " from l")
def length_ge_fractions(spark, sf_dir):
    return P.shares_from(_lengths(spark, sf_dir), "n")


@query("select term, count(*) n from (select unnest(regexp_extract_all(text, '[A-Za-z]{4,}')) term from documents) group by 1 order by 2 desc, 1 limit 50")
def top_terms(spark, sf_dir):
    return P.top_terms(table(spark, sf_dir, "documents"), "text", "[A-Za-z]{4,}")


@query(r"select sum(len(regexp_extract_all(text, '[0-9]{4,}')))::bigint as numbers, sum(len(regexp_extract_all(text, '(?i)licensed')))::bigint as licences, sum(len(regexp_extract_all(text, '\|')))::bigint as bars from documents")
def marker_totals(spark, sf_dir):
    return P.marker_totals(table(spark, sf_dir, "documents"), "text", {"numbers": "[0-9]{4,}", "licences": "(?i)licensed", "bars": r"\|"})


@query("with b as (select least(9, greatest(0, floor(l_discount * 10 * 8)::int)) b, count(*) n from lineitem group by 1) select r.range::int as bin, coalesce(n, 0) as n from range(10) r left join b on b.b = r.range")
def weight_histogram(spark, sf_dir):
    return P.histogram(table(spark, sf_dir, "lineitem").select((F.col("l_discount") * 10 * F.lit(0.8)).alias("w")), "w", 10)


@query("select count(*) n, round(avg(quality), 6) as ok_rate, round(avg(1.0 - toxic), 6) as mean_weight, count(*) filter (toxic < 1) as weighted from labels")
def scoring_summary(spark, sf_dir):
    return P.summary(table(spark, sf_dir, "labels").select((F.col("quality") == 1).alias("ok"), (F.lit(1.0) - F.col("toxic")).alias("w")), "ok", "w")


@query(f"""with {LENGTHS}, a as (select lang, count(*) as raw, quantile_cont(n, 0.99) p from l group by 1), b as (select lang, count(*) as clean, quantile_cont(n, 0.99) p from l where n > 300 group by 1)
select a.lang, raw, coalesce(clean, 0) as clean, round(coalesce(clean, 0)::double / raw, 6) as retention, case when coalesce(clean, 0)::double / raw < 0.2 then 'low_retention' || case when coalesce(b.p > 1.5 * a.p, false) then ',longer_p99' else '' end when coalesce(b.p > 1.5 * a.p, false) then 'longer_p99' else '' end as warnings from a left join b using (lang)""")
def audit_diff(spark, sf_dir):
    own = _lengths(spark, sf_dir)
    return P.audit_diff(own, own.where("n > 300"), "lang", "n")


_PACKED = f"""with recursive {LENGTHS}, l2 as (select row_number() over (order by doc_id) r, doc_id // {{span}} shard, doc_id ord, least(n, 2048) length from l),
p as (select r, shard, ord, length, 0::bigint pack, 0::bigint as "offset", length::bigint used from l2 where r = 1
union all select r, shard, ord, length, pack, "offset", "offset" + length from (select l2.r, l2.shard, l2.ord, l2.length,
  case when l2.shard <> p.shard then 0 when p.used > 0 and p.used + 1 + l2.length > 2048 then p.pack + 1 else p.pack end pack,
  case when l2.shard <> p.shard or p.used = 0 or p.used + 1 + l2.length > 2048 then 0 else p.used + 1 end "offset" from p join l2 on l2.r = p.r + 1))"""


@query(_PACKED.format(span=1_000_000) + ' select shard, ord, length::bigint as length, pack, "offset" from p')
def pack_assign(spark, sf_dir):
    lengths = _lengths(spark, sf_dir).select(F.col("doc_id").alias("ord"), F.col("n").alias("length"))
    return K.assign(lengths, 2048)


@query(_PACKED.format(span=250) + " select shard, count(*) as sequences, count(distinct pack) as packs, sum(length)::bigint as tokens from p group by 1")
def pack_audit(spark, sf_dir):
    lengths = _lengths(spark, sf_dir).select(F.col("doc_id").alias("ord"), F.col("n").alias("length"))
    places = K.assign(lengths, 2048, span=250)
    return places.groupBy("shard").agg(F.count(F.lit(1)).alias("sequences"), F.count_distinct("pack").alias("packs"), F.sum("length").alias("tokens"))


@query("select l_orderkey, l_linenumber, round(case when l_suppkey - 2 < 0 or l_quantity <= 1 then 0.0 else least(l_suppkey - 2, l_quantity - 1) / (l_quantity - 1) end, 6) as share from lineitem")
def mask_zero_fraction(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(K.zero_fraction(F.col("l_quantity"), F.col("l_suppkey") - 2), 6).alias("share"))


@query("""with o as (select l_orderkey, list(l_linenumber order by l_linenumber) t from lineitem group by 1) select l_orderkey, len(list_filter(range(1, len(t)), lambda i: t[i] = 2 and t[i + 1] = 3)) as hits,
least(64, 1 + 32 * ceil(len(t) / 32.0))::int as padded, list_sum(list_transform(range(1, len(t) + 1), lambda i: case when list_contains(t, 2) and i > list_position(t, 2) then 1 else 0 end))::bigint as unmasked from o""")
def boundaries_and_padding(spark, sf_dir):
    own = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("t"))
    ones = F.aggregate(K.mask(F.col("t"), 2), F.lit(0).cast("long"), lambda s, x: s + x)
    return own.select("l_orderkey", F.size(K.subsequence(F.col("t"), [2, 3])).cast("long").alias("hits"), F.size(K.padded(F.col("t"), 64)).alias("padded"), ones.alias("unmasked"))
