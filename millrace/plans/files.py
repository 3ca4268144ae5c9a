"""Ingest, digests, generated records, code repair and streams."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from ..functions import tex
from ..functions import text as T
from ..operators import leakage as L
from ..session import ship
from ..sources import files as Files
from ..streaming import windows as Win
from .base import query, table
from .records import CODES, codes


def _raw(spark, sf_dir):
    return codes(spark, sf_dir).select("ord", "source", F.when(F.col("ord") % 9 > 0, F.col("code")).alias("code"), F.when(F.col("ord") % 5 > 0, F.concat(F.lit("a figure of "), "source")).otherwise("  ").alias("description"))


_RAW = f"{CODES}, raw as (select ord, source, case when ord % 9 > 0 then code end as code, case when ord % 5 > 0 then 'a figure of ' || source else '  ' end as description from codes)"


@query(f"with {_RAW}, h as (select * from raw order by ord limit 100) select count(*) n, count(code) with_code, count(*) filter (trim(description) <> '') as with_description, count(code) filter (trim(description) <> '') as usable from h")
def ingest_readiness(spark, sf_dir):
    return Files.readiness(_raw(spark, sf_dir), 100, "ord")


@query(rf"""with {_RAW}, s as (select ord, source, regexp_replace(code, '\A[\t\n\x0B\f\r ]+|[\t\n\x0B\f\r ]+\z', '', 'g') as code, description from raw where code is not null and trim(description) <> ''),
k as (select * from s where length(code) between 100 and 4000 and not regexp_matches(code, '\\input\{{[^}}]+\}}|\\include\{{[^}}]+\}}|\\includegraphics(?:\[[^\]]*\])?\{{[^}}]+\}}')),
d as (select *, row_number() over (partition by sha256(code) order by ord) r from k)
select substr(sha256(source || chr(10) || code), 1, 16) as sample_id, ord, len(regexp_extract_all(code, '\\[A-Za-z]+|[A-Za-z0-9_]+|[^\t\n\x0B\f\r A-Za-z0-9_]'))::int as token_length from d where r = 1""")
def ingest(spark, sf_dir):
    return Files.ingest(_raw(spark, sf_dir)).select("sample_id", "ord", "token_length")


@query("select count(*) n, sum(doc_id)::bigint as ids, min(doc_id) as first, max(doc_id) as last, true as stable from documents")
def dataset_fingerprint(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    # The digest is Spark's own: what is compared is that it does not depend on the order of rows or on partitions.
    again = Files.row_fingerprint(docs.repartition(7, "source"), docs.columns).select(F.col("n").alias("m"), F.col("digest").alias("other"))
    sums = docs.agg(F.sum("doc_id").alias("ids"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    one = Files.row_fingerprint(docs, docs.columns)
    return one.join(again, one["n"] == again["m"]).join(F.broadcast(sums)).select("n", "ids", "first", "last", (F.col("digest") == F.col("other")).alias("stable"))


@query("with b as (select doc_id // 65536 b, sha256(string_agg(doc_id, chr(10) order by doc_id)) d from documents group by 1), c as (select b // 65536 c, sha256(string_agg(d, chr(10) order by b)) d from b group by 1) select sha256(string_agg(d, chr(10) order by c)) as digest from c")
def ordered_ids_digest(spark, sf_dir):
    return Files.ids_digest(table(spark, sf_dir, "documents"), "doc_id")


@query("select user_id, max(event_id) as last from (select * from events where event_id % 2 = 0 and user_id not in (select user_id from events where event_id % 2 = 1) union all select * from events where event_id % 2 = 1) group by 1")
def cache_upsert(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id")
    return Files.upsert(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "user_id").groupBy("user_id").agg(F.max("event_id").alias("last"))


@query("select doc_id, lang, n_chars from documents")
def jsonl_round_trip(spark, sf_dir):
    from ..sources.files import read_jsonl, write_jsonl

    root = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp()
    path = f"{root}/jsonl-{spark.sparkContext.applicationId}-{id(sf_dir)}-{spark._jvm.System.nanoTime()}"
    write_jsonl(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), path)
    return read_jsonl(spark, path, "doc_id long, lang string, n_chars long")


@query()
def normalize_target(spark, sf_dir):
    ship(spark)
    return codes(spark, sf_dir).select("sample_id", tex.series(tex.target)("code").alias("code"))


@query()
def clean_bodies(spark, sf_dir):
    ship(spark)
    return codes(spark, sf_dir).select("sample_id", tex.series(tex.clean_body)("code").alias("code"))


@query()
def grammar_aborts(spark, sf_dir):
    ship(spark)
    return codes(spark, sf_dir).select("sample_id", tex.series(tex.abort_reason)("code").alias("reason"))


@query()
def tikz_blocks(spark, sf_dir):
    ship(spark)

    class Blocks:
        def eval(self, text: str):
            yield from tex.blocks(text or "")

    made = F.udtf(Blocks, returnType="environment string, start int, end int, parent string")
    spark.udtf.register("millrace_blocks", made)
    codes(spark, sf_dir).createOrReplaceTempView("millrace_codes")
    return spark.sql("select sample_id, b.* from millrace_codes, lateral millrace_blocks(code) b")


@query(r"""with l as (select item_id, '! Undefined control ' || item_id % 3 || chr(10) || 'l.' || item_id || ' x' || chr(10) || 'File `a' || item_id % 2 || '.sty'' not found' || chr(10) || '! Undefined control ' || item_id % 3 as t from benchmark)
select item_id, array_to_string(list_transform(regexp_extract_all(t, '(?m)^! ([^\n]+)$', 1)[1:1], lambda x: trim(x)), '|') as errors, array_to_string(regexp_extract_all(t, 'l\.([0-9]+)', 1), '|') as lines, array_to_string(regexp_extract_all(t, 'File [`'']([^`'']+\.sty)[''`] not found', 1), '|') as packages from l""")
def compiler_log(spark, sf_dir):
    i = F.col("item_id")
    error = F.concat(F.lit("! Undefined control "), i % 3)
    log = F.concat(error, F.lit("\nl."), i, F.lit(" x\nFile `a"), i % 2, F.lit(".sty' not found\n"), error)
    found = lambda pattern: F.array_join(F.array_distinct(F.transform(F.regexp_extract_all(log, F.lit(pattern), F.lit(1)), T.strip)), "|")
    return table(spark, sf_dir, "benchmark").select("item_id", found(r"(?md)^! (.+)$").alias("errors"), found(r"l\.([0-9]+)").alias("lines"), found(r"File [`']([^`']+\.sty)['`] not found").alias("packages"))


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("select event_type, min(event_id) as event_id from events group by 1")
def stream_dedup(spark, sf_dir):
    return L.first_wins(_events(spark, sf_dir), F.col("event_type"), "event_id").select("event_type", "event_id")


@query("select time_bucket(interval 1 hour, ts) as start, event_type, count(*) n, round(sum(value), 6) as total from events group by 1, 2")
def tumbling_counts(spark, sf_dir):
    return Win.counted(_events(spark, sf_dir), "ts", "1 hour", by="event_type", value="value").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("select s as start, count(*) n from (select unnest([time_bucket(interval 30 minute, ts), time_bucket(interval 30 minute, ts) - interval 30 minute]) s from events) group by 1")
def sliding_counts(spark, sf_dir):
    return Win.counted(_events(spark, sf_dir), "ts", "1 hour", "30 minutes").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minute then 0 else 1 end b from events), s as (select *, sum(b) over (partition by user_id order by ts rows unbounded preceding) i from g)
select user_id, min(ts) as start, max(ts) + interval 30 minute as end, count(*) n from s group by user_id, i""")
def session_counts(spark, sf_dir):
    own = Win.sessions(_events(spark, sf_dir), "ts", "30 minutes", "user_id")
    return own.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("select user_id, event_id // 100 as slot, count(*) n, round(avg(value), 6) as mean from events group by 1, 2")
def step_windows(spark, sf_dir):
    return Win.step_windows(table(spark, sf_dir, "events"), "user_id", "event_id", 100, "value")
