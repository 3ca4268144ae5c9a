"""Sinks that are written and read back, and single expressions that had no query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import packing as K
from ..operators import records as R
from ..operators import similarity as V
from ..operators import splits as S
from ..sources import files as Files
from .base import query, table
from .checks import _folders
from .records import CODES, codes


def _reasons():
    return T.reasons(("short", F.col("n_chars") < 200), ("foreign", F.col("lang") != "en"))


@query("select doc_id, lang as split from documents")
def split_folders(spark, sf_dir):
    folder, _ = _folders(spark)
    Files.write_splits(table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("split")), folder)
    return spark.read.schema("doc_id long, split string").json(folder)


@query("select doc_id, not (n_chars < 200 or lang <> 'en') as kept from documents")
def kept_and_rejected(spark, sf_dir):
    kept, rejected = _folders(spark)
    Files.write_kept_and_rejected(table(spark, sf_dir, "documents").select("doc_id", _reasons().alias("reasons")), "reasons", kept, rejected)
    read = lambda path: spark.read.schema("doc_id long").json(path)
    return read(kept).withColumn("kept", F.lit(True)).union(read(rejected).withColumn("kept", F.lit(False)))


@query("select event_type, count(*) n from events group by 1")
def append_sink(spark, sf_dir):
    folder, _ = _folders(spark)
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    for part in (0, 1):
        Files.write_jsonl(events.where(F.col("event_id") % 2 == part), folder, mode="append")
    return Files.read_jsonl(spark, folder, "event_id long, event_type string").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("select doc_id, source from documents where lang in ('en', 'fr')")
def allowed_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("own"), F.col("lang").alias("source"))
    return Files.allowed(docs, ["en", "fr"]).select("doc_id", F.col("own").alias("source"))


@query(r"select doc_id from documents where regexp_matches(text, '[.!?][\t\n\x0B\f\r ]*\z')")
def complete_texts(spark, sf_dir):
    return Files.complete(table(spark, sf_dir, "documents"), ~F.col("text").rlike(r"[.!?][\t\n\x0B\f\r ]*\z")).select("doc_id")


@query("""with v as (select l_orderkey, l_linenumber, 0.75 * (l_discount::double * 10) + 0.25 * (l_tax::double * 10) as t, case when l_linenumber <> 3 then l_quantity::double / 50 end as s from lineitem)
select l_orderkey, l_linenumber, round(t, 6) as text, t >= 0.8 and coalesce(s, 0) >= 0.75 as passed from v""")
def hybrid_scores(spark, sf_dir):
    visual = F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("double") / 50)
    scored = V.hybrid(F.col("l_discount").cast("double") * 10, F.col("l_tax").cast("double") * 10, visual)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", scored.alias("h")).select("l_orderkey", "l_linenumber", F.round("h.text", 6).alias("text"), "h.passed")


@query(rf"""with {CODES}, t as (select unnest(regexp_extract_all(code, '\\[A-Za-z]+|[A-Za-z0-9_]+|[^\t\n\x0B\f\r A-Za-z0-9_]')) token from codes)
select token, count(*) n, case when regexp_full_match(token, '[{{}}\[\];,\\]+') then 5.0 when regexp_full_match(token, '\\[A-Za-z@]+') then 2.0 else 1.0 end::double as weight from t group by 1""")
def token_weights(spark, sf_dir):
    own = codes(spark, sf_dir).select(F.explode(T.tokens(F.col("code"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return own.select("token", "n", K.token_weight(F.col("token")).alias("weight"))


@query(f"with {CODES} select sample_id, 'a figure of ' || source as words from codes")
def bare_prompts(spark, sf_dir):
    code = F.col("code")
    made = R.prompt(F.concat(F.lit("  a figure of "), "source", F.lit("\n")), T.generation_mode(code), T.libraries(code), T.bounding_box(code))
    return codes(spark, sf_dir).select("sample_id", R.bare_prompt(made).alias("words"))


@query(f"""with {CODES} select sample_id, case when sample_id % 3 = 0 then ' ' || source || ' ' when sample_id % 3 = 1 then code else 'x' end as target,
case when sample_id % 4 > 0 then 'a caption ' || source else 'a figure of ' || source end as description from codes""")
def record_texts(spark, sf_dir):
    key, code = F.col("sample_id"), F.col("code")
    blank = F.when(key % 2 == 0, F.lit(" \n"))
    named = F.when(key % 3 == 0, F.concat(F.lit(" "), "source", F.lit(" "))).otherwise(blank)
    made = R.prompt(F.concat(F.lit("a figure of "), "source"), T.generation_mode(code), T.libraries(code), T.bounding_box(code))
    caption = F.when(key % 4 > 0, F.concat(F.lit("  a caption "), "source", F.lit(" "))).otherwise(F.lit("\t"))
    target = R.preferred(named, F.when(key % 3 == 1, code), otherwise=F.lit("x"))
    return codes(spark, sf_dir).select("sample_id", target.alias("target"), R.described(blank, caption, prompt_text=made).alias("description"))


@query(rf"""with {CODES}, p as (select sample_id, 'Draw ' || source || chr(10) as head, regexp_replace(code, '\A[\t\n\x0B\f\r ]+|[\t\n\x0B\f\r ]+\z', '', 'g') as body from codes)
select sample_id, sha256(regexp_replace(head, '[\t\n\x0B\f\r ]+\z', '') || chr(10) || body || chr(10)) as document_hash from p""")
def evaluated_documents(spark, sf_dir):
    made = F.concat(F.lit("Draw "), "source", F.lit("\n```latex\nignored ```latex"))
    return codes(spark, sf_dir).select("sample_id", F.sha2(R.evaluated(made, F.concat("code", F.lit("\n"))), 256).alias("document_hash"))


@query("""with d as (select doc_id, lang, row_number() over (partition by lang order by sha256('9:' || doc_id), doc_id) r from documents), c as (select lang, count(*) n, row_number() over (order by lang) i, count(*) over () k from documents group by 1)
select doc_id, lang, r <= 40 // k + (i <= 40 % k)::int as probe from d join c using (lang)""")
def probe_split(spark, sf_dir):
    return S.probe_split(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 40, 9, keep=5)


@query("with m as (select (doc_id * 7 + 3) % 50 as position, doc_id * 3 as doc_id from documents where doc_id < 50) select position, m.doc_id, lang from m join documents d on d.doc_id = m.doc_id order by position limit 20")
def manifest_head(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("doc_id").alias("o"))
    ids = docs.where("doc_id < 50").select(((F.col("doc_id") * 7 + 3) % 50).alias("position"), (F.col("doc_id") * 3).alias("doc_id"))
    return S.manifest_rows(docs, ids, "doc_id", "o", first=True, most=20).drop("o")
