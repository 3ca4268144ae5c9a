"""Checks, plans, package rules, generated records and streams that run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from ..functions import packages as K
from ..functions import text as T
from ..operators import checks as C
from ..operators import generate as G
from ..operators import leakage as L
from ..streaming import windows as Win
from .base import query, table
from .leaks import GRAMS, NORM
from .records import CODES, codes
from .texts import _list, roles

_WORDS = r"regexp_extract_all(text, '[^\t\n\x0B\f\r ]+')"


@query("select doc_id, n_chars from documents where doc_id % 7 <> 0 and n_chars >= 500")
def length_floor(spark, sf_dir):
    length = F.when(F.col("doc_id") % 7 == 0, "none").otherwise(F.col("n_chars").cast("string"))
    return C.length_floor(table(spark, sf_dir, "documents"), length, 500).select("doc_id", "n_chars")


@query(f"""with w as (select doc_id, {_WORDS} t from documents), g as (select doc_id, unnest(list_transform(range(1, len(t) - 2), lambda i: list_slice(t, i, i + 3))) g from w where len(t) >= 40),
c as (select doc_id, max(n) m from (select doc_id, g, count(*) n from g group by 1, 2) group by 1)
select doc_id, array_to_string(list_filter([case when len(t) > 1000 then 'over_length' end, case when m * 4 / len(t) > 0.2 then 'repetitive' end], lambda x: x is not null), ',') as reasons from w left join c using (doc_id)""")
def pretokenize_skips(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(C.skip_reasons(T.words(F.col("text")), 1000), ",").alias("reasons"))


@query("select conv_id, turn from conversations where not contains(text, '\\documentclass')")
def refused_tokens(spark, sf_dir):
    own = table(spark, sf_dir, "conversations")
    return C.refuse(own, F.contains("text", F.lit("\\documentclass")), "a forbidden token is in a turn").select("conv_id", "turn")


_ODD = [("short", "n_chars < 200"), ("foreign", "lang <> 'en'"), ("barred", "contains(text, '|')")]


def _marked(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.reasons(*((name, F.expr(held)) for name, held in _ODD)).alias("reasons"))


@query("with r as (select unnest(list_concat(['rows'], case when n_chars < 200 or lang <> 'en' or contains(text, '|') then list_filter([" + ", ".join(f"case when {held} then '{name}' end" for name, held in _ODD) + "], lambda x: x is not null) else ['passed'] end)) reason from documents) select reason, count(*) n from r group by 1")
def contract_audit(spark, sf_dir):
    return C.reason_totals(_marked(spark, sf_dir), "reasons")


@query("with h as (select * from documents order by doc_id limit 150) select doc_id, " + _list(*_ODD) + " as reasons from h where reasons <> '' order by doc_id limit 50")
def contract_failures(spark, sf_dir):
    return C.first_failures(_marked(spark, sf_dir), "reasons", "doc_id", 150).select("doc_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"""with {GRAMS}, h as (select 'd' k, sha256({NORM}) h from documents union all select 'b', sha256({NORM}) from benchmark),
v as (select 'repeated_id' kind, count(*) n from (select doc_id from documents group by 1 having count(*) > 1) union all select 'shared_id', count(*) from (select doc_id from documents intersect select item_id from benchmark)
union all select 'shared_text', count(*) from (select h from h group by 1 having count(distinct k) > 1) union all select 'ngram_leak', count(*) from pairs)
select kind, n::bigint as n from v union all select 'pass', (sum(n) = 0)::bigint from v""")
def split_verdict(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    both = docs.withColumn("split", F.lit("train")).unionByName(bench.withColumn("split", F.lit("benchmark")))
    return C.verdict({
        "repeated_id": L.repeated_keys(docs, "id"), "shared_id": L.cross_split(both, "split", F.col("id")), "shared_text": L.cross_split(both, "split", L.text_hash(F.col("text"))),
        "ngram_leak": L.containment(docs, bench, train_key="id", eval_key="id", text="text", n=8, over=0.5),
    })


@query("select lang as split, count(*) n, min(doc_id) as first, max(doc_id) as last, bit_xor(('0x' || substr(sha256(doc_id::varchar), 1, 15))::bigint) as digest from documents group by 1")
def split_manifest(spark, sf_dir):
    return C.manifest(table(spark, sf_dir, "documents").withColumnRenamed("lang", "split"), "split", "doc_id")


@query("""with s as (select lang as stage, count(*) n from documents group by 1), c as (select *, case stage when 'en' then n when 'de' then n - 1 end cached, case stage when 'fr' then 0 else 1 end batch from s)
select stage, array_to_string(list_filter([case when batch <> 1 then 'batch_size' end, case when stage = 'de' and n % 8 <> 0 then 'iterations' end, case when cached is null then 'cache_missing' end, case when cached <> n then 'cache_length' end, case when stage = 'en' then 'cache_tokens' end], lambda x: x is not null), ',') as failures from c""")
def prelaunch_audit(spark, sf_dir):
    stage, n = F.col("lang"), F.col("n")
    own = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    stages = own.select(
        stage.alias("stage"), n.alias("rows"), F.when(stage == "en", n).when(stage == "de", n - 1).alias("cached"), F.when(stage == "fr", 0).otherwise(1).alias("batch_size"), F.lit(8).alias("accumulation"),
        F.when(stage == "de", n).otherwise(F.ceil(n / 8) * 8).alias("iterations"), F.lit(1024).alias("most_tokens"), F.when(stage == "en", 512).alias("cached_tokens"), F.lit("x").alias("digest"), F.lit(None).cast("string").alias("cached_digest"),
    )
    return C.prelaunch_failures(stages).select("stage", F.array_join("failures", ",").alias("failures"))


@query("select c_custkey, c_acctbal > 0 and c_custkey in (select o_custkey from orders where o_orderstatus = 'F') as resumable from customer")
def resume_check(spark, sf_dir):
    archive = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return C.resumable(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), archive, "c_custkey", F.col("c_acctbal") > 0).select("c_custkey", "resumable")


@query("with h as (select * from orders order by o_orderkey limit 500) select count(*) attempted, count(*) filter (o_orderstatus = 'F') as successful, round(avg((o_orderstatus = 'F')::int), 6) as rate from h where o_orderkey % 5 > 0")
def compile_rate_floor(spark, sf_dir):
    code = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderpriority"))
    return C.success_rate(table(spark, sf_dir, "orders"), code, F.col("o_orderstatus") == "F", "o_orderkey", 500)


@query("select lang, greatest(512, least(1536, ceil(floor(quantile_cont(n_chars / 4, 0.95)) / 128) * 128))::int as context, (ceil(ceil(count(*) * 1.5 / 4) / 8) * 8)::bigint as iterations from documents group by 1")
def training_plan(spark, sf_dir):
    own = table(spark, sf_dir, "documents").groupBy("lang").agg(F.percentile(F.col("n_chars") / 4, F.lit(0.95)).alias("p95"), F.count(F.lit(1)).alias("n"))
    return own.select("lang", C.context_size(F.col("p95")).alias("context"), C.iterations(F.col("n"), 1.5, 4, 8).alias("iterations"))


@query("select event_id, round(case when event_id % 8 <= 0 then case when event_id % 5 > 0 then 0.2 end else least(0.9, coalesce(case when event_id % 5 > 0 then 0.2 end, 0) + event_id % 8 * 0.15) end, 6)::double as temperature from events")
def adaptive_temperature(spark, sf_dir):
    base = F.when(F.col("event_id") % 5 > 0, 0.2)
    return table(spark, sf_dir, "events").select("event_id", F.round(C.raised_temperature(base, F.col("event_id") % 8), 6).alias("temperature"))


@query("""with s as (select user_id, count(*) reports, arg_min(value, event_id) as first, arg_max(value, event_id) as last, floor(max(event_id) / 8)::bigint updates from events group by 1)
select user_id, reports, first, last, round(first - last, 6) as "drop", updates, updates >= 100 and first - last < 0.5 as warning from s""")
def learning_summary(spark, sf_dir):
    return C.learning_summary(table(spark, sf_dir, "events"), "user_id", "event_id", "value", 8, 100, 0.5)


@query("select l_orderkey, l_linenumber, " + _list(("invisible", "l_quantity - 3 < 5 or l_linenumber * 12 < 5"), ("too_small", "l_quantity - 3 < 32 or l_linenumber * 12 < 32"), ("blank", "l_discount / 50 < 0.001")) + " as reasons from lineitem")
def render_checks(spark, sf_dir):
    found = C.render_reasons(F.col("l_quantity") - 3, F.col("l_linenumber") * 12, F.col("l_discount") / 50)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(found, ",").alias("reasons"))


@query(f"""with {CODES}, m as (select sample_id % 4 as mode, code, sample_id from codes), k as (select * from m where mode = 1 or sample_id % 50 = 0), n as (select (select count(*) from k)::double c, (select count(*) from m where mode > 1)::double p, (select count(*) from m)::double r),
s as (select mode, count(*) filter (k) c, count(*) filter (p) p from (select mode, true k, false p from k union all select mode, false, true from m where mode > 1) group by 1)
select 'one_mode' as warning, mode::varchar as subject from s, n where s.c > 0.95 * n.c union all select 'probe_skew', mode::varchar from s, n where s.p > 0 and abs(s.p / n.p - s.c / n.c) > 0.3
union all select 'marker', 'usepackage' where (select count(*) from k where contains(code, '\\usepackage')) > 0 union all select 'retention', 'rows' from n where n.c < 0.2 * n.r""")
def audit_warnings(spark, sf_dir):
    own = codes(spark, sf_dir).withColumn("mode", (F.col("sample_id") % 4).cast("string"))
    kept = own.where("mode = '1' or sample_id % 50 = 0")
    return C.audit_warnings(own, kept, own.where("mode > '1'"), "mode", "code", {"usepackage": r"\\usepackage", "geometric": r"0\.geometric"})


@query("""select n_nationkey, sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}') as digest from nation""")
def stable_json_hash(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", C.stable_json("n_regionkey", "n_nationkey", "n_name").alias("digest"))


@query(rf"""with {CODES}, c as (select sample_id, code, not contains(code, '```') and contains(code, '>=stealth') as ok, contains(code, '>=stealth') as mendable, sample_id % 10 = 0 as cached from codes)
select sample_id, case when code in (select code from c where cached) then 'cached' when ok then 'ok' when mendable then 'repaired' else 'failed' end as outcome from c""")
def compile_repair(spark, sf_dir):
    own = codes(spark, sf_dir).select("sample_id", "code")
    cache = own.where("sample_id % 10 = 0").select(F.sha2("code", 256).alias("content_hash"), F.col("code").alias("final"))
    # In a compiler's place: no fence, and a certain option.
    compiles = ~F.contains("code", F.lit("```")) & F.contains("code", F.lit(">=stealth"))
    return C.compile_and_repair(own, "code", compiles, F.replace("code", F.lit("```"), F.lit("")), cache).select("sample_id", "outcome")


def _fits(rules):
    return "list_filter([" + ", ".join("case when regexp_matches(code, '" + pattern.replace("'", "''") + f"') then '{name}' end" for pattern, name in rules) + "], lambda x: x is not null)"


_SPLIT = r"list_filter(list_transform(string_split(array_to_string(regexp_extract_all(code, '{}', 1), ','), ','), lambda x: trim(x)), lambda x: x <> '')"
_LIBRARIES = f"list_sort(list_distinct(list_concat({_SPLIT.format(chr(92) * 2 + 'usetikzlibrary' + chr(92) + '{([^}]+)' + chr(92) + '}')}, {_fits(K.LIBRARY_RULES)})))"
_NAMED = _SPLIT.format(chr(92) * 2 + "usepackage(?:" + chr(92) + "[[^" + chr(92) + "]]+" + chr(92) + "])?" + chr(92) + "{([^}]+)" + chr(92) + "}")


@query(f"with {CODES} select sample_id, array_to_string({_LIBRARIES}, ',') as libraries, " + _list(*((name, f"regexp_matches(code, '{pattern}')") for name, pattern in K.DIALECTS)) + " as dialects from codes")
def required_libraries(spark, sf_dir):
    return codes(spark, sf_dir).select("sample_id", F.array_join(K.required_libraries(F.col("code")), ",").alias("libraries"), F.array_join(K.dialect_flags(F.col("code")), ",").alias("dialects"))


@query(f"""with {CODES}, p as (select sample_id, {_LIBRARIES} l, list_concat([{", ".join(f"'{x}'" for x in K.ALWAYS)}], list_concat(list_transform({_NAMED}, lambda x: '\\usepackage{{' || x || '}}'), {_fits(K.PACKAGE_RULES)})) p from codes),
b as (select sample_id, list_sort(list_distinct(list_concat(list_concat(p, case when len(l) > 0 then ['\\usetikzlibrary{{' || array_to_string(l, ', ') || '}}'] else [] end), list_concat([], {", ".join("case when list_contains(p, '" + package + "') then [" + ", ".join(f"'{x}'" for x in lines) + "] else [] end" for package, lines in K.BROUGHT.items())})))) a from p)
select sample_id, array_to_string(list_concat(['{K.ALWAYS[0]}'], list_concat(list_filter(a, lambda x: starts_with(x, '\\usepackage') and x <> '{K.ALWAYS[0]}'), list_filter(a, lambda x: not starts_with(x, '\\usepackage')))), chr(10)) as preamble from b""")
def required_packages(spark, sf_dir):
    return codes(spark, sf_dir).select("sample_id", F.array_join(K.required_packages(F.col("code")), "\n").alias("preamble"))


def _plain(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _generated(families) -> str:
    out, before = [], 0
    for name in families:
        rows, values, description, body = G.FAMILIES[name]
        made = (G.template_sql(t, values, quote=_plain) for t in (description, G.code_of(body)))
        out.append("select {0} + i as ord, '{1}' as category, sha256({2}) as description_hash, sha256({3}) as code_hash from (select range i from range({4}))".format(before, name, *made, rows))
        before += rows
    return " union all ".join(out)


@query(_generated(G.PRIMITIVES))
def primitive_candidates(spark, sf_dir):
    return G.candidates(spark).select("ord", "category", F.sha2("description", 256).alias("description_hash"), F.sha2("code", 256).alias("code_hash"))


@query(_generated(["mixed_composition"]))
def mixed_scenes(spark, sf_dir):
    return G.candidates(spark, ("mixed_composition",)).select("ord", "category", F.sha2("description", 256).alias("description_hash"), F.sha2("code", 256).alias("code_hash"))


@query("select * from (values ('synthetic_repetition_000', sha256(array_to_string(list_transform(range(12), lambda i: '    >=stealth,'), chr(10)))), ('synthetic_repetition_001', sha256(array_to_string(list_transform(range(6), lambda i: '\\draw (0,0) -- (1,1);'), chr(10)))), ('synthetic_repetition_002', sha256(array_to_string(list_transform(range(24), lambda i: '\\node at (0,0) {x};'), chr(10))))) t(sample_id, text_hash)")
def repetition_seeds(spark, sf_dir):
    return G.repetition_seeds(spark).select("sample_id", F.sha2("text", 256).alias("text_hash"))


@query("""with t as (select * from (values (0, 'bracket', 'A box.', 'x (0,0) y (0,0)', 2), (1, 'loop', 'A loop.', '(1,1)', 8), (2, 'fence', 'A fence.', '(0,0)', 1)) t(place, pattern, description, code, w)),
k as (select *, row_number() over (order by place, c) - 1 k, count(*) over () n from t, range(8) r(c) where c < w), r as (select i, pattern, description, code, i // n v from (select range i from range(400)), k where i % n = k)
select i, pattern, description || case when v > 0 then ' Use a compact layout variant ' || v || '.' else '' end as description, case when v > 0 and contains(code, '(0,0)') then substr(code, 1, strpos(code, '(0,0)') - 1) || case when v % 5 = 0 then '(0,0)' else '(0,0.' || v % 5 || ')' end || substr(code, strpos(code, '(0,0)') + 5) else code end as code from r""")
def repair_candidates(spark, sf_dir):
    rows = [(0, "bracket", "A box.", "x (0,0) y (0,0)"), (1, "loop", "A loop.", "(1,1)"), (2, "fence", "A fence.", "(0,0)")]
    weights = spark.createDataFrame([("bracket", 2), ("loop", 90), ("other", 3)], "pattern string, weight int")
    return G.repairs(spark.createDataFrame(rows, "place int, pattern string, description string, code string"), weights, 400)


@query(f"with c as ({_generated(G.PRIMITIVES)}) select ord, category from c where ord % 3 <> 1 order by ord limit 500")
def gated_dataset(spark, sf_dir):
    return G.gated(G.candidates(spark), F.col("ord") % 3 != 1, "ord", 500).select("ord", "category")


def _folders(spark) -> tuple[str, str]:
    root = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp()
    own = f"{root}/stream-{uuid.uuid4().hex}"
    return f"{own}/rows", f"{own}/state"


def _stream(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path + "*")


@query("select distinct user_id, event_type from events")
def stream_append(spark, sf_dir):
    return Win.appended(_stream(spark, sf_dir).select("user_id", "event_type"), ["user_id", "event_type"], *_folders(spark))


@query("select user_id, count(*) n, round(sum(value), 6) as total from events group by 1")
def stream_telemetry(spark, sf_dir):
    return Win.tallied(_stream(spark, sf_dir).select("user_id", "value"), ["user_id"], "value", *_folders(spark))


@query("with b as (select user_id, event_id as done from events union all select user_id, 7 from events), m as (select user_id, max(done) done from b group by 1) select user_id, done, (done // 70)::bigint as epoch, done % 70 as cursor from m")
def cursor_resync(spark, sf_dir):
    marks = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("done"))
    return Win.resynced(marks, marks.select("user_id").distinct().withColumn("done", F.lit(7)), "user_id", 70)
