"""Record builders and tool places over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import plug
from ..functions import text as T
from ..operators import records as R
from ..session import ship
from .base import query, table
from .records import CODES, codes


def _samples(spark, sf_dir):
    return codes(spark, sf_dir).withColumn("description", F.concat(F.lit(" a figure of "), "source", F.lit("\n")))


_HEAD, _TAIL = (x.replace("'", "''") for x in (R.PROMPT_HEAD, R.PROMPT_TAIL))


@query(f"with {CODES} select sample_id, sha256('{_HEAD}' || 'a figure of ' || source || chr(10) || chr(10) || '[GEOMETRY HINTS]' || chr(10) || 'mode: plain' || chr(10) || 'bounding_box: (0, ' || (sample_id % 5) || '.5) to (3, 4)' || chr(10) || '{_TAIL}') as prompt_hash from codes")
def rendered_prompts(spark, sf_dir):
    box = F.struct(F.lit(0.0).alias("min_x"), (F.col("sample_id") % 5 + 0.5).alias("min_y"), F.lit(3.0).alias("max_x"), F.lit(4.0).alias("max_y"))
    text = R.prompt(F.col("description"), F.lit("plain"), F.array().cast("array<string>"), box)
    return _samples(spark, sf_dir).select("sample_id", F.sha2(text, 256).alias("prompt_hash"))


@query()
def training_records(spark, sf_dir):
    ship(spark)
    return R.training_records(_samples(spark, sf_dir)).select("sample_id", "mode", R.of_role(F.col("messages"), "assistant", 1).alias("target"))


@query()
def contract_repair(spark, sf_dir):
    none = F.array().cast("array<string>")
    box = F.lit(None).cast("struct<min_x:double,min_y:double,max_x:double,max_y:double>")
    rows = _samples(spark, sf_dir).select("sample_id", F.col("description").alias("user"), F.col("code").alias("assistant"), F.lit("plain").alias("mode"), none.alias("libraries"), box.alias("box"))
    return R.repaired(rows).select("sample_id", "changed", F.array_join("before", ",").alias("before"), F.array_join("after", ",").alias("after"))


@query("select page_id, 'pages' as dataset_id, coalesce(nullif(case when page_id % 3 > 0 then url end, ''), page_id::varchar) as origin from pages")
def hydrated_metadata(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("sample_id"), F.when(F.col("page_id") % 3 > 0, F.col("url")).alias("uri"))
    return R.hydrated(pages, "pages", "train").select("page_id", "metadata.dataset_id", "metadata.origin")


@query("select page_id, case when page_id % 2 = 0 then 'paper ' || page_id when regexp_matches(url, '[/:]') then url end as owner from pages")
def source_keys(spark, sf_dir):
    given = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(" paper "), "page_id"))
    return table(spark, sf_dir, "pages").select("page_id", R.source_key(given, loose=F.col("url")).alias("owner"))


@query(f"with {CODES} select sample_id, 'tool_missing' as status from codes")
def compile_status(spark, sf_dir):
    return plug.compile_status(codes(spark, sf_dir).select("sample_id", "code"), "code", tool="no-such-compiler").select("sample_id", "status")


@query(f"with {CODES} select sample_id, case when sample_id % 4 > 0 then least(1.0, length(code) / 1000.0) else 0.0 end::double as sample_weight from codes")
def alignment_weights(spark, sf_dir):
    rows = codes(spark, sf_dir).select("sample_id", "code", (F.col("sample_id") % 4 > 0).alias("ok"))
    return plug.weighted(rows, "code", "ok", lambda texts: texts.str.len() / 1000.0).select("sample_id", "sample_weight")


@query("select item_id, item_id * 3 as iteration, 500 as total, (item_id % 7 + 0.5)::double as speed from benchmark")
def progress_log(spark, sf_dir):
    i = F.col("item_id")
    line = F.concat(F.lit("Iter "), i * 3, F.lit("/500: loss 1.2, "), (i % 7 + 0.5).cast("string"), F.lit(" it/s"))
    f = R.log_fields(line)
    return table(spark, sf_dir, "benchmark").select("item_id", f["iteration"].alias("iteration"), f["total"].cast("int").alias("total"), f["speed"].alias("speed"))


@query("select item_id, item_id * 100 as step, item_id % 9 as layer from benchmark")
def checkpoint_names(spark, sf_dir):
    name = F.concat(F.lit("run/"), F.lpad((F.col("item_id") * 100).cast("string"), 7, "0"), F.lit("_adapters.safetensors"))
    module = F.concat(F.lit("model.layers."), F.col("item_id") % 9, F.lit(".q_proj"))
    return table(spark, sf_dir, "benchmark").select("item_id", R.checkpoint_step(name).alias("step"), R.layer_of(module).alias("layer"))


@query("select item_id, format('{:016x}', list_sum(list_transform(range(64), lambda i: case when ((i // 8 * 9 + i % 8) * item_id) % 17 > ((i // 8 * 9 + i % 8 + 1) * item_id) % 17 then (1::ubigint << i::ubigint)::hugeint else 0::hugeint end))::ubigint) as hash from benchmark")
def image_hashes(spark, sf_dir):
    pixels = F.transform(F.sequence(F.lit(0), F.lit(71)), lambda i: (i * F.col("item_id")) % 17)
    return table(spark, sf_dir, "benchmark").select("item_id", plug.difference_hash(pixels).alias("hash"))


@query(f"with {CODES} select sample_id, len(regexp_extract_all(code, '\\\\[A-Za-z]+|[A-Za-z0-9_]+|[^\\t\\n\\x0B\\f\\r A-Za-z0-9_]'))::int as tokens from codes")
def token_counts(spark, sf_dir):
    return codes(spark, sf_dir).select("sample_id", plug.token_count(F.col("code")).alias("tokens"))


@query("select turns.conv_id, case when max(case when role = 'system' then 1 else 0 end) = 1 then 'system' else 'none' end as head, first(text order by turn) filter (role = 'user') as opening from conversations turns group by 1")
def first_messages(spark, sf_dir):
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    own = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("m"))
    return own.select("conv_id", F.when(R.first_text(F.col("m"), "system").isNotNull(), "system").otherwise("none").alias("head"), R.first_text(F.col("m"), "user").alias("opening"))


@query()
def candidate_codes(spark, sf_dir):
    kind = F.col("sample_id") % 3
    response = F.when(kind == 0, F.concat(F.lit("Here:\n```latex\n"), "code", F.lit("\n```"))).otherwise(F.concat(F.lit("I would draw "), "code"))
    return codes(spark, sf_dir).select("sample_id", R.candidate_code(response).alias("code"), T.primary_environment(F.col("code")).alias("environment"))
