"""Leakage, splits and indices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import leakage as L
from ..operators import splits as S
from .base import query, table

NORM = r"trim(regexp_replace(lower(regexp_replace(text, '(?m)(^|[^\\])%[^\n]*', '\1', 'g')), '[\t\n\x0B\f\r ]+', ' ', 'g'))"
TOKENS = rf"regexp_extract_all({NORM}, '\\[A-Za-z]+|[A-Za-z0-9_]+|[^\t\n\x0B\f\r A-Za-z0-9_]')"
GRAMS = f"""
t as (select 'd' k, doc_id id, {TOKENS} t from documents union all select 'b', item_id, {TOKENS} from benchmark),
g as (select k, id, unnest(list_distinct(list_transform(range(1, len(t) - 6), lambda i: array_to_string(list_slice(t, i, i + 7), ' ')))) s from t where len(t) >= 8),
nb as (select id, count(*) n from g where k = 'b' group by id),
pairs as (select b.id eval_id, d.id train_id, count(*) shared, any_value(nb.n) total from g d join g b on d.s = b.s and d.k = 'd' and b.k = 'b' join nb on nb.id = b.id group by 1, 2
  having count(*)::double / any_value(nb.n) > 0.5)"""
UNIT = "(('0x' || substr(sha1('17:' || {key}), 1, 16))::ubigint::double / 18446744073709551616.0)"
BUCKET = f"case when {UNIT} < 0.05 then 'gold' when {UNIT} < 0.15 then 'val' else 'train' end"
BY_ID = BUCKET.format(key="doc_id::varchar")
BY_SOURCE = BUCKET.format(key="source")


def _pairs(spark, sf_dir):
    return L.containment(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), train_key="doc_id", eval_key="item_id", text="text", n=8, over=0.5)


def _split(spark, sf_dir):
    return table(spark, sf_dir, "documents").withColumn("split", S.bucket(F.col("doc_id")))


@query(f"with {GRAMS} select * from pairs")
def decontaminate_ngram(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query(f"with {GRAMS}, r as (select *, row_number() over (partition by eval_id order by shared desc, train_id) r from pairs) select eval_id, train_id, shared, total from r where r = 1")
def best_contaminator(spark, sf_dir):
    return L.best_container(_pairs(spark, sf_dir))


@query(f"with {GRAMS} select doc_id, source from documents where doc_id not in (select train_id from pairs)")
def clean_training_set(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return L.without_contaminated(docs, _pairs(spark, sf_dir), "doc_id").select("doc_id", "source")


@query(f"with d as (select doc_id, {BY_ID} split, sha256({NORM}) h from documents) select doc_id from d where split = 'train' and h in (select h from d where split <> 'train')")
def exact_contamination(spark, sf_dir):
    docs = _split(spark, sf_dir)
    return L.exact_hits(docs.where("split = 'train'").select("doc_id", "text"), docs.where("split <> 'train'").select("doc_id", "text"), [L.text_hash(F.col("text"))]).select("doc_id")


@query("with r as (select *, row_number() over (partition by sha256(text) order by doc_id) r from documents) select doc_id, lang, source from r where r = 1")
def dedup_exact_first(spark, sf_dir):
    return L.first_wins(table(spark, sf_dir, "documents"), F.sha2("text", 256), "doc_id").select("doc_id", "lang", "source")


_STRIPPED = r"sha256(regexp_replace(text, '\A[\t\n\x0B\f\r ]+|[\t\n\x0B\f\r ]+\z', '', 'g'))"


@query(f"with d as (select doc_id, {_STRIPPED} h from documents), e as (select doc_id + 3 i, h from d where doc_id % 10 = 0) select doc_id train_id, case when doc_id in (select i from e) then 'id' else 'text' end reason from d where doc_id % 10 <> 0 and (doc_id in (select i from e) or h in (select h from e))")
def dedup_against_eval(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    evals = docs.where("doc_id % 10 = 0").select((F.col("doc_id") + 3).alias("i"), "text")
    return L.attributed_removals(docs.where("doc_id % 10 <> 0"), evals, train_id="doc_id", eval_id="i", text="text")


@query(f"with d as (select distinct {BY_ID} s, sha256({NORM}) h from documents) select a.h as key, a.s split_a, b.s split_b from d a join d b on a.h = b.h and a.s < b.s")
def cross_split_overlap(spark, sf_dir):
    return L.cross_split(_split(spark, sf_dir), "split", L.text_hash(F.col("text")))


@query("select source as key, count(*) n from documents group by 1 having count(*) > 1")
def split_disjointness(spark, sf_dir):
    return L.repeated_keys(table(spark, sf_dir, "documents"), "source")


@query(f"""with d as (select source as owner, {BY_ID} split, doc_id o from documents), r as (select *, case split when 'train' then 0 when 'val' then 1 else 2 end r from d),
f as (select *, first_value(split) over (partition by owner order by r, o, split) first_split from r) select owner, first_split, split, count(*) n from f where split <> first_split group by all""")
def source_owner_conflicts(spark, sf_dir):
    return L.owner_conflicts(_split(spark, sf_dir), "split", "source", "doc_id", {"train": 0, "val": 1, "gold": 2})


@query("""with d as (select doc_id % 4 as stage, source, sha256(text) h from documents), l as (select stage, 'source' kind, source as key from d union all select stage, 'text', h from d)
select kind, key, count(distinct stage) stages from l where key is not null group by 1, 2 having count(distinct stage) > 1""")
def stage_partition_overlap(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("stage", F.col("doc_id") % 4)
    return L.shared_between_stages(docs, "stage", {"source": F.col("source"), "text": F.sha2("text", 256)})


@query()
def safe_eval_greedy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("target"), F.concat_ws(" ", "source", F.col("doc_id").cast("string")).alias("source"))
    train = table(spark, sf_dir, "benchmark").select(F.col("text").alias("target"), F.lit(None).cast("string").alias("source"))
    return L.safe_selection(docs, train, texts={"target": (8, 0.5)}, source="source")


@query(f"select doc_id, source, {BY_SOURCE} as split from documents")
def hash_split_assign(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", S.bucket(S.split_key(F.col("source"), F.col("doc_id"))).alias("split"))


@query(f"select {BY_ID} as split, count(*) n, count(distinct source) as groups from documents group by 1")
def split_counts(spark, sf_dir):
    return _split(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("groups"))


@query(f"with d as (select doc_id, {BY_ID} split from documents) select doc_id, split, row_number() over (partition by split order by doc_id) - 1 as example_index from d")
def example_index(spark, sf_dir):
    return S.indexed(_split(spark, sf_dir).select("doc_id", "split"), "split", "doc_id")


@query("select lang as split, count(*) n, min(doc_id) = 0 and max(doc_id) = count(*) - 1 and count(distinct doc_id) = count(*) as contiguous from documents group by 1 union all select 'every', count(*), min(doc_id) = 0 and max(doc_id) = count(*) - 1 and count(distinct doc_id) = count(*) from documents")
def index_contiguity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("split"))
    return S.contiguity(docs.unionByName(docs.withColumn("split", F.lit("every"))), "split", "doc_id")


@query("with l as (select doc_id, max(quality) q, max(toxic) t from labels group by 1) select d.doc_id, l.q as quality, l.t as toxic, l.doc_id is not null as matched from documents d left join l using (doc_id)")
def paired_split(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("o", F.col("doc_id"))
    both = S.paired(table(spark, sf_dir, "documents").select("doc_id"), labels, "doc_id", "o")
    return both.select("doc_id", "pair.quality", "pair.toxic", "matched")


@query("with d as (select doc_id, substr(sha256(coalesce(source, '') || chr(10) || text), 1, 16) sample_id, sha256(text) content_hash from documents) select doc_id, sample_id, content_hash from d")
def stable_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", S.stable_id(F.coalesce("source", F.lit("")), F.col("text")).alias("sample_id"), F.sha2("text", 256).alias("content_hash"))


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")
def exclude_list(spark, sf_dir):
    gone = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return table(spark, sf_dir, "customer").join(gone, "c_custkey", "left_anti").select("c_custkey")


@query("with m as (select (doc_id * 7 + 3) % 50 as position, doc_id from documents where doc_id < 50) select position, m.doc_id, lang from m join documents d on d.doc_id = m.doc_id")
def manifest_materialise(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("doc_id").alias("o"))
    ids = docs.where("doc_id < 50").select(((F.col("doc_id") * 7 + 3) % 50).alias("position"), "doc_id")
    return S.manifest_rows(docs, ids, "doc_id", "o").drop("o")


@query("with r as (select * from (values (1), (2), (4)) r(rank)), s as (select * from (values ('warm'), ('cold')) s(start)) select rank::int as rank, start, rate from r cross join s cross join (values (0.1::double), (0.2::double)) t(rate)")
def config_grid(spark, sf_dir):
    return S.grid(spark, rank=[1, 2, 4], start=["warm", "cold"], rate=[0.1, 0.2])
