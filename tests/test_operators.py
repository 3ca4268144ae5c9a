"""Leakage, splits, samples, packing, metrics, similarity, files and streams on small tables."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import catalog
from millrace.functions import text as T
from millrace.operators import leakage, metrics, packing, profiles, similarity, splits
from millrace.sources import files
from millrace.streaming import windows


def test_split_is_a_function_of_the_key(spark):
    rows = spark.range(500).select(splits.bucket(F.concat(F.lit("k"), "id")).alias("b"), "id").collect()
    for r in rows:
        x = int.from_bytes(hashlib.sha1(f"17:k{r.id}".encode()).digest()[:8], "big") / 2**64
        assert r.b == ("gold" if x < 0.05 else "val" if x < 0.15 else "train")


def test_containment(spark):
    base = " ".join(f"w{i}" for i in range(30))
    train = spark.createDataFrame([(1, base + " tail"), (2, "other words " * 9), (3, None)], "id long, text string")
    evals = spark.createDataFrame([(7, base), (8, "nothing like it at all in here, really now"), (9, "short")], "id long, text string")
    pairs = leakage.containment(train, evals, train_key="id", eval_key="id", text="text", n=8, over=0.5)
    assert [tuple(r) for r in pairs.collect()] == [(7, 1, 23, 23)]
    assert {r.id for r in leakage.without_contaminated(train, pairs, "id").collect()} == {2, 3}


def test_cross_split_and_owners(spark):
    df = spark.createDataFrame([("train", "a", "s1", 1), ("val", "a", "s1", 2), ("gold", "b", "s2", 3), ("train", "c", "s3", 4), ("train", "c", "s3", 5)], "split string, key string, owner string, ord long")
    assert [tuple(r) for r in leakage.cross_split(df, "split", F.col("key")).collect()] == [("a", "train", "val")]
    assert [tuple(r) for r in leakage.owner_conflicts(df, "split", "owner", "ord", {"train": 0, "val": 1, "gold": 2}).collect()] == [("s1", "train", "val", 1)]
    assert {tuple(r) for r in leakage.repeated_keys(df, "key").collect()} == {("a", 2), ("c", 2)}


def test_safe_selection(spark):
    """In order, as one would by hand, with equal texts, passages that many share, and a training side."""
    r = random.Random(1)
    passages = [[f"w{r.randrange(60)}" for _ in range(r.randint(3, 14))] for _ in range(12)]
    text = lambda: " ".join(w for _ in range(r.randint(0, 3)) for w in r.choice(passages))
    rows = [(i, r.choice([text(), text().upper(), "", None, "w1 w2"]), text(), r.choice(["a", "b", None, f"s{i}", f"s{i}", f"s{i // 2}"])) for i in range(120)]
    rows += [(200 + i, *rows[i][1:3], f"t{i}") for i in range(40)]
    train = [(text(), "", "s7"), (rows[3][1], text(), None), (None, None, None)]
    grams = lambda t, n: {tuple(w[i : i + n]) for w in [(t or "").lower().split()] for i in range(len(w) - n + 1)}
    norm = lambda t: " ".join((t or "").lower().split())
    sizes, taken, used = {0: (3, 0.4), 1: (2, 0.6)}, [], [(t, p, s) for t, p, s in train]
    for i, *own in rows:
        clash = any(own[2] is not None and own[2] == u[2] for u in used)
        for k, (n, over) in sizes.items():
            g = grams(own[k], n)
            clash |= any((norm(own[k]) and norm(own[k]) == norm(u[k])) or (g and len(g & grams(u[k], n)) > over * len(g)) for u in used)
        if not clash:
            taken.append(i)
            used.append(tuple(own))
    names = "target string, prompt string, source string"
    got = leakage.safe_selection(spark.createDataFrame(rows, "id long, " + names), spark.createDataFrame(train, names), texts={"target": (3, 0.4), "prompt": (2, 0.6)}, source="source")
    assert sorted(x.id for x in got.collect()) == taken and 20 < len(taken) < 110
    none = spark.createDataFrame([], "id long, " + names)
    assert leakage.safe_selection(none, none, texts={"target": (3, 0.4)}).count() == 0


def test_safe_selection_reads_texts_once(spark):
    """What is decided comes from stored hashes: no plan goes back to the texts."""
    df = catalog.QUERIES["safe_eval_greedy"](spark, "/root/testdata/sf0.001")
    assert "text:string" not in df._jdf.queryExecution().executedPlan().toString() and 0 < df.count() < 200
    odd = ["a % gone\nb", "100\\% kept % gone", "%", "", " \t\x0b A\u00a0B \n", "\\alpha_1{x}\u00c9 \r\n%%\n\n  Z", "x" * 5000, "\u0130 \u03a3\u03a3 % \u03a3"]
    native = spark.createDataFrame(list(enumerate(odd)), "i long, t string").select("i", T.normalised(F.col("t")).alias("n"), T.tokens(T.normalised(F.col("t"))).alias("w"))
    for r in native.collect():
        assert leakage._normal(odd[r.i]) == r.n and leakage._TOKEN.findall(r.n) == r.w
    texts = ["a b c d", "b c d a b c d", "a b", "", "x a b c d x"]
    a, b, short, empty, c = leakage._Grams(3)(texts)
    assert [len(g) for g in (a, b, short, empty, c)] == [2, 4, 0, 0, 4] and np.isin(a, b).all() and np.isin(a, c).all() and len(np.intersect1d(b, c)) == 2


def test_ranks(spark):
    """As one sorted list has them, though one value holds most rows and no partition holds all."""
    r = random.Random(3)
    rows = [(r.choice("ab"), 7 if r.random() < 0.6 else r.randrange(50), i) for i in r.sample(range(5000), 3000)]
    df = spark.createDataFrame(rows, "g string, x long, tie long").repartition(7)
    order = [F.col("x"), F.col("tie")]
    got = splits.ranked(df, order, F.col("x"), F.col("tie")).collect()
    assert [(x.g, x.x, x.tie) for x in sorted(got, key=lambda x: x.position)] == sorted(rows, key=lambda x: x[1:]) and sorted(x.position for x in got) == list(range(3000))
    by = splits.ranked(df, order, F.col("x"), by=["g"], name="n").collect()
    assert {(x.g, x.tie): x.n for x in by} == {(g, t): n for k in "ab" for n, (g, _, t) in enumerate(sorted((x for x in rows if x[0] == k), key=lambda x: x[1:]))}
    assert splits.ranked(df.limit(0), order, F.col("x")).count() == 0
    assert sorted(x.tie for x in splits.whole_batches(df, "tie", 7).collect()) == sorted(x[2] for x in rows)[: 3000 - 3000 % 7]
    assert sorted(x.position for x in splits.epoch_order(df, "tie", 1, 2).collect()) == list(range(3000))


def test_quotas_and_samples(spark):
    assert splits.quotas({"a": 10, "b": 1, "c": 10}, 9) == {"a": 4, "b": 1, "c": 4}
    assert splits.quotas({"plain": 100, "rare": 12}, 20, reserve=10) == {"plain": 18, "rare": 2}
    assert splits.quotas({}, 5) == {} and sum(splits.quotas({"a": 1, "b": 1}, 9).values()) == 2
    pool = spark.range(400).select(F.concat(F.lit("m"), (F.col("id") % 5).cast("string")).alias("mode"), "id")
    assert {r["count"] for r in splits.equal_sample(pool, "mode", "id", 100, 1).groupBy("mode").count().collect()} == {20}
    sets = splits.disjoint_sets(pool, "mode", "id", {"one": 32, "two": 100}, 3)
    assert sets.count() == sets.select("id").distinct().count() == 132
    assert {r.mode: r["count"] for r in splits.capped(pool, "mode", "id", {"m0": 2, "m1": None}, 1).groupBy("mode").count().collect()} == {"m0": 2, "m1": 80, "m2": 80, "m3": 80, "m4": 80}


def test_apportion_and_stages(spark):
    assert sum(splits.apportion([100, 30, 5], 1500)) == 1500 and splits.apportion([10, 10, 10], 2) == [1, 1, 0] and splits.apportion([0, 5], 3) == [0, 3]
    df = spark.createDataFrame([(n,) for n in [1, 2, 3, 50, 51, 52, 100, 101]], "n int")
    centres = splits.length_centres(df, "n", 3)
    assert centres == [2.0, 51.0, 100.5] and splits.length_centres(df.limit(0), "n", 3) == []
    assert [r[0] for r in df.orderBy("n").select(splits.stage_of(F.col("n"), centres)).collect()] == [1, 1, 1, 2, 2, 2, 3, 3]


def next_fit(lengths, limit):
    pack, used, out = 0, 0, []
    for n in (min(x, limit) for x in lengths):
        if used and used + 1 + n > limit:
            pack, used = pack + 1, 0
        at = used + (used > 0)
        out.append((pack, at))
        used = at + n
    return out


def test_packing(spark):
    for seed in range(3):
        r = random.Random(seed)
        lengths = [5, 4, 8, 3, 9, 2, 2, 2, 12] if not seed else [r.randint(0, 14) for _ in range(40)]
        rows = spark.createDataFrame(list(enumerate(lengths)), "ord long, length long")
        got = packing.assign(rows, 10).orderBy("ord").collect()
        assert [(x.pack, x.offset) for x in got] == next_fit(lengths, 10)
    apart = packing.assign(spark.createDataFrame([(i, 4) for i in range(9)], "ord long, length long"), 10, span=3).orderBy("ord").collect()
    assert [(x.shard, x.pack, x.offset) for x in apart] == [(i // 3, i % 3 // 2, 5 * (i % 3 % 2)) for i in range(9)]
    tokens = spark.createDataFrame([(0, [5, 9, 6]), (1, [7, 7]), (2, [9, 1, 2, 3])], "ord long, tokens array<int>")
    places = packing.assign(tokens.select("ord", F.size("tokens").alias("length")), 8)
    got = packing.packed(tokens, places, 8, marker=9).orderBy("pack").collect()
    assert [r.ids for r in got] == [[5, 9, 6, 1, 7, 7, 0, 0], [9, 1, 2, 3, 0, 0, 0, 0]]
    assert [r.mask for r in got] == [[0, 0, 1, 0, 0, 0, 0, 0], [0, 1, 1, 1, 0, 0, 0, 0]]
    assert [r.boundaries[:2] for r in got] == [[1, -1], [0, -1]]


def test_masks(spark):
    row = spark.createDataFrame([([4, 101, 102, 103, 8, 101, 102, 103],)], "t array<int>").select(packing.subsequence(F.col("t"), [101, 102, 103]), packing.subsequence(F.col("t"), [9] * 20), packing.zero_fraction(F.lit(4), F.lit(1)), F.size(packing.padded(F.col("t"), 100))).first()
    assert row[0] == [1, 5] and row[1] == [] and row[2] == pytest.approx(1 / 3) and row[3] == 33
    weights = spark.createDataFrame([("{",), ("\\draw",), ("12.5",), ("node",)], "t string").select(packing.token_weight(F.col("t"))).collect()
    assert [w[0] for w in weights] == [5.0, 2.0, 1.0, 1.0]


def test_gates(spark):
    good = dict.fromkeys((m for m, k, _, _ in metrics.PROMOTION if k == "min"), 1.0) | {"avg_code_length_ratio_vs_base": 1.0}
    rows = [("good", m, v) for m, v in good.items()] + [("bad", m, v) for m, v in (good | {"avg_raw_token_ratio_vs_base": 2.0}).items()]
    long = spark.createDataFrame(rows, "variant string, metric string, value double")
    got = {r.variant: (r.passed, r.violations) for r in metrics.gate(long, metrics.promotion_limits(spark, {"compile_rate": 0.9, "repetition_loop_rate": 0.0}), "variant").collect()}
    assert got == {"good": (True, ""), "bad": (False, "avg_raw_token_ratio_vs_base")}
    looped = spark.createDataFrame([("c", "repetition_loop_rate", 0.03), ("c", "truncation_rate", 0.0), ("c", "compile_rate", 0.5)], "variant string, metric string, value double")
    assert metrics.gate(looped, metrics.recovery_limits(spark, "ablation"), "variant").first().violations == "repetition_loop_rate"


def test_selections(spark):
    ck = spark.createDataFrame([("a", 4000, False, 0.2, 0.5, 0.1), ("b", 5000, False, 0.2, 0.5, 0.1), ("c", 6000, True, 0.1, 0.9, 0.0)], "p string, iteration int, collapse boolean, partial_emd double, compile_rate double, failure_rate double")
    assert metrics.stable_checkpoint(ck, 0.3).first().p == "b"
    with pytest.raises(ValueError):
        metrics.stable_checkpoint(ck.where("iteration <> 5000"), 0.3)
    rewards = spark.createDataFrame([("g", 1.0), ("g", 3.0), ("h", 2.0)], "g string, r double")
    assert sorted(r.advantage for r in metrics.advantages(rewards, "g", "r", scaled=True).collect()) == [-1.0, 0.0, 1.0]
    telemetry = spark.createDataFrame([("r", i, "bad" if i == 4 else "0.5") for i in range(5)], "run string, step int, scale string")
    assert not metrics.recent_window(telemetry, "run", "step", ["scale"]).first().numeric
    place = spark.range(1).select(metrics.cursor(F.lit(5), F.lit(4)).alias("c")).first().c
    assert tuple(place) == (1, 1, 3)


def test_profiles(spark):
    df = spark.createDataFrame([(x,) for x in [400, 500, 2000]], "n int")
    assert profiles.length_profile(df, "n").first().most == 2000 and profiles.shares_from(df, "n").first().ge_1024 == pytest.approx(1 / 3, abs=1e-6)
    bins = profiles.histogram(spark.createDataFrame([(0.0,), (1.0,), (2.0,), (-1.0,), (None,)], "w double"), "w", 4).orderBy("bin").collect()
    assert [b.n for b in bins] == [2, 0, 0, 2]


def test_similarity():
    assert similarity.transport_score([[1, 0], [0, 1]], [[0, 1], [1, 0]]) == (pytest.approx(1.0), "transport")
    assert similarity.transport_score([], [[1.0]]) == (0.0, "empty") and similarity.transport_score([[1, 0]], [[1, 0], [0, 1]])[1] == "selfsim"
    from itertools import permutations

    r = np.random.default_rng(0)
    for n in range(1, 6):
        cost = r.random((n, n))
        assert similarity.assignment(cost) == pytest.approx(min(sum(cost[i, p[i]] for i in range(n)) for p in permutations(range(n))))


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n{bad\n{"x": 2}\n')
    path = f"file://{tmp_path}/a.jsonl"
    assert files.read_jsonl(spark, path, "x long", "drop").collect() == [(1,), (2,)]
    with pytest.raises(Exception, match="FAILFAST|Malformed|MALFORMED"):
        files.read_jsonl(spark, path, "x long").collect()
    assert files.read_or_empty(spark, f"file://{tmp_path}/none", "x long").count() == 0
    assert files.fingerprint(spark, path).first().sha256 == hashlib.sha256((tmp_path / "a.jsonl").read_bytes()).hexdigest()
    df = spark.createDataFrame([(1, "train", []), (2, "val", ["r"])], "x long, split string, reasons array<string>")
    files.write_splits(df.drop("reasons"), f"file://{tmp_path}/s")
    assert spark.read.json(f"file://{tmp_path}/s").where("split = 'val'").first().x == 2
    with pytest.raises(Exception, match="exists|EXISTS"):
        files.write_splits(df.drop("reasons"), f"file://{tmp_path}/s")
    files.write_kept_and_rejected(df, "reasons", f"file://{tmp_path}/k", f"file://{tmp_path}/r")
    assert spark.read.json(f"file://{tmp_path}/k").count() == spark.read.json(f"file://{tmp_path}/r").count() == 1
    assert {(r.k, r.v) for r in files.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c")], "k int, v string"), "k").collect()} == {(1, "a"), (2, "c")}


def test_streams(spark, tmp_path):
    rows = [(i, i % 3, f"2024-01-01 0{i % 4}:00:00") for i in range(30)]
    spark.createDataFrame(rows, "event_id long, run long, ts string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{tmp_path}/e")
    read = lambda: spark.readStream.schema("event_id long, run long, ts timestamp").parquet(f"{tmp_path}/e")

    def drained(df, mode):
        q = df.writeStream.outputMode(mode).format("memory").queryName("drained").trigger(availableNow=True).start()
        q.awaitTermination(90)
        return spark.table("drained").collect()

    assert len(drained(windows.deduplicated(read(), "run"), "append")) == 3
    batch = windows.counted(spark.read.parquet(f"{tmp_path}/e"), "ts", "1 hour")
    assert sorted(map(tuple, drained(windows.counted(read(), "ts", "1 hour"), "complete"))) == sorted(map(tuple, batch.collect()))
    assert sorted((r.run, r.done, r.epoch, r.cursor) for r in drained(windows.cursors(read(), "run", 4), "update")) == [(0, 10, 2, 2), (1, 10, 2, 2), (2, 10, 2, 2)]
