"""Refusals, files, streams that go on, package rules and generated records."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.functions import packages
from millrace.operators import checks, generate
from millrace.sources import files
from millrace.streaming import windows


def test_floors_skips_and_refusals(spark):
    rows = spark.createDataFrame([("12",), (" 9 ",), ("x",), (None,), ("1.5",), ("30",)], "n string")
    assert [r.n for r in checks.length_floor(rows, F.col("n"), 9).collect()] == ["12", " 9 ", "30"]
    texts = {"long": [str(i) for i in range(60)], "loop": ["a", "b"] * 25, "short": ["a"] * 39, "tiny": ["a"], "none": []}
    got = spark.createDataFrame(list(texts.items()), "k string, t array<string>").select("k", checks.skip_reasons(F.col("t"), 50).alias("r")).collect()
    assert {r.k: r.r for r in got} == {"long": ["over_length"], "loop": ["repetitive"], "short": [], "tiny": [], "none": []}
    assert checks.refuse(rows, F.col("n") == "31", "no").count() == 6
    with pytest.raises(ValueError, match="no x"):
        checks.refuse(rows, F.col("n") == "x", "no x")
    assert [r.t for r in spark.createDataFrame([(None, 2), (0.5, 0), (0.5, 9)], "b double, r int").select(checks.raised_temperature(F.col("b"), F.col("r")).alias("t")).collect()] == [pytest.approx(0.3), 0.5, 0.9]
    sizes = spark.createDataFrame([(100.0,), (513.9,), (9999.0,)], "p double").select(checks.context_size(F.col("p")).alias("c"), checks.iterations(F.lit(10), 3.0, 4, 8).alias("i"), checks.iterations(F.lit(10), 3.0, 4, 8, given=3).alias("g")).collect()
    assert [r.c for r in sizes] == [512, 640, 1536] and {(r.i, r.g) for r in sizes} == {(8, 8)}
    reasons = spark.createDataFrame([(0.0, 0.0, 1.0), (4.0, 90.0, 1.0), (31.0, 40.0, 0.0), (32.0, 32.0, 0.001)], "w double, h double, i double").select(checks.render_reasons(F.col("w"), F.col("h"), F.col("i")).alias("r")).collect()
    assert [r.r for r in reasons] == [["too_small"], ["invisible", "too_small"], ["too_small", "blank"], []]


def test_verdict_and_warnings(spark):
    empty, two = spark.range(0), spark.range(2)
    assert {r.kind: r.n for r in checks.verdict({"a": empty, "b": empty}).collect()} == {"a": 0, "b": 0, "pass": 1}
    assert {r.kind: r.n for r in checks.verdict({"a": empty, "b": two}).collect()} == {"a": 0, "b": 2, "pass": 0}
    raw = spark.createDataFrame([("m", "t")] * 100, "mode string, text string")
    probe = spark.createDataFrame([("z", "t"), ("m", "t")], "mode string, text string")
    clean = spark.createDataFrame([("m", "bad bad")] * 10, "mode string, text string")
    got = {(r.warning, r.subject) for r in checks.audit_warnings(raw, clean, probe, "mode", "text", {"bad": "bad", "other": "zz"}).collect()}
    assert got == {("one_mode", "m"), ("probe_skew", "m"), ("probe_skew", "z"), ("marker", "bad"), ("retention", "rows")}


def test_repairs_in_two_passes(spark):
    rows = spark.createDataFrame([("x;",), ("x",), ("y!",), ("y!",)], "code string")
    cache = spark.createDataFrame([(hashlib.sha256(b"y!").hexdigest(), "Y")], "content_hash string, final string")
    got = checks.compile_and_repair(rows, "code", F.endswith("code", F.lit(";")), F.concat("code", F.lit(";")), cache).collect()
    assert [(r.code, r.outcome, r.final) for r in got] == [("x;", "ok", "x;"), ("x", "repaired", "x;"), ("y!", "cached", "Y"), ("y!", "cached", "Y")]
    failed = checks.compile_and_repair(rows, "code", F.endswith("code", F.lit("?")), F.col("code")).collect()
    assert {(r.outcome, r.final) for r in failed} == {("failed", None)}


def test_files(spark, tmp_path):
    Path(tmp_path, "a.jsonl").write_text('{"x": 1}\n\n[1]\n"s"\n {"x": 2}\n{"y": 3}\n')
    assert [r.x for r in files.read_json_objects(spark, f"file://{tmp_path}/a.jsonl", "x int").collect()] == [1, 2, None]
    Path(tmp_path, "b").write_text("b")
    one = files.names_fingerprint(spark, f"file://{tmp_path}/a.jsonl", f"file://{tmp_path}/b").first()
    two = files.names_fingerprint(spark, f"file://{tmp_path}/b", f"file://{tmp_path}/a.jsonl").first()
    assert one == two and one.files == 2
    for n in (1, 2):
        files.write_object(spark.range(1).select(F.lit(n).alias("b"), F.lit(None).cast("string").alias("a")), f"file://{tmp_path}/m.json")
        assert json.loads(Path(tmp_path, "m.json").read_text()) == {"a": None, "b": n}
    with pytest.raises(ValueError):
        files.write_object(spark.range(2), f"file://{tmp_path}/m.json")
    copy = files.snapshot(spark.range(3), f"file://{tmp_path}/s")
    assert copy.count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.snapshot(spark.range(3), f"file://{tmp_path}/s")
    Path(tmp_path, "f.tex").write_text(" \\draw a; \n")
    none = spark.createDataFrame([], "sample_id string, source string, description string, code string")
    once = files.with_figure(none, spark, f"file://{tmp_path}/f.tex", "a line", "mine").collect()
    assert [(r.source, r.code) for r in once] == [("mine", "\\draw a;")]
    assert files.with_figure(spark.createDataFrame(once), spark, f"file://{tmp_path}/f.tex", "again", "mine").count() == 1


def test_streams_go_on(spark, tmp_path):
    source, root = f"{tmp_path}/in", f"file://{tmp_path}"
    spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 1.0)], "k int, v double").coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema("k int, v double").parquet(source)
    first = lambda: sorted(r.k for r in windows.appended(stream().select("k"), ["k"], f"{root}/rows", f"{root}/state").collect())
    tally = lambda: {r.k: (r.n, r.total) for r in windows.tallied(stream(), ["k"], "v", f"{root}/sums", f"{root}/sums-state").collect()}
    assert first() == [1, 2] and tally() == {1: (2, 5.0), 2: (1, 1.0)}
    spark.createDataFrame([(2, 1.0), (3, 4.0)], "k int, v double").coalesce(1).write.mode("append").parquet(source)
    assert first() == [1, 2, 3] and tally() == {1: (2, 5.0), 2: (2, 2.0), 3: (1, 4.0)}
    got = windows.resynced(spark.createDataFrame([(1, 90), (2, 5)], "run long, done long"), spark.createDataFrame([(1, 70), (3, 1)], "run long, done long"), "run", 40).collect()
    assert {r.run: (r.done, r.epoch, r.cursor) for r in got} == {1: (90, 2, 10), 2: (5, 0, 5), 3: (1, 0, 1)}


def test_packages(spark):
    code = "\\usepackage{foo, tikz}\n\\begin{axis}\\addplot[xmin=0] (0,0) -> (1,1);\\end{axis}\\usetikzlibrary{fit}\\tikzstyle"
    row = spark.createDataFrame([(code,), ("",)], "c string").select(packages.required_packages(F.col("c")).alias("p"), packages.required_libraries(F.col("c")).alias("l"), packages.dialect_flags(F.col("c")).alias("d")).collect()
    assert row[0].l == ["arrows.meta", "fit"] and row[0].d == ["pgfplots", "legacy_tikzstyle"]
    assert row[0].p == [
        "\\usepackage[active,tightpage]{preview}", "\\usepackage{foo}", "\\usepackage{pgfplots}", "\\usepackage{tikz}",
        "\\PreviewEnvironment{axis}", "\\PreviewEnvironment{semilogxaxis}", "\\PreviewEnvironment{semilogyaxis}", "\\PreviewEnvironment{tikzpicture}", "\\pgfplotsset{compat=1.18}", "\\usetikzlibrary{arrows.meta, fit}",
    ]
    assert row[1].p == ["\\usepackage[active,tightpage]{preview}", "\\usepackage{tikz}", "\\PreviewEnvironment{tikzpicture}"] and row[1].l == row[1].d == []


def test_generated(spark):
    assert generate.candidates(spark).count() == 900 and generate.candidates(spark, count=200).groupBy("category").count().count() == 2
    ellipse = generate.candidates(spark).where("category = 'primitive_ellipse' and i = 9").first()
    assert ellipse.code == "\\begin{tikzpicture}\n\\coordinate (C) at (-1,-2);\n\\draw[teal] (C) ellipse (2 and 0.6);\n\\node at (-1,-2) {E};\n\\end{tikzpicture}".replace("teal", generate.COLOURS[15 % 10])
    seeds = {r.sample_id: r.text for r in generate.repetition_seeds(spark).collect()}
    assert len(seeds) == 3 and seeds["synthetic_repetition_001"].count("\n") == 5
