"""Record builders, repairs and tool places on literals."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import plug
from millrace.operators import records as R
from millrace.session import ship
from millrace.sources import files


def test_training_records(spark):
    ship(spark)
    rows = spark.createDataFrame([("a", "s", "\\begin{tikzpicture}\n\\draw (0,0) -- (1,2)\n\\end{tikzpicture}", " a line ")], "sample_id string, source string, code string, description string")
    r = R.training_records(rows).first()
    assert r.messages[0].text.startswith(R.PROMPT_HEAD + "a line\n\n[GEOMETRY HINTS]\nmode: plain_tikz\nbounding_box: (0, 0) to (1, 2)\n") and r.messages[0].text.endswith("```latex")
    assert r.messages[1].text == "\\begin{tikzpicture}\n\\draw (0,0) -- (1,2);\n\\end{tikzpicture}\n```\n"
    assert R.paired_records(rows).first().reference_code.endswith("\\end{tikzpicture}")


def test_messages(spark):
    m = [("user", [("text", "a"), ("image", None), ("text", "b")]), ("assistant", [("text", "c")])]
    df = spark.createDataFrame([(m,)], "m array<struct<role string, content array<struct<type string, text string>>>>")
    flat = df.select(R.flattened(F.col("m")).alias("x"), R.flattened(F.col("m"), "\n").alias("y"))
    r = flat.select(F.col("x")[0]["text"], F.col("y")[0]["text"], R.of_role(F.col("x"), "assistant", 1), R.of_role(F.col("x"), "tool", 0), R.first_text(F.col("x"), "tool")).first()
    assert tuple(r) == ("ab", "a\nb", "c", "ab", None)


def test_contract_repair(spark):
    none = "\\documentclass{article}\\begin{document}text \\begin{tikzpicture}\\end{tikzpicture}\\end{document}```"
    rows = spark.createDataFrame([("a", "Please draw according to the following requirements:\na box\nOutput constraints: x ```latex", none, None)], "sample_id string, user string, assistant string, mode string")
    rows = rows.withColumn("libraries", F.array().cast("array<string>")).withColumn("box", F.lit(None).cast("struct<min_x:double,min_y:double,max_x:double,max_y:double>"))
    r = R.repaired(rows).first()
    assert r.changed and r.after == [] and "assistant_documentclass" in r.before
    assert r.new_assistant == "\\begin{tikzpicture}\\end{tikzpicture}\n```\n" and r.new_user.startswith(R.PROMPT_HEAD + "a box\n")


def test_keys_and_candidates(spark):
    df = spark.createDataFrame([(None, " ", "repo/x.tex"), ("p1", None, "word"), (None, None, "word")], "a string, b string, c string")
    assert [r[0] for r in df.select(R.source_key(F.col("a"), F.col("b"), loose=F.col("c"))).collect()] == ["repo/x.tex", "p1", None]
    texts = spark.createDataFrame([("a ```latex\nx``` ```longer one``` ",), ("say \\documentclass{a} b \\end{document} c",), ("q \\begin{tikzpicture}z\\end{tikzpicture}",), (" bare ",)], "t string")
    got = [r[0] for r in texts.select(R.candidate_code(F.col("t"))).collect()]
    assert got[0] == "one" and got[1] == "\\documentclass{a} b \\end{document}" and got[2].endswith("z\\end{tikzpicture}\n\\end{document}") and got[3] == "bare"
    line = spark.createDataFrame([("Iter 5/20 at 3.5 it/s",), ("nothing",)], "t string").select(R.log_fields(F.col("t")).alias("f")).collect()
    assert tuple(line[0].f) == (5, 20, 3.5) and tuple(line[1].f) == (None, None, None)


def test_tool_places(spark):
    df = spark.createDataFrame([("a", True), ("abc", True), ("b", False)], "t string, ok boolean")
    assert {r.status for r in plug.compile_status(df, "t", tool="no-such-tool").collect()} == {"tool_missing"}
    assert [r.sample_weight for r in plug.weighted(df, "t", "ok", lambda s: s.str.len() / 2).collect()] == [0.5, 1.0, 0.0]

    def broken(s: pd.Series) -> pd.Series:
        raise ValueError("no scorer")

    assert [r.sample_weight for r in plug.weighted(df, "t", "ok", broken, "zero").collect()] == [0.0, 0.0, 0.0]
    with pytest.raises(Exception, match="no scorer"):
        plug.weighted(df, "t", "ok", broken).collect()


def test_difference_hash(spark):
    pixels = [(i * 7) % 23 for i in range(72)]
    bits = sum(1 << (r * 8 + c) for r in range(8) for c in range(8) if pixels[r * 9 + c] > pixels[r * 9 + c + 1])
    assert spark.createDataFrame([(pixels,)], "p array<int>").select(plug.difference_hash(F.col("p"))).first()[0] == f"{bits:016x}"


def test_ingest(spark):
    code = "\\begin{tikzpicture}" + "\\draw (0,0) -- (1,1);" * 6 + "\\end{tikzpicture}"
    rows = [(0, "s", code, "one"), (1, "s", code, "again"), (2, "s", code + "x", " "), (3, "s", None, "d"), (4, "s", code + "\\input{a}", "d"), (5, "s", "short", "d"), (6, "s", code + "y", "d")]
    df = spark.createDataFrame(rows, "ord long, source string, code string, description string")
    first = files.ingest(df)
    assert [r.ord for r in first.orderBy("ord").collect()] == [0, 6] and {r.mode for r in first.collect()} == {"plain_tikz"}
    assert [r.ord for r in files.ingest(df, known=first.where("ord = 0")).collect()] == [6]
    ready = files.readiness(df, 5, "ord").first()
    assert tuple(ready) == (5, 4, 4, 3)
