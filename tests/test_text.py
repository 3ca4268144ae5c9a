"""Text functions, critics, code repair and readings on literals."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.functions import tex
from millrace.functions import text as T
from millrace.plans.texts import quality_reasons


def of(spark, value, column):
    """The value of a column function on one text."""
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t")).alias("r")).first()["r"]


def test_normalising(spark):
    assert of(spark, "A \\% b % gone\n\t C% x", T.normalised) == "a \\% b c"
    assert of(spark, "\\draw[x] (1.5,2) é", T.tokens) == ["\\draw", "[", "x", "]", "(", "1", ".", "5", ",", "2", ")", "é"]
    assert of(spark, " \n x y\t", T.strip) == "x y" and of(spark, " \n", T.filled) is None


def test_shingles_and_runs(spark):
    assert of(spark, "a b a b a", lambda t: T.shingles(T.words(t), 2)) == ["a b", "b a"]
    assert of(spark, "a", lambda t: T.shingles(T.words(t), 2)) == []
    assert of(spark, "a\na\n\nb\nb\nb\na", lambda t: T.longest_run(T.lines(t))) == 3
    assert of(spark, "", lambda t: T.longest_run(T.lines(t))) == 0
    assert of(spark, "x y y x z", lambda t: T.most_common(T.words(t))["item"]) == "x"


def test_repetition_reasons(spark):
    check = lambda code: of(spark, code, lambda t: quality_reasons(t, F.length(t), 1536))
    assert check("\\begin{tikzpicture}\\draw (0,0);\\end{tikzpicture}") == []
    assert check("\\begin{tikzpicture}\n" + ">=stealth,\n" * 10 + "\\end{tikzpicture}") == ["stealth_loop", "repeated_line_loop"]
    assert check("\\begin{tikzpicture}\n" + "\\draw (0,0) -- (1,1);\n" * 5 + "\\end{tikzpicture}") == ["repeated_line_loop"]
    assert check(")(") == ["missing_tikz_environment", "unbalanced_parentheses"]
    assert check("\\begin{axis} (0.12345,1)") == ["high_precision_numeric_poisoning"]


def test_bad_patterns(spark):
    assert of(spark, "\\draw x;\n" * 150, T.bad_patterns) == ["repeated_draw_node_excessive"]
    assert of(spark, "a \\\\\\\\ b", T.bad_patterns) == ["consecutive_backslashes"]
    assert of(spark, "fine", T.bad_patterns) == []


def test_critic(spark):
    check = lambda code, mode="plain_tikz": of(spark, code, lambda t: T.critic(t, F.lit(mode)))
    assert check("\\begin{tikzpicture}\\draw (0,0) -- (1,1);\\end{tikzpicture}") == []
    assert "pgfplots_keys_in_plain_tikz" in check("\\begin{tikzpicture}[xmin=0]\\draw;\\end{tikzpicture}")
    assert check("\\begin{tikzpicture}\\draw (5000,1);\\end{tikzpicture}") == ["coordinate_out_of_range"]
    assert "missing_axis_environment" in check("\\draw (0,0) -- (1,1) node {x};", "pgfplots_axis")
    assert check("x % {\n" + "ok line with text\n") == []
    assert "repetition_collapse" in check("\n".join(["same line"] * 8 + ["a", "b", "c"]))


def test_features(spark):
    assert of(spark, "\\usetikzlibrary{calc, arrows.meta}\\usetikzlibrary{calc}", T.libraries) == ["arrows.meta", "calc"]
    box = of(spark, "\\draw (-0.2,-0.2) -- (4.25, 3);", T.bounding_box)
    assert tuple(box) == (-0.2, -0.2, 4.25, 3.0) and of(spark, "none", T.bounding_box) is None
    modes = {"\\begin{axis}": "pgfplots_axis", "\\begin{tikzcd}": "commutative_diagram", "\\graph {": "graph_nodes", "\\begin{circuitikz}": "scientific_schematic", "x": "plain_tikz"}
    assert all(of(spark, t, T.generation_mode) == m for t, m in modes.items())
    assert of(spark, "Figure 1", T.description_score) == 0.0
    assert of(spark, "a red circle and an arrow to the node on the grid", T.description_score) == pytest.approx(12 / 30 * 0.5 + 0.4)
    good = "\\begin{tikzpicture}\\draw (0,0) -- (1,1);\\node at (2,2) {x};\\end{tikzpicture}"
    assert of(spark, good, T.substance)["passed"] and not of(spark, "prose", T.substance)["passed"]
    assert of(spark, "\\usepackage{x}\\usepackage{y}", T.boilerplate) == pytest.approx(0.4 + 1.2)
    assert of(spark, "\\usetikzlibrary{mindmap,foo}\\draw x; \\node (a)", T.pedagogical) == pytest.approx(1 + 3.0 + 0.1 + 0.3)


def test_canonical(spark):
    good = "\\documentclass[tikz]{standalone}\n\\begin{document}x\\end{document}"
    assert of(spark, good, T.canonical)
    assert not of(spark, "```\n" + good, T.canonical) and not of(spark, good + good, T.canonical) and not of(spark, "", T.canonical)


def test_collapse(spark):
    assert "repetition_loop" in of(spark, "same\n" * 5, T.collapse)
    drawn = "\n".join(f"\\draw[red] ({i},{i}) -- ({i + 1},{i}.5);" for i in range(12))
    assert "low_loop_bigram_diversity" in of(spark, drawn, T.collapse)
    assert of(spark, "a short text", T.collapse) == []


def test_contract(spark):
    rows = spark.createDataFrame([("p ```latex", "\\begin{tikzpicture}\\end{tikzpicture}\n```", 1, 1), ("p", "\\documentclass{article}\n```", 2, 1)], "u string, a string, n int, m int")
    got = [r[0] for r in rows.select(T.contract(F.col("u"), F.col("a"), F.col("n"), F.col("m"))).collect()]
    assert got == [[], ["user_count_not_one", "opening_latex_fence_count", "assistant_env_start", "assistant_documentclass"]]


def test_distances(spark):
    pair = spark.createDataFrame([(["a", "b", "c"], ["a", "x", "c", "d"]), ([], ["a"]), (["q"], ["q"])], "x array<string>, y array<string>")
    assert [r[0] for r in pair.select(T.edit_distance(F.col("x"), F.col("y"))).collect()] == [2, 1, 0]
    assert [r[0] for r in pair.select(T.jaccard(F.col("x"), F.col("y"))).collect()] == [0.4, 0.0, 1.0]


def test_fences(spark):
    text = "a ```latex\none``` b ```twolong``` c ```x```"
    assert of(spark, text, T.last_fence) == "x" and of(spark, " none ", T.last_fence) == "none"
    assert of(spark, text, T.longest_fence) is not None


def test_code_repair():
    assert tex.strip_comments("\\draw a; % gone\n\\node {100\\%};") == "\\draw a;\n\\node {100\\%};"
    assert tex.unwrap("x\\begin{document} a \\begin{tikzpicture}\\end{tikzpicture} \\end{document} y") == "a \\begin{tikzpicture}\\end{tikzpicture}"
    assert tex.unwrap("noise \\begin{tikzpicture} b \\end{tikzpicture} tail") == "\\begin{tikzpicture} b \\end{tikzpicture}"
    assert tex.brace_coordinates("(x+1, y) (1,2) ($a+b$) (90:2) (sin(30),1)") == "({x+1}, y) (1,2) ($a+b$) (90:2) ({sin(30)},1)"
    assert tex.brace_coordinates("open (1,2") == "open (1,2"
    assert tex.end_statements("\\draw (0,0) -- (1,1)\n\\node {x}\n\\end{scope}") == "\\draw (0,0) -- (1,1);\n\\node {x};\n\\end{scope}"
    assert tex.end_statements("\\begin{tikzpicture}\n\\draw (0,0);\n\\end{tikzpicture}") == "\\begin{tikzpicture}\n\\draw (0,0);\n\\end{tikzpicture}"
    assert tex.close_environments("\\begin{axis}") == "\\begin{axis}\n\\end{axis}"
    assert tex.drop_defaults("\\draw[draw=black, line width=0.4pt] ( 1 , 2 ) [thick, solid]") == "\\draw (1,2) [thick]"
    assert tex.shorten_floats("0.941517 -1.20711 2.5 3 1.00004") == "0.942 -1.207 2.5 3 1.0"
    assert tex.round_coordinates("1.2345 -0.001 2.5") == "1.23 -0 2.5"
    assert tex.drop_repeated_commands("\\draw a;\nx\n\\draw a;\n\\draw {\n\\draw {") == "\\draw a;\nx\n\\draw {\n\\draw {"
    assert tex.cap_runs("a\na\na\na\n\n\nb") == "a\na\na\n\n\nb"
    assert tex.set_styles("\\tikzstyle{n}=[draw] \\tikzstyle{m} += {fill}") == "\\tikzset{n/.style={draw}} \\tikzset{m/.append style={fill}}"
    assert tex.target("\\begin{tikzpicture}\n\n\\draw[solid] (0,0) -- (1.23456,1)\n\\end{tikzpicture} % end") == "\\begin{tikzpicture}\n\\draw (0,0) -- (1.235,1);\n\\end{tikzpicture}"
    assert tex.clean_body("\\begin{figure}[h]\n\\centering\n\\caption{x}\n\\draw a;\t\n\\only<2>{b}\n\\end{figure}") == "\\draw a;\n{b}"


def test_audit_and_blocks():
    assert tex.audit("")[2] == [] and "distance" in tex.audit("a " * 200 + "\\begin{tikzpicture}x\\end{tikzpicture}")[2]
    two = "\\begin{subfigure}\\begin{tikzpicture}a\\end{tikzpicture}\\end{subfigure}\\begin{circuitikz}b\\end{circuitikz}\\end{tikz-cd}"
    assert [(e, p) for e, _, _, p in tex.blocks(two)] == [("tikzpicture", "subfigure"), ("circuitikz", None)]


def test_grammar():
    picture = "\\begin{tikzpicture}\\draw (0,0);\\end{tikzpicture}"
    assert tex.abort_reason(picture) == ""
    assert tex.abort_reason("{" * 31) == "brace depth" and tex.abort_reason("[" * 21) == "bracket depth"
    assert tex.abort_reason("\\begin{tikzpicture}\\begin{tikzpicture}") == "duplicate environment"
    assert tex.abort_reason(picture + "x" * 61) == "content after the environment"
    assert tex.abort_reason("\\foreach \\x in {1,...,600}") == "loop range"
    assert tex.abort_reason("% " + "{" * 40 + "\n" + picture) == ""
