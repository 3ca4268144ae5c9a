"""Generated figure records: rows of a range turned into code by expressions, without a seed or a loop."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Colours and line styles, by turns.
COLOURS = ("black", "red", "blue", "green", "orange", "purple", "cyan", "magenta", "teal", "gray")
STYLES = ("solid", "dashed", "dotted", "thick", "very thick")


def _turn(names: tuple[str, ...], shift: int = 0) -> str:
    return f"case i % {len(names)} " + " ".join(f"when {i} then '{names[(i + shift) % len(names)]}'" for i in range(len(names))) + " end"


# Rows, expressions of the row number i, description and code of each family, in order. Braces that
# hold a name stand for its value; # marks a number, written with up to two decimals.
FAMILIES = {
    "primitive_line": (
        180,
        {"x1": "i % 9 - 4", "y1": "i * 2 % 9 - 4", "x2": "i % 9 - 3 + i % 4 * 0.5", "y2": "i * 2 % 9 - 4 + i * 3 % 5 - 1", "colour": _turn(COLOURS), "style": _turn(STYLES)},
        "Draw a {style} {colour} segment from ({#x1},{#y1}) to ({#x2},{#y2}).",
        "\\coordinate (A) at ({#x1},{#y1});\n\\coordinate (B) at ({#x2},{#y2});\n\\draw[{style}, {colour}] (A) -- (B);",
    ),
    "primitive_circle": (
        150,
        {"x": "i * 2 % 11 - 5", "y": "i * 3 % 9 - 4", "r": "0.3 + i % 6 * 0.2", "colour": _turn(COLOURS, 2), "n": "cast(i % 10 as string)"},
        "Draw a {colour} circle centered at ({#x},{#y}) with radius {#r} and label it C{n}.",
        "\\coordinate (C) at ({#x},{#y});\n\\draw[{colour}] (C) circle ({#r});\n\\node at ({#x},{#y}) {C{n}};",
    ),
    "primitive_rectangle": (
        150,
        {
            "x": "i % 8 - 4", "y": "i * 3 % 8 - 4", "x2": "i % 8 - 3 + i % 4 * 0.5", "y2": "i * 3 % 8 - 4 + 0.6 + i % 5 * 0.4", "xm": "i % 8 - 4 + (1 + i % 4 * 0.5) / 2", "ym": "i * 3 % 8 - 4 + (0.6 + i % 5 * 0.4) / 2",
            "colour": _turn(COLOURS, 4), "round": "case when i % 4 = 0 then ', rounded corners' else '' end",
        },
        "Draw a {colour} rectangle from ({#x},{#y}) to ({#x2},{#y2}) and mark its center.",
        "\\coordinate (A) at ({#x},{#y});\n\\coordinate (B) at ({#x2},{#y2});\n\\draw[{colour}{round}] (A) rectangle (B);\n\\node at ({#xm},{#ym}) {R};",
    ),
    "primitive_ellipse": (
        120,
        {"x": "i % 7 - 3", "y": "i * 4 % 7 - 3", "rx": "0.8 + i % 5 * 0.3", "ry": "0.4 + i % 4 * 0.2", "colour": _turn(COLOURS, 6)},
        "Draw a {colour} ellipse centered at ({#x},{#y}) with x-radius {#rx} and y-radius {#ry}.",
        "\\coordinate (C) at ({#x},{#y});\n\\draw[{colour}] (C) ellipse ({#rx} and {#ry});\n\\node at ({#x},{#y}) {E};",
    ),
    "primitive_nodes": (
        150,
        {"x": "i % 7 - 3", "y": "i * 2 % 7 - 3", "x2": "i % 7 - 1 + i % 3 * 0.5", "y2": "i * 2 % 7 - 3 + i % 2"},
        "Place two labeled nodes and draw an arrow from node A to node B.",
        "\\node[draw, circle] (A) at ({#x},{#y}) {A};\n\\node[draw, circle] (B) at ({#x2},{#y2}) {B};\n\\draw[->] (A) -- (B);",
    ),
    "primitive_axes": (
        90,
        {"x": "2 + i % 4", "y": "2 + (i + 1) % 4"},
        "Draw coordinate axes from the origin with x and y arrow labels.",
        "\\coordinate (O) at (0,0);\n\\coordinate (X) at ({#x},0);\n\\coordinate (Y) at (0,{#y});\n\\draw[->] (O) -- (X) node[right] {$x$};\n\\draw[->] (O) -- (Y) node[above] {$y$};",
    ),
    "primitive_flowchart": (
        60,
        {"y": "i % 5 * 0.1"},
        "Draw a simple three-node flow chart with arrows between the boxes.",
        "\\node[draw, rectangle] (A) at (0,{#y}) {Start};\n\\node[draw, rectangle] (B) at (2,{#y}) {Step};\n\\node[draw, rectangle] (C) at (4,{#y}) {End};\n\\draw[->] (A) -- (B);\n\\draw[->] (B) -- (C);",
    ),
    "mixed_composition": (
        200,
        {
            "s": "i % 13 * 0.07", "xe": "i % 13 * 0.07 + 3 + i % 4 * 0.25", "h": "2 + floor(i / 4) % 4 * 0.2", "cx": "i % 13 * 0.07 + 1", "cy": "1 + floor(i / 13) % 17 * 0.05",
            "rx": "i % 13 * 0.07 + 2.4", "ry": "0.7 + floor(i / 13) % 17 * 0.05", "colour": _turn(COLOURS),
        },
        "Draw a compact scene with axes, a labeled circle, a rectangle, and an arrow.",
        "\\coordinate (O) at ({#s},0);\n\\coordinate (X) at ({#xe},0);\n\\coordinate (Y) at ({#s},{#h});\n\\draw[->] (O) -- (X) node[right] {$x$};\n\\draw[->] (O) -- (Y) node[above] {$y$};\n"
        "\\node[draw, circle] (C) at ({#cx},{#cy}) {C};\n\\node[draw, rectangle] (R) at ({#rx},{#ry}) {R};\n\\draw[->, {colour}] (C) -- (R);",
    ),
}
PRIMITIVES = tuple(name for name in FAMILIES if name.startswith("primitive"))
_HOLE = re.compile(r"\{(#?)([a-z][a-z0-9]*)\}")


def number_sql(value: str, text: str = "string") -> str:
    """SQL of a number with up to two decimals."""
    return f"regexp_replace(regexp_replace(cast(cast({value} as decimal(12,2)) as {text}), '0+$', ''), '[.]$', '')"


def template_sql(template: str, values: dict[str, str], text: str = "string", quote=lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'") -> str:
    """SQL of a template with its values put in."""
    out, at = [], 0
    for m in _HOLE.finditer(template):
        if m[2] not in values:
            continue
        out += [quote(template[at : m.start()]), number_sql(values[m[2]], text) if m[1] else f"({values[m[2]]})"]
        at = m.end()
    return "concat(" + ", ".join([*out, quote(template[at:])]) + ")"


def code_of(body: str) -> str:
    """A picture of a body."""
    return "\\begin{tikzpicture}\n" + body + "\n\\end{tikzpicture}"


def candidates(spark: SparkSession, families: tuple[str, ...] = PRIMITIVES, count: int | None = None) -> DataFrame:
    """(ord, i, category, description, code): the families' rows in order, `count` at most."""
    out, before = None, 0
    for name in families:
        rows, values, description, body = FAMILIES[name]
        rows = max(0, min(rows, rows if count is None else count - before))
        own = spark.range(rows).withColumnRenamed("id", "i").select((F.col("i") + before).alias("ord"), "i", F.lit(name).alias("category"), F.expr(template_sql(description, values)).alias("description"), F.expr(template_sql(code_of(body), values)).alias("code"))
        out = own if out is None else out.union(own)
        before += rows
    return out


def repairs(templates: DataFrame, weights: DataFrame, count: int, most: int = 8) -> DataFrame:
    """(i, pattern, description, code): templates (place, pattern, description, code) by turns, each as often in a turn as its pattern's weight says (1 to `most`).

    From the second turn on the first origin is moved up and the description names the variant.
    """
    weight = F.greatest(F.lit(1), F.least(F.lit(most), F.coalesce(F.max("weight"), F.lit(0))))
    own = templates.join(weights, "pattern", "left").groupBy("place", "pattern", "description", "code").agg(weight.alias("w"))
    spread = own.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("w"))))
    # A handful of templates, eight copies each at most.
    turn = spread.withColumn("k", F.row_number().over(W.orderBy("place", "copy")) - 1).withColumn("n", F.count(F.lit(1)).over(W.partitionBy()))
    rows = templates.sparkSession.range(count).withColumnRenamed("id", "i").join(F.broadcast(turn), F.col("i") % F.col("n") == F.col("k"))
    variant = F.floor(F.col("i") / F.col("n"))
    tenth = (variant % 5).cast("string")
    moved = F.when(variant % 5 == 0, "(0,0)").otherwise(F.concat(F.lit("(0,0."), tenth, F.lit(")")))
    at = F.locate("(0,0)", F.col("code"))
    code = F.when((variant > 0) & (at > 0), F.concat(F.expr("substring(code, 1, locate('(0,0)', code) - 1)"), moved, F.expr("substring(code, locate('(0,0)', code) + 5)"))).otherwise(F.col("code"))
    description = F.when(variant > 0, F.concat("description", F.lit(" Use a compact layout variant "), variant.cast("string"), F.lit("."))).otherwise(F.col("description"))
    return rows.select("i", "pattern", description.alias("description"), code.alias("code"))


def repetition_seeds(spark: SparkSession) -> DataFrame:
    """(sample_id, text): three texts that repeat themselves."""
    rows = (("    >=stealth,", 12), (r"\draw (0,0) -- (1,1);", 6), (r"\node at (0,0) {x};", 24))
    made = spark.createDataFrame([(i, line, n) for i, (line, n) in enumerate(rows)], "i int, line string, n int")
    return made.select(F.concat(F.lit("synthetic_repetition_"), F.lpad("i", 3, "0")).alias("sample_id"), F.array_join(F.array_repeat("line", F.col("n")), "\n").alias("text"))


def sample_id(index: Column, category: Column, description: Column, code: Column) -> Column:
    """16 hex digits of the row number, category, description and code."""
    return F.substring(F.sha2(F.concat_ws("\n", index.cast("string"), category, description, code), 256), 1, 16)


def gated(df: DataFrame, ok: Column, order: str, quota: int) -> DataFrame:
    """The first `quota` rows in order that pass the gate."""
    return df.where(ok).orderBy(order).limit(quota)
