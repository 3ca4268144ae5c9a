"""Text functions as native columns.

White space is the ASCII set, letters and digits are ASCII, and letters are folded
by lower(); the exceptions are named. Every function takes a column and returns one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\t\n\x0B\f\r ]"
# The patterns of the text model.
TOKEN = r"\\[A-Za-z]+|[A-Za-z0-9_]+|[^\t\n\x0B\f\r A-Za-z0-9_]"
COMMAND = r"\\[A-Za-z@]+"
COORDINATE = r"\([\t\n\x0B\f\r ]*\{?[-+]?[0-9]*\.?[0-9]+\}?[\t\n\x0B\f\r ]*,[\t\n\x0B\f\r ]*\{?[-+]?[0-9]*\.?[0-9]+\}?[\t\n\x0B\f\r ]*\)"
ENVIRONMENT = r"(?i)\\begin\{(?:tikzpicture|tikz-cd|tikzcd|circuitikz|axis)\}"
# Ways of reading other files.
EXTERNAL = (r"\\input\{[^}]+\}", r"\\include\{[^}]+\}", r"\\includegraphics(?:\[[^\]]*\])?\{[^}]+\}")
# Words that tell of a drawing.
GEOMETRIC = (
    "circle", "rectangle", "square", "triangle", "arrow", "node", "edge", "path", "curve", "line", "axis", "plot", "graph", "diagram", "label", "coordinate",
    "angle", "arc", "grid", "polygon", "matrix", "color", "fill", "draw", "shape", "point", "segment", "vector", "map", "tree", "flow",
)
# Name, pattern, most occurrences allowed.
BAD_PATTERNS = (
    ("repeated_preview_environment", r"\\PreviewEnvironment", 0),
    ("zero_geometric", r"0\.geometric", 0),
    ("decorations_geometric_loop", r"decorations\.geometric", 5),
    ("assistant_usepackage", r"\\usepackage", 0),
    ("assistant_documentclass", r"\\documentclass", 0),
    ("opening_latex_fence", r"```latex", 0),
    ("repeated_draw_node_excessive", r"\\(?:draw|node|path)", 100),
    ("consecutive_backslashes", r"\\{4,}", 0),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once: inside a lambda a column's expression would run again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, rf"\A{WS}+|{WS}+\z", "")


def filled(text: Column) -> Column:
    """The stripped text, null if nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def without_comments(text: Column) -> Column:
    """Without what follows an unescaped percent sign on a line."""
    return F.regexp_replace(text, r"(?md)(?<!\\)%.*$", "")


def normalised(text: Column) -> Column:
    """Comments gone, white space collapsed, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(without_comments(text), rf"{WS}+", " ")))


def tokens(text: Column) -> Column:
    """Commands, words and single symbols."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def words(text: Column) -> Column:
    """Runs without white space."""
    return F.regexp_extract_all(text, F.lit(r"[^\t\n\x0B\f\r ]+"), F.lit(0))


def commands(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(COMMAND), F.lit(0))


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def ngrams(items: Column, n: int) -> Column:
    """All runs of n neighbours, joined by spaces; none if there are fewer items."""

    def runs(own: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size(own) - (n - 1)), lambda i: F.array_join(F.slice(own, i, n), " "))
        return F.when(F.size(own) >= n, every).otherwise(F.array().cast("array<string>"))

    return let(items, runs)


def shingles(items: Column, n: int) -> Column:
    """The distinct n-grams."""
    return F.array_distinct(ngrams(items, n))


def diversity(items: Column, n: int) -> Column:
    """Distinct n-grams by all n-grams; 1 for n or fewer items."""
    share = lambda grams: F.when(F.size(grams) <= 1, F.lit(1.0)).otherwise(F.size(F.array_distinct(grams)) / F.size(grams))
    return let(ngrams(items, n), share)


def lines(text: Column) -> Column:
    """Stripped lines that are not blank."""
    return F.filter(F.transform(F.split(text, r"\r\n|[\n\r\x0B\f]"), strip), lambda x: x != "")


def longest_run(items: Column) -> Column:
    """The most equal neighbours in a row."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(s: Column, x: Column) -> Column:
        run = F.when(s["last"].eqNullSafe(x), s["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(s["most"], run).alias("most"))

    return F.aggregate(items, start, step, lambda s: s["most"])


def most_common(items: Column) -> Column:
    """struct(item, n): the most frequent item, the one seen first of several; null without items."""


    def counted(own: Column) -> Column:
        return F.array_max(F.transform(F.array_distinct(own), lambda k, i: F.struct(F.size(F.filter(own, lambda x: x == k)).alias("n"), (-i).alias("first"), k.alias("item"))))

    return let(items, counted)


def dominant_ratio(items: Column) -> Column:
    """The share of the most frequent item; 0 without items."""
    return let(items, lambda own: F.when(F.size(own) > 0, most_common(own)["n"] / F.size(own)).otherwise(F.lit(0.0)))


def reasons(*pairs: tuple[str, Column]) -> Column:
    """The names whose conditions hold, in order."""
    return F.array_compact(F.array(*(F.when(held, F.lit(name)) for name, held in pairs)))


def balance(text: Column, left: str, right: str) -> Column:
    """Openers minus closers."""
    return F.length(F.replace(text, F.lit(right), F.lit(""))) - F.length(F.replace(text, F.lit(left), F.lit("")))


def unbalanced(text: Column, left: str, right: str) -> Column:
    """Whether a pair of brackets does not close, or closes before it opens."""
    marks = F.regexp_extract_all(text, F.lit(f"[\\{left}\\{right}]"), F.lit(0))

    def step(s: Column, x: Column) -> Column:
        now = s["now"] + F.when(x == left, 1).otherwise(-1)
        return F.struct(now.alias("now"), F.least(s["low"], now).alias("low"))

    return F.aggregate(marks, F.struct(F.lit(0).alias("now"), F.lit(0).alias("low")), step, lambda s: (s["now"] != 0) | (s["low"] < 0))


def bad_patterns(text: Column) -> Column:
    """Rules that are broken."""
    return reasons(*((name, count(text, pattern) > most) for name, pattern, most in BAD_PATTERNS))


def boilerplate(text: Column) -> Column:
    """Half for each collapse marker, a fifth for each preamble marker, and twice what one command has over two fifths."""
    heavy: Column = sum((count(text, p) for p in (r"\\PreviewEnvironment", r"0\.geometric", r"decorations\.geometric")), F.lit(0))
    light = sum((count(text, p) for p in (r"\\usepackage", r"\\documentclass", r"\\begin\{document\}", r"\\end\{document\}")), F.lit(0))
    ratio = dominant_ratio(commands(text))
    return heavy * F.lit(0.5) + light * F.lit(0.2) + F.when(ratio > 0.4, (ratio - 0.4) * 2).otherwise(F.lit(0.0))


# Commands that draw, and those of a preamble.
DRAWING = ("\\draw", "\\node", "\\path", "\\fill", "\\filldraw", "\\coordinate", "\\addplot")
PREAMBLE = ("\\documentclass", "\\usepackage", "\\usetikzlibrary", "\\PreviewEnvironment")


def substance(text: Column) -> Column:
    """struct of the parts of the substance score, the score and whether it reaches 0.75."""
    own = commands(text)
    drawing, preamble = F.size(F.filter(own, lambda c: c.isin(*DRAWING))), F.size(F.filter(own, lambda c: c.isin(*PREAMBLE)))
    share = F.when(F.size(own) > 0, (F.size(own) - preamble) / F.size(own)).otherwise(F.lit(1.0))
    ratio = dominant_ratio(own)
    parts = (
        (text.rlike(ENVIRONMENT), 25), (drawing >= 2, 25), (count(text, COORDINATE) >= 2, 15), (share >= 0.70, 20), (ratio <= 0.40, 10), (F.size(bad_patterns(text)) == 0, 5),
    )
    points = sum((F.when(held, F.lit(n)).otherwise(F.lit(0)) for held, n in parts), F.lit(0))
    return F.struct(drawing.alias("drawing"), preamble.alias("preamble"), count(text, COORDINATE).alias("coordinates"), share.alias("share"), ratio.alias("dominant"), (points / 100).alias("score"), (points >= 75).alias("passed"))


def description_score(text: Column) -> Column:
    """0 for under 5 words, under 20 characters or over 400 words; else half by length, half by geometric terms."""
    own = strip(text)
    n = F.size(words(own))
    terms = count(own, r"(?i)\b(?:" + "|".join(GEOMETRIC) + r")\b")
    score = F.least(F.lit(1.0), n / 30) * 0.5 + F.least(F.lit(0.5), terms * F.lit(0.1))
    return F.when(own.isNull() | (n < 5) | (F.length(own) < 20) | (n > 400), F.lit(0.0)).otherwise(score)


def generation_mode(text: Column) -> Column:
    """The kind of figure; the first rule that holds."""
    return (
        F.when(text.rlike(r"(?i)\\begin\{axis\}") | text.rlike(r"\\addplot\b"), "pgfplots_axis")
        .when(text.rlike(r"(?i)\\begin\{tikzcd\}|\\begin\{tikz-cd\}"), "commutative_diagram")
        .when(text.rlike(r"\\graph[\t\n\x0B\f\r ]*(?:\[|\{)"), "graph_nodes")
        .when(text.rlike(r"(?i)\\begin\{circuitikz\}"), "scientific_schematic")
        .otherwise("plain_tikz")
    )


def primary_environment(text: Column) -> Column:
    """The first of three environments that occurs."""
    return F.coalesce(*(F.when(F.contains(text, F.lit(f"\\begin{{{e}}}")), F.lit(e)) for e in ("tikzpicture", "tikz-cd", "circuitikz")))


def libraries(text: Column) -> Column:
    """Sorted distinct names that library commands load."""
    lists = F.regexp_extract_all(text, F.lit(r"\\usetikzlibrary\{([^}]+)\}"), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.array_join(lists, ","), ","), strip), lambda x: x != "")))


# Points of rarer libraries; any other counts 0.1.
LIBRARY_POINTS = {
    "petri": 3.0, "circuits": 3.0, "circuits.ee.IEC": 3.0, "circuits.logic.US": 3.0, "er": 3.0, "datavisualization": 3.0, "mindmap": 3.0, "spy": 2.5, "fadings": 2.5,
    "decorations.fractals": 2.5, "lindenmayersystems": 2.5, "3d": 2.0, "perspective": 2.0, "hobby": 2.0, "automata": 2.0, "intersections": 1.5, "through": 1.5, "shadows": 1.5,
    "decorations.markings": 1.5, "decorations.pathreplacing": 1.5,
}


def pedagogical(text: Column) -> Column:
    """1, plus points of each loaded library, 0.5 for computed and 0.3 for named coordinates, halved if all is drawn by one command; 0 to 5."""
    lists = F.regexp_extract_all(text, F.lit(r"\\usetikzlibrary\{([^}]+)\}"), F.lit(1))
    names = F.when(F.size(lists) > 0, F.transform(F.split(F.array_join(lists, ","), ","), strip)).otherwise(F.array().cast("array<string>"))
    points = F.create_map(*(F.lit(x) for pair in LIBRARY_POINTS.items() for x in pair))
    loaded = F.aggregate(names, F.lit(0.0), lambda s, x: s + F.coalesce(F.try_element_at(points, x), F.lit(0.1)))
    drawn = F.array_distinct(F.regexp_extract_all(text, F.lit(r"\\(draw|fill|filldraw|node|path|coordinate|addplot)\b"), F.lit(1)))
    score = 1 + loaded + F.when(text.rlike(r"\(\$[^)]+\$\)"), 0.5).otherwise(0.0) + F.when(text.rlike(r"\\node[\t\n\x0B\f\r ]*\("), 0.3).otherwise(0.0)
    return F.least(F.lit(5.0), score * F.when((F.size(drawn) == 1) & (drawn[0] == "draw"), 0.5).otherwise(1.0))


def bounding_box(text: Column) -> Column:
    """struct(min_x, min_y, max_x, max_y) of the plain coordinates, to 2 places; null without any."""
    pattern = r"\([\t\n\x0B\f\r ]*(-?[0-9]+(?:\.[0-9]+)?)[\t\n\x0B\f\r ]*,[\t\n\x0B\f\r ]*(-?[0-9]+(?:\.[0-9]+)?)[\t\n\x0B\f\r ]*\)"
    x, y = (F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(g)), lambda v: v.cast("double")) for g in (1, 2))
    box = F.struct(*(F.bround(f(v), 2).alias(n) for n, f, v in (("min_x", F.array_min, x), ("min_y", F.array_min, y), ("max_x", F.array_max, x), ("max_y", F.array_max, y))))
    return F.when(F.size(x) > 0, box)


def external(text: Column) -> Column:
    """Whether the text pulls in other files."""
    return text.rlike("|".join(EXTERNAL))


def canonical(text: Column) -> Column:
    """One standalone document class, one document body, nothing around them, no fence."""
    own = strip(text)
    klass, body, end = r"(?i)\\documentclass[\t\n\x0B\f\r ]*\[tikz\][\t\n\x0B\f\r ]*\{standalone\}", r"(?i)\\begin\{document\}", r"(?i)\\end\{document\}"
    once = (count(own, klass) == 1) & (count(own, r"(?i)\\documentclass\b") == 1) & (count(own, body) == 1) & (count(own, end) == 1)
    placed = own.rlike(r"(?is)\A\\documentclass[\t\n\x0B\f\r ]*\[tikz\][\t\n\x0B\f\r ]*\{standalone\}.*\\begin\{document\}.*\\end\{document\}\z")
    return (own != "") & ~F.contains(own, F.lit("```")) & once & placed


def loop_token(token: Column) -> Column:
    """A token with its options, numbers and plain coordinates replaced by marks."""
    out = F.regexp_replace(token, r"\\draw\[[^\]]*\]", r"\\draw[<OPT>]")
    out = F.regexp_replace(out, r"-?[0-9]+(?:\.[0-9]+)?", "<NUM>")
    return F.regexp_replace(out, r"\(<NUM>,<NUM>\)", "(<COORD>)")


# Tokens that may make up much of a text.
ALLOWED_DOMINANT = ("--", ";", ",", "(", ")", "{", "}")


def collapse(text: Column) -> Column:
    """Signs of collapsed generation, in order."""

    def signs(p: Column) -> Column:
        own, loops, stems = p["own"], p["loops"], p["stems"]
        enough = F.size(own) >= 20
        return reasons(
            ("preview_environment", F.contains(text, F.lit("\\PreviewEnvironment"))),
            ("usepackage", F.contains(text, F.lit("\\usepackage"))),
            ("documentclass", F.contains(text, F.lit("\\documentclass"))),
            ("repetition_loop", longest_run(lines(text)) >= 5),
            ("low_bigram_diversity", enough & (diversity(own, 2) < 0.20)),
            ("low_loop_bigram_diversity", enough & (diversity(loops, 2) < 0.20)),
            ("low_loop_trigram_diversity", enough & (diversity(loops, 3) < 0.25)),
            ("command_dominance", enough & (F.size(stems) >= 10) & (dominant_ratio(stems) > 0.85) & (diversity(loops, 2) < 0.35)),
            ("unigram_dominance", enough & (dominant_ratio(own) > 0.30) & ~most_common(own)["item"].isin(*ALLOWED_DOMINANT)),
        )

    parts = let(words(text), lambda own: F.struct(own.alias("own"), F.transform(own, loop_token).alias("loops")))
    return let(parts, lambda p: signs({"own": p["own"], "loops": p["loops"], "stems": commands(text)}))


def critic(text: Column, mode: Column) -> Column:
    """Violations that need no compiler."""
    own = without_comments(text)
    low = F.lower(own)
    keys = own.rlike(r"(?i)\b(?:axis\s+[xy]\s+line\*?|xmin|xmax|ymin|ymax|xtick|ytick|xlabel|ylabel|legend\s+(?:entries|pos))\b") | own.rlike(r"\\addplot\b")
    axis = count(own, r"(?i)\\begin\{([a-zA-Z]*axis|groupplot)\}")
    rows = lines(own)
    far = F.exists(F.flatten(F.array(*(F.regexp_extract_all(own, F.lit(r"\((-?[0-9]+\.?[0-9]*),[\t\n\x0B\f\r ]*(-?[0-9]+\.?[0-9]*)\)"), F.lit(g)) for g in (1, 2)))), lambda v: F.abs(v.cast("double")) > 1000)
    fences = count(own, "```")
    has = lambda *marks: F.reduce(F.array(*(F.contains(low, F.lit(m)) for m in marks)), F.lit(False), lambda a, b: a | b)
    return reasons(
        ("unbalanced_braces", balance(own, "{", "}") != 0),
        ("pgfplots_keys_in_plain_tikz", (mode == "plain_tikz") & keys & (axis == 0)),
        ("missing_axis_environment", (mode == "pgfplots_axis") & (axis == 0)),
        ("missing_tikzcd_environment", (mode == "commutative_diagram") & ~own.rlike(r"(?i)\\begin\{(?:tikzcd|tikz-cd)\}")),
        ("legacy_tikzstyle", own.rlike(r"\\tikzstyle\b")),
        ("nested_or_duplicate_axis_environment", axis > 1),
        ("repetition_collapse", (F.size(rows) > 10) & (dominant_ratio(rows) > 0.5)),
        ("coordinate_out_of_range", (axis == 0) & far),
        ("unclosed_code_fence", (fences >= 3) & (fences % 2 != 0)),
        ("near_empty_completion", F.length(strip(own)) < 20),
        ("html_xml_contamination", has("<html", "<?xml", "<div")),
        ("python_code_contamination", has("import matplotlib", "import numpy", "def plot")),
        ("absolute_page_positioning", has("current page.", "(current page)")),
        ("base64_data_contamination", has("data:image") | own.rlike(r"[A-Za-z0-9+/]{100,}={0,2}")),
        ("unclosed_environment", count(low, r"\\begin\{") != count(low, r"\\end\{")),
    )


def contract(user: Column, assistant: Column, users: Column, assistants: Column) -> Column:
    """Violations of the prompt contract: texts by role and how many messages each role has."""
    marker = "--- Starting Preamble ---"
    return reasons(
        ("user_count_not_one", users != 1),
        ("assistant_count_not_one", assistants != 1),
        ("opening_latex_fence_count", count(user, "```latex") != 1),
        ("user_documentclass", user.rlike(r"\\documentclass(?:\[[^\]]*\])?\{")),
        ("user_begin_document", user.rlike(r"\\begin\{document\}")),
        ("user_end_document", user.rlike(r"\\end\{document\}")),
        ("user_usepackage", user.rlike(r"\\usepackage(?:\[[^\]]*\])?\{")),
        ("user_preview_environment", user.rlike(r"\\PreviewEnvironment\{")),
        ("user_usetikzlibrary", user.rlike(r"\\usetikzlibrary\{")),
        ("user_preamble_marker", F.contains(user, F.lit(marker))),
        ("closing_fence_count", count(assistant, "```") != 1),
        ("assistant_env_start", ~assistant.rlike(r"(?i)\A[\t\n\x0B\f\r ]*\\begin\{(?:tikzpicture|tikz-cd|tikzcd|circuitikz|axis|tikzpicture\*)\}")),
        *((f"assistant_{name}", F.contains(assistant, F.lit(text))) for name, text in (
            ("documentclass", "\\documentclass"), ("begin_document", "\\begin{document}"), ("end_document", "\\end{document}"), ("usepackage", "\\usepackage"),
            ("preview_environment", "\\PreviewEnvironment"), ("usetikzlibrary", "\\usetikzlibrary"), ("preamble_marker", marker), ("opening_latex_fence", "```latex"))),
    )


def edit_distance(left: Column, right: Column) -> Column:
    """Levenshtein distance of two token arrays: each distinct token of the pair (20,000 at most) becomes one character."""

    def distance(kinds: Column) -> Column:
        as_text = lambda items: F.array_join(F.transform(items, lambda t: F.decode(F.unhex(F.lpad(F.hex(F.array_position(kinds, t) + 0x4E00), 4, "0")), "UTF-16BE")), "")
        return F.levenshtein(as_text(left), as_text(right))

    return let(F.array_distinct(F.concat(left, right)), distance)


def jaccard(left: Column, right: Column) -> Column:
    """Of two sets as arrays: 1 if both are empty."""
    both = F.size(F.array_union(left, right))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(left, right)) / both)


def last_fence(text: Column) -> Column:
    """The last fenced block, or the whole text, stripped."""
    blocks = F.regexp_extract_all(text, F.lit(r"(?is)```(?:latex)?[\t\n\x0B\f\r ]*(.*?)```"), F.lit(1))
    return strip(F.when(F.size(blocks) > 0, F.element_at(blocks, -1)).otherwise(text))


def longest_fence(text: Column) -> Column:
    """The longest fenced block, the first of several; null without any."""
    blocks = F.regexp_extract_all(text, F.lit(r"(?is)```(?:[a-zA-Z]+)?[\t\n\x0B\f\r ]*(.*?)```"), F.lit(1))
    return F.array_max(F.transform(blocks, lambda b, i: F.struct(F.length(b).alias("n"), (-i).alias("first"), strip(b).alias("block"))))["block"]
