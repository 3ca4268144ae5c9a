"""Which packages, libraries and dialects a figure's code needs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

# A pattern of the code, the package it needs.
PACKAGE_RULES = (
    (r"\\begin\{tikz-cd\}|\\begin\{tikzcd\}|\\arrow\b", r"\usepackage{tikz-cd}"),
    (r"\\begin\{circuitikz\}|to\[[^\]]*(?:resistor|capacitor|inductor|diode|battery|ground|lamp|voltage|current|\b[RLCDVI]\b)", r"\usepackage{circuitikz}"),
    (r"\\begin\{axis\}|\\begin\{semilog[xy]axis\}|\\addplot\b|\\pgfplotsset\b|\\pgfplotstable", r"\usepackage{pgfplots}"),
    (r"\\pgfplotstable", r"\usepackage{pgfplotstable}"),
    (r"\\(?:mathbb|mathcal|mathfrak|operatorname|text|dfrac|tfrac|binom)\b|\\begin\{(?:align|aligned|gather|cases|pmatrix|bmatrix|matrix)\}", r"\usepackage{amsmath}"),
    (r"\\(?:mathbb|mathfrak|varnothing|leqslant|geqslant|nleq|ngeq)\b", r"\usepackage{amssymb}"),
    (r"\\(?:definecolor|colorlet)\b|(?:draw|fill|text|color)[\t\n\x0B\f\r ]*=[\t\n\x0B\f\r ]*\{?[A-Za-z]+![0-9]+", r"\usepackage{xcolor}"),
)
# A pattern of the code, the library it needs.
LIBRARY_RULES = (
    (r"\([\t\n\x0B\f\r ]*\$|\\path[\t\n\x0B\f\r ]+let\b|\\pgfmathsetmacro\b|\\veclen\b|\bcoordinate[\t\n\x0B\f\r ]+calculation\b", "calc"),
    (r"\b(?:above|below|left|right|above left|above right|below left|below right)[\t\n\x0B\f\r ]*=[\t\n\x0B\f\r ]*(?:of|[0-9.]+[^,]*[\t\n\x0B\f\r ]+of)\b|\bnode distance[\t\n\x0B\f\r ]*=", "positioning"),
    (r"(?:->|<-|<->|-Stealth|-Latex|-Triangle|>=[\t\n\x0B\f\r ]*(?:Latex|Stealth|Triangle)|\{(?:Latex|Stealth|Triangle))", "arrows.meta"),
    (r"\b(?:diamond|trapezium|regular polygon|star|cloud|dart|kite|cylinder|ellipse split)\b", "shapes.geometric"),
    (r"\bname intersections\b|\\path[\t\n\x0B\f\r ]*\[.*\bname path\b", "intersections"),
    (r"\bdecorate\b|decoration[\t\n\x0B\f\r ]*=[\t\n\x0B\f\r ]*\{?[\t\n\x0B\f\r ]*(?:brace|calligraphic brace)", "decorations.pathreplacing"),
    (r"\bmarkings\b|mark[\t\n\x0B\f\r ]*=[\t\n\x0B\f\r ]*at position|postaction[\t\n\x0B\f\r ]*=[\t\n\x0B\f\r ]*\{?[\t\n\x0B\f\r ]*decorate", "decorations.markings"),
    (r"\bon background layer\b|\\begin\{pgfonlayer\}|\\pgfdeclarelayer\b|\\pgfsetlayers\b", "backgrounds"),
    (r"\bedge[\t\n\x0B\f\r ]+node[\t\n\x0B\f\r ]*\{|\bedge[\t\n\x0B\f\r ]*\[.*\][\t\n\x0B\f\r ]*\"", "quotes"),
    (r"\bfit[\t\n\x0B\f\r ]*=", "fit"),
    (r"\\matrix\b|\\begin\{matrix\}|\bmatrix of nodes\b", "matrix"),
    (r"\bpattern[\t\n\x0B\f\r ]*=", "patterns"),
    (r"\bthrough[\t\n\x0B\f\r ]*=", "through"),
    (r"\.\.[\t\n\x0B\f\r ]+controls\b|\\draw[\t\n\x0B\f\r ]*\[.*\bhobby\b|\bclosed hobby\b", "hobby"),
)
# What every figure needs, and what a package brings with it.
ALWAYS = (r"\usepackage[active,tightpage]{preview}", r"\usepackage{tikz}", r"\PreviewEnvironment{tikzpicture}")
BROUGHT = {
    r"\usepackage{tikz-cd}": (r"\PreviewEnvironment{tikz-cd}",),
    r"\usepackage{circuitikz}": (r"\PreviewEnvironment{circuitikz}",),
    r"\usepackage{pgfplots}": (r"\PreviewEnvironment{axis}", r"\PreviewEnvironment{semilogxaxis}", r"\PreviewEnvironment{semilogyaxis}", r"\pgfplotsset{compat=1.18}"),
}
# A flag, its pattern.
DIALECTS = (
    ("pgfplots", r"(?i)\b(?:axis[\t\n\x0B\f\r ]+[xy][\t\n\x0B\f\r ]+line\*?|xmin|xmax|ymin|ymax|xtick|ytick|xlabel|ylabel|legend[\t\n\x0B\f\r ]+(?:entries|pos))\b|\\addplot\b"),
    ("legacy_tikzstyle", r"\\tikzstyle\b"),
    ("graph_syntax", r"\\graph[\t\n\x0B\f\r ]*(?:\[|\{)"),
    ("tikz_cd", r"(?i)\\begin\{(?:tikzcd|tikz-cd)\}"),
)


def _fitting(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    return F.array_compact(F.array(*(F.when(text.rlike(pattern), F.lit(name)) for pattern, name in rules)))


def required_libraries(text: Column) -> Column:
    """Sorted names of libraries that the code loads or its patterns ask for."""
    return F.array_sort(F.array_union(T.libraries(text), _fitting(text, LIBRARY_RULES)))


def required_packages(text: Column) -> Column:
    """Preamble lines: the preview package, the other packages in order, then settings and libraries in order."""
    named = F.split(F.array_join(F.regexp_extract_all(text, F.lit(r"\\usepackage(?:\[[^\]]+\])?\{([^}]+)\}"), F.lit(1)), ","), ",")
    loaded = F.transform(F.filter(F.transform(named, T.strip), lambda x: x != ""), lambda x: F.concat(F.lit(r"\usepackage{"), x, F.lit("}")))
    packages = F.array_union(F.array_union(F.array(*map(F.lit, ALWAYS)), loaded), _fitting(text, PACKAGE_RULES))

    def whole(own: Column) -> Column:
        brought = F.flatten(F.array(*(F.when(F.array_contains(own, package), F.array(*map(F.lit, lines))).otherwise(F.array().cast("array<string>")) for package, lines in BROUGHT.items())))
        names = required_libraries(text)
        setting = F.when(F.size(names) > 0, F.array(F.concat(F.lit(r"\usetikzlibrary{"), F.array_join(names, ", "), F.lit("}")))).otherwise(F.array().cast("array<string>"))
        rest = F.array_sort(F.array_union(F.array_union(own, brought), setting))
        is_package = lambda x: x.startswith(F.lit(r"\usepackage"))
        return F.concat(F.array(F.lit(ALWAYS[0])), F.filter(rest, lambda x: is_package(x) & (x != ALWAYS[0])), F.filter(rest, lambda x: ~is_package(x)))

    return T.let(packages, whole)


def dialect_flags(text: Column) -> Column:
    """Which dialects the code uses."""
    return _fitting(text, tuple((pattern, name) for name, pattern in DIALECTS))
