"""Quality rules, critics and features of record texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import profiles as P
from ..operators import records as R
from .base import query, table
from .records import CODES, codes

WS = r"[\t\n\x0B\f\r ]"
COMMANDS = r"regexp_extract_all(code, '\\[A-Za-z@]+')"


def _n(pattern: str, text: str = "code") -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def _list(*pairs: tuple[str, str]) -> str:
    """SQL of the comma-joined names whose conditions hold."""
    return "array_to_string(list_filter([" + ", ".join(f"case when {held} then '{name}' end" for name, held in pairs) + "], lambda x: x is not null), ',')"


def _top(items: str) -> str:
    """SQL of the share of the most frequent item of a list."""
    return f"case when len({items}) > 0 then list_max(list_transform(list_distinct({items}), lambda k: len(list_filter({items}, lambda x: x = k))))::double / len({items}) else 0.0 end"


def _run(items: str) -> str:
    """SQL of the longest run of equal neighbours of a list."""
    return f"case when len({items}) = 0 then 0 else list_max(list_transform(range(1, len({items}) + 1), lambda i: i - list_max(list_filter(range(1, i + 1), lambda j: j = 1 or {items}[j] <> {items}[j - 1])) + 1)) end"


_LINES = rf"list_filter(list_transform(regexp_split_to_array(code, '\r\n|[\n\r\x0B\f]'), lambda x: regexp_replace(x, '\A{WS}+|{WS}+\z', '', 'g')), lambda x: x <> '')"
BAD = [(name, f"{_n(pattern)} > {most}") for name, pattern, most in T.BAD_PATTERNS]
_ENV = r"regexp_matches(code, '(?i)\\begin\{(?:tikzpicture|tikz-cd|tikzcd|circuitikz|axis)\}')"
_COORD = r"\([\t\n\x0B\f\r ]*\{?[-+]?[0-9]*\.?[0-9]+\}?[\t\n\x0B\f\r ]*,[\t\n\x0B\f\r ]*\{?[-+]?[0-9]*\.?[0-9]+\}?[\t\n\x0B\f\r ]*\)"


@query("""select doc_id, """ + _list(("too_short", "length(text) < 100"), ("too_long", "length(text) > 4000"), ("language", "lang not in ('en', 'de', 'fr')"), ("external_dependency", r"regexp_matches(text, '\\input\{[^}]+\}|\\include\{[^}]+\}|\\includegraphics(?:\[[^\]]*\])?\{[^}]+\}')")) + " as reasons from documents")
def length_bounds_reasons(spark, sf_dir):
    n, text = F.length("text"), F.col("text")
    found = T.reasons(("too_short", n < 100), ("too_long", n > 4000), ("language", ~F.col("lang").isin("en", "de", "fr")), ("external_dependency", T.external(text)))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(found, ",").alias("reasons"))


@query(f"with {CODES} select sample_id, {_list(*BAD)} as violations from codes")
def bad_pattern_counts(spark, sf_dir):
    return codes(spark, sf_dir).select("sample_id", F.array_join(T.bad_patterns(F.col("code")), ",").alias("violations"))


@query(rf"""with {CODES}, l as (select sample_id, code, {_LINES} l, {COMMANDS} c from codes)
select sample_id, {_n('>=[\t\n\x0B\f\r ]*[sS]tealth,')}::bigint as stealth, {_run('l')}::int as line_run, len(c)::int as commands, round({_top('c')}, 6) as dominant,
{_n('>=[\t\n\x0B\f\r ]*[sS]tealth,')} >= 10 or {_run('l')} >= 5 as failed from l""")
def repetition_features(spark, sf_dir):
    own = codes(spark, sf_dir)
    stealth, run, found = T.count(F.col("code"), r">=[\t\n\x0B\f\r ]*[sS]tealth,"), T.longest_run(T.lines(F.col("code"))), T.commands(F.col("code"))
    return own.select("sample_id", stealth.alias("stealth"), run.alias("line_run"), F.size(found).alias("commands"), F.round(T.dominant_ratio(found), 6).alias("dominant"), ((stealth >= 10) | (run >= 5)).alias("failed"))


def _open(left: str, right: str) -> str:
    marks = rf"regexp_extract_all(code, '[\{left}\{right}]')"
    sums = f"list_transform(range(1, len({marks}) + 1), lambda i: len(list_filter(list_slice({marks}, 1, i), lambda x: x = '{left}')) - len(list_filter(list_slice({marks}, 1, i), lambda x: x = '{right}')))"
    return f"(len({marks}) > 0 and (list_last({sums}) <> 0 or list_min({sums}) < 0))".replace("list_last", "list_extract").replace(f"list_extract({sums})", f"list_extract({sums}, -1)")


STRUCTURE = [("unbalanced_braces", _open("{", "}")), ("unbalanced_brackets", _open("[", "]")), ("unbalanced_parentheses", _open("(", ")"))]


@query(f"with {CODES} select sample_id, {_list(*STRUCTURE)} as violations from codes")
def structure_violations(spark, sf_dir):
    found = T.reasons(*((name, T.unbalanced(F.col("code"), a, b)) for name, a, b in (("unbalanced_braces", "{", "}"), ("unbalanced_brackets", "[", "]"), ("unbalanced_parentheses", "(", ")"))))
    return codes(spark, sf_dir).select("sample_id", F.array_join(found, ",").alias("violations"))


_STEALTH = _n(r">=[\t\n\x0B\f\r ]*[sS]tealth,")
_PRECISE = r"len(list_filter(l, lambda x: regexp_matches(x, '-?[0-9]+\.[0-9]{4,}')))::double / greatest(len(l), 1) > 0.40"
QUALITY = [("missing_tikz_environment", "not " + _ENV), ("token_length_exceeds_max", "length(code) > 600"), ("stealth_loop", f"{_STEALTH} >= 10"), ("repeated_line_loop", f"{_run('l')} >= 5"), ("high_precision_numeric_poisoning", _PRECISE), *STRUCTURE]


def quality_reasons(code, length, most):
    """Reasons of the quality filter: environment, length, loops, numeric noise, structure."""
    own = T.lines(code)
    precise = F.size(F.filter(own, lambda x: x.rlike(r"-?[0-9]+\.[0-9]{4,}"))) / F.greatest(F.size(own), F.lit(1))
    return T.reasons(
        ("missing_tikz_environment", ~code.rlike(T.ENVIRONMENT)), ("token_length_exceeds_max", length > most), ("stealth_loop", T.count(code, r">=[\t\n\x0B\f\r ]*[sS]tealth,") >= 10),
        ("repeated_line_loop", T.longest_run(own) >= 5), ("high_precision_numeric_poisoning", precise > 0.40),
        *((name, T.unbalanced(code, a, b)) for name, a, b in (("unbalanced_braces", "{", "}"), ("unbalanced_brackets", "[", "]"), ("unbalanced_parentheses", "(", ")"))),
    )


_Q = f"{CODES}, l as (select *, {_LINES} l from codes), q as (select sample_id, source, {_list(*QUALITY)} as reasons from l)"


def _filtered(spark, sf_dir):
    return codes(spark, sf_dir).select("sample_id", "source", quality_reasons(F.col("code"), F.length("code"), 600).alias("reasons"))


@query(f"with {_Q} select sample_id, reasons from q")
def quality_filter(spark, sf_dir):
    return _filtered(spark, sf_dir).select("sample_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"with {_Q} select source, count(*) total, count(*) filter (reasons = '') as kept, count(*) filter (reasons <> '') as rejected from q group by 1")
def quality_audit_by_mode(spark, sf_dir):
    return P.audit(_filtered(spark, sf_dir), "reasons", "source")


@query(f"with {_Q} select r as reason, count(*) n from (select unnest(string_split(reasons, ',')) r from q where reasons <> '') group by 1")
def reject_reason_counts(spark, sf_dir):
    return P.reason_counts(_filtered(spark, sf_dir), "reasons")


_GEO = "circle|rectangle|square|triangle|arrow|node|edge|path|curve|line|axis|plot|graph|diagram|label|coordinate|angle|arc|grid|polygon|matrix|color|fill|draw|shape|point|segment|vector|map|tree|flow"


@query(rf"""with s as (select item_id, regexp_replace(text, '\A{WS}+|{WS}+\z', '', 'g') t from (select item_id, text || case when item_id % 3 = 0 then ' a circle and an arrow on the graph' else '' end as text from benchmark)),
w as (select *, len(regexp_extract_all(t, '[^\t\n\x0B\f\r ]+')) n, len(regexp_extract_all(t, '(?i)\b(?:{_GEO})\b')) g from s)
select item_id, round(case when n < 5 or length(t) < 20 or n > 400 then 0.0 else least(1.0, n / 30) * 0.5 + least(0.5, g * 0.1) end, 6) as score from w""")
def description_quality(spark, sf_dir):
    text = F.concat("text", F.when(F.col("item_id") % 3 == 0, " a circle and an arrow on the graph").otherwise(""))
    return table(spark, sf_dir, "benchmark").select("item_id", F.round(T.description_score(text), 6).alias("score"))


_LIBS = r"list_filter(list_transform(string_split(array_to_string(regexp_extract_all(code, '\\usetikzlibrary\{([^}]+)\}', 1), ','), ','), lambda x: trim(x)), lambda x: x <> '')"
_MODE = r"""case when regexp_matches(code, '(?i)\\begin\{axis\}') or regexp_matches(code, '\\addplot\b') then 'pgfplots_axis' when regexp_matches(code, '(?i)\\begin\{tikzcd\}|\\begin\{tikz-cd\}') then 'commutative_diagram'
when regexp_matches(code, '\\graph[\t\n\x0B\f\r ]*(?:\[|\{)') then 'graph_nodes' when regexp_matches(code, '(?i)\\begin\{circuitikz\}') then 'scientific_schematic' else 'plain_tikz' end"""
_XY = r"\([\t\n\x0B\f\r ]*(-?[0-9]+(?:\.[0-9]+)?)[\t\n\x0B\f\r ]*,[\t\n\x0B\f\r ]*(-?[0-9]+(?:\.[0-9]+)?)[\t\n\x0B\f\r ]*\)"


@query(rf"""with {CODES} select sample_id, {_MODE} as mode, array_to_string(list_sort(list_distinct({_LIBS})), ',') as libraries,
round_even(list_min(list_transform(regexp_extract_all(code, '{_XY}', 1), lambda v: v::double)), 2) as min_x, round_even(list_max(list_transform(regexp_extract_all(code, '{_XY}', 2), lambda v: v::double)), 2) as max_y,
regexp_matches(code, '\\input\{{[^}}]+\}}|\\include\{{[^}}]+\}}|\\includegraphics(?:\[[^\]]*\])?\{{[^}}]+\}}') as external from codes""")
def geometry_hints(spark, sf_dir):
    code = F.col("code")
    return codes(spark, sf_dir).select("sample_id", T.generation_mode(code).alias("mode"), F.array_join(T.libraries(code), ",").alias("libraries"), T.bounding_box(code)["min_x"].alias("min_x"), T.bounding_box(code)["max_y"].alias("max_y"), T.external(code).alias("external"))


@query(rf"""with {CODES}, p as (select *, case when regexp_matches(code, '\\usetikzlibrary\{{') then list_sum(list_transform({_LIBS}, lambda x: case x when 'mindmap' then 3.0 when 'shadows' then 1.5 else 0.1 end::double)) else 0 end s,
list_distinct(regexp_extract_all(code, '\\(draw|fill|filldraw|node|path|coordinate|addplot)\b', 1)) d from codes)
select sample_id, round(least(5.0::double, (1 + s + case when regexp_matches(code, '\\node[\t\n\x0B\f\r ]*\(') then 0.3 else 0 end) * case when d = ['draw'] then 0.5 else 1 end), 6) as score from p""")
def pedagogical_score(spark, sf_dir):
    return codes(spark, sf_dir).select("sample_id", F.round(T.pedagogical(F.col("code")), 6).alias("score"))


@query(rf"""with {CODES}, c as (select sample_id, code, {COMMANDS} c from codes), s as (select *, {_top('c')} d,
len(list_filter(c, lambda x: x in ('\documentclass', '\usepackage', '\usetikzlibrary', '\PreviewEnvironment'))) p,
len(list_filter(c, lambda x: x in ('\draw', '\node', '\path', '\fill', '\filldraw', '\coordinate', '\addplot'))) v from c),
f as (select sample_id, v, d, (case when {_ENV} then 25 else 0 end + case when v >= 2 then 25 else 0 end + case when {_n(_COORD)} >= 2 then 15 else 0 end + case when len(c) = 0 or (len(c) - p)::double / len(c) >= 0.70 then 20 else 0 end
+ case when d <= 0.40 then 10 else 0 end + case when {_list(*BAD)} = '' then 5 else 0 end) points,
0.5 * ({_n(r'\\PreviewEnvironment')} + {_n(r'0\.geometric')} + {_n(r'decorations\.geometric')}) + 0.2 * ({_n(r'\\usepackage')} + {_n(r'\\documentclass')} + {_n(r'\\begin\{document\}')} + {_n(r'\\end\{document\}')}) + case when d > 0.4 then (d - 0.4) * 2 else 0 end as b from s)
select sample_id, v::int as drawing, round(points / 100, 6) as score, points >= 75 as passed, round(b, 6) as boilerplate, points >= 75 and b <= 5 as kept from f""")
def substantive_features(spark, sf_dir):
    own = codes(spark, sf_dir).select("sample_id", T.substance(F.col("code")).alias("s"), T.boilerplate(F.col("code")).alias("b"))
    return own.select("sample_id", "s.drawing", F.round("s.score", 6).alias("score"), "s.passed", F.round("b", 6).alias("boilerplate"), (F.col("s.passed") & (F.col("b") <= 5)).alias("kept"))


_AXIS = r"len(regexp_extract_all(o, '(?i)\\begin\{([a-zA-Z]*axis|groupplot)\}'))"
_KEYS = r"(regexp_matches(o, '(?i)\b(?:axis\s+[xy]\s+line\*?|xmin|xmax|ymin|ymax|xtick|ytick|xlabel|ylabel|legend\s+(?:entries|pos))\b') or regexp_matches(o, '\\addplot\b'))"
_FAR = r"len(list_filter(list_concat(regexp_extract_all(o, '\((-?[0-9]+\.?[0-9]*),[\t\n\x0B\f\r ]*(-?[0-9]+\.?[0-9]*)\)', 1), regexp_extract_all(o, '\((-?[0-9]+\.?[0-9]*),[\t\n\x0B\f\r ]*(-?[0-9]+\.?[0-9]*)\)', 2)), lambda v: abs(v::double) > 1000)) > 0"
CRITIC = [
    ("unbalanced_braces", "length(replace(o, '{', '')) <> length(replace(o, '}', ''))"), ("pgfplots_keys_in_plain_tikz", f"mode = 'plain_tikz' and {_KEYS} and {_AXIS} = 0"), ("missing_axis_environment", f"mode = 'pgfplots_axis' and {_AXIS} = 0"),
    ("missing_tikzcd_environment", r"mode = 'commutative_diagram' and not regexp_matches(o, '(?i)\\begin\{(?:tikzcd|tikz-cd)\}')"), ("legacy_tikzstyle", r"regexp_matches(o, '\\tikzstyle\b')"), ("nested_or_duplicate_axis_environment", f"{_AXIS} > 1"),
    ("repetition_collapse", f"len(l) > 10 and {_top('l')} > 0.5"), ("coordinate_out_of_range", f"{_AXIS} = 0 and {_FAR}"), ("unclosed_code_fence", _n("```", "o") + " >= 3 and " + _n("```", "o") + " % 2 <> 0"), ("near_empty_completion", rf"length(regexp_replace(o, '\A{WS}+|{WS}+\z', '', 'g')) < 20"),
    ("html_xml_contamination", "contains(w, '<html') or contains(w, '<?xml') or contains(w, '<div')"), ("python_code_contamination", "contains(w, 'import matplotlib') or contains(w, 'import numpy') or contains(w, 'def plot')"),
    ("absolute_page_positioning", "contains(w, 'current page.') or contains(w, '(current page)')"), ("base64_data_contamination", "contains(w, 'data:image') or regexp_matches(o, '[A-Za-z0-9+/]{100,}={0,2}')"), ("unclosed_environment", _n(r"\\begin\{", "w") + " <> " + _n(r"\\end\{", "w")),
]


@query(rf"""with {CODES}, m as (select sample_id, {_MODE} as mode, regexp_replace(code, '(?m)(^|[^\\])%[^\n]*', '\1', 'g') as code from codes), c as (select sample_id, mode, code as o, lower(code) as w, {_LINES} as l from m),
v as (select sample_id, {_list(*CRITIC)} as violations from c) select sample_id, violations, not contains(violations, 'unbalanced_braces') and len(list_filter(string_split(violations, ','), lambda x: x <> '')) <= 2 as kept from v""")
def static_critic(spark, sf_dir):
    found = T.critic(F.col("code"), T.generation_mode(F.col("code")))
    return codes(spark, sf_dir).select("sample_id", F.array_join(found, ",").alias("violations"), (~F.array_contains(found, "unbalanced_braces") & (F.size(found) <= 2)).alias("kept"))


_OWN = r"regexp_extract_all(code, '[^\t\n\x0B\f\r ]+')"
_MARK = r"list_transform(w, lambda x: regexp_replace(regexp_replace(regexp_replace(x, '\\draw\[[^\]]*\]', '\\draw[<OPT>]', 'g'), '-?[0-9]+(?:\.[0-9]+)?', '<NUM>', 'g'), '\(<NUM>,<NUM>\)', '(<COORD>)', 'g'))"


def _div(items: str, n: int) -> str:
    grams = f"list_transform(range(1, len({items}) - {n - 2}), lambda i: array_to_string(list_slice({items}, i, i + {n - 1}), ' '))"
    return f"case when len({items}) <= {n} then 1.0 else len(list_distinct({grams}))::double / len({grams}) end"


@query(rf"""with {CODES}, a as (select sample_id, code, {_OWN} w, {COMMANDS} c, {_LINES} l from codes), b as (select *, {_MARK} m from a)
select sample_id, {_list(('preview_environment', _n(r'\\PreviewEnvironment') + ' > 0'), ('usepackage', _n(r'\\usepackage') + ' > 0'), ('documentclass', _n(r'\\documentclass') + ' > 0'), ('repetition_loop', _run('l') + ' >= 5'), ('low_bigram_diversity', 'len(w) >= 20 and ' + _div('w', 2) + ' < 0.20'), ('low_loop_bigram_diversity', 'len(w) >= 20 and ' + _div('m', 2) + ' < 0.20'), ('low_loop_trigram_diversity', 'len(w) >= 20 and ' + _div('m', 3) + ' < 0.25'))} as reasons,
round({_div('w', 2)}, 6) as bigrams, round({_div('m', 3)}, 6) as loop_trigrams from b""")
def collapse_check(spark, sf_dir):
    code = F.col("code")
    found = F.filter(T.collapse(code), lambda x: ~x.isin("command_dominance", "unigram_dominance"))
    loops = F.transform(T.words(code), T.loop_token)
    return codes(spark, sf_dir).select("sample_id", F.array_join(found, ",").alias("reasons"), F.round(T.diversity(T.words(code), 2), 6).alias("bigrams"), F.round(T.diversity(loops, 3), 6).alias("loop_trigrams"))


@query(rf"""with {CODES}, r as (select sample_id, case when sample_id % 3 = 0 then '\documentclass[tikz]{{standalone}}' || chr(10) || '\begin{{document}}x\end{{document}}' || chr(10) else code end as code from codes),
s as (select sample_id, regexp_replace(code, '\A{WS}+|{WS}+\z', '', 'g') as code from r) select sample_id, code <> '' and not contains(code, '```') and {_n(r'(?i)\\documentclass\b')} = 1 and {_n(r'(?i)\\begin\{document\}')} = 1 and {_n(r'(?i)\\end\{document\}')} = 1
and regexp_matches(code, '(?is)\A\\documentclass[\t\n\x0B\f\r ]*\[tikz\][\t\n\x0B\f\r ]*\{{standalone\}}.*\\begin\{{document\}}.*\\end\{{document\}}\z') as canonical from s""")
def canonical_document(spark, sf_dir):
    whole = "\\documentclass[tikz]{standalone}\n\\begin{document}x\\end{document}\n"
    code = F.when(F.col("sample_id") % 3 == 0, whole).otherwise(F.col("code"))
    return codes(spark, sf_dir).select("sample_id", T.canonical(code).alias("canonical"))


_ROLES = """r as (select conv_id, coalesce(string_agg(text, chr(10) order by turn) filter (role = 'user'), '') u, coalesce(string_agg(text, chr(10) order by turn) filter (role = 'assistant'), '') a,
count(*) filter (role = 'user') nu, count(*) filter (role = 'assistant') na from conversations group by 1)"""


def roles(turns):
    """(conv_id, user, assistant, n_user, n_assistant): texts of each role, joined by newlines in turn order.

    A conversation's turns are one record here; the operators of huge conversations are elsewhere.
    """
    of = lambda role: F.transform(F.filter(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: x["role"] == role), lambda x: x["text"])
    own = turns.groupBy("conv_id").agg(of("user").alias("u"), of("assistant").alias("a"))
    return own.select("conv_id", F.array_join("u", "\n").alias("user"), F.array_join("a", "\n").alias("assistant"), F.size("u").cast("long").alias("n_user"), F.size("a").cast("long").alias("n_assistant"))


@query("""with m as (select conv_id, list(text order by turn) t, string_agg(text, chr(10) order by turn) filter (role = 'user') u, string_agg(text, chr(10) order by turn) filter (role = 'assistant') a from conversations group by 1)
select conv_id, sha256(coalesce(u, t[1], '')) as user_hash, sha256(coalesce(a, t[2], '')) as assistant_hash, len(t) > 0 as some from m""")
def role_text(spark, sf_dir):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    own = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("m"))
    return own.select("conv_id", F.sha2(R.of_role(F.col("m"), "user", 0), 256).alias("user_hash"), F.sha2(R.of_role(F.col("m"), "assistant", 1), 256).alias("assistant_hash"), (F.size("m") > 0).alias("some"))


@query(f"with {_ROLES} select conv_id, " + _list(("user_count_not_one", "nu <> 1"), ("assistant_count_not_one", "na <> 1"), ("opening_latex_fence_count", _n("```latex", "u") + " <> 1"), ("closing_fence_count", _n("```", "a") + " <> 1"), ("assistant_env_start", r"not regexp_matches(a, '(?i)\A[\t\n\x0B\f\r ]*\\begin\{(?:tikzpicture|tikz-cd|tikzcd|circuitikz|axis|tikzpicture\*)\}')")) + " as violations from r")
def conversation_contract(spark, sf_dir):
    found = T.contract(F.col("user"), F.col("assistant"), F.col("n_user"), F.col("n_assistant"))
    return roles(table(spark, sf_dir, "conversations")).select("conv_id", F.array_join(found, ",").alias("violations"))


@query("select conv_id, string_agg('<' || role || '>' || text, chr(10) order by turn) as flat from conversations group by 1")
def chat_flatten(spark, sf_dir):
    # Content in typed parts: the text, in two of them, and an image.
    part = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    content = F.array(part("text", F.substring("text", 1, 5)), part("image", F.lit("x")), part("text", F.expr("substring(text, 6)")))
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", content.alias("content"))))
    own = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    return own.select("conv_id", F.array_join(F.transform(R.flattened(F.col("t")), lambda x: F.concat(F.lit("<"), x["role"], F.lit(">"), x["text"])), "\n").alias("flat"))


@query(rf"""with {CODES}, f as (select sample_id, 'text ```latex' || chr(10) || source || ' ``` more ```' || code || '```' as t from codes)
select sample_id, regexp_replace(list_extract(regexp_extract_all(t, '(?is)```(?:latex)?[\t\n\x0B\f\r ]*(.*?)```', 1), -1), '\A{WS}+|{WS}+\z', '', 'g') as code from f""")
def last_fenced_block(spark, sf_dir):
    return codes(spark, sf_dir).select("sample_id", T.last_fence(F.concat(F.lit("text ```latex\n"), "source", F.lit(" ``` more ```"), "code", F.lit("```"))).alias("code"))


@query(rf"""with {CODES}, t as (select sample_id, list_distinct(regexp_extract_all(code, '\\[A-Za-z]+|[A-Za-z0-9_]+|[^\t\n\x0B\f\r A-Za-z0-9_]')) t from codes)
select a.sample_id, round(case when len(a.t) + len(b.t) = 0 then 1.0 else len(list_intersect(a.t, b.t))::double / len(list_distinct(list_concat(a.t, b.t))) end, 6) as jaccard from t a join t b on b.sample_id = a.sample_id + 1""")
def token_jaccard(spark, sf_dir):
    own = codes(spark, sf_dir).select("sample_id", F.array_distinct(T.tokens(F.col("code"))).alias("t"))
    # Merged, not broadcast: Spark takes an array for one element when it estimates a table's size.
    other = own.select((F.col("sample_id") - 1).alias("sample_id"), F.col("t").alias("o")).hint("merge")
    return own.join(other, "sample_id").select("sample_id", F.round(T.jaccard(F.col("t"), F.col("o")), 6).alias("jaccard"))


@query()
def token_edit_distance(spark, sf_dir):
    own = table(spark, sf_dir, "benchmark").select("item_id", T.tokens(F.col("text")).alias("t"))
    other = own.select((F.col("item_id") - 1).alias("item_id"), F.col("t").alias("o"))
    return own.join(other, "item_id").select("item_id", T.edit_distance(F.col("t"), F.col("o")).alias("distance"))
