"""Record builders: projections from raw rows and chats to training records, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tex
from ..functions import text as T

# The wording of prompts.
PROMPT_HEAD = "Generate only the TikZ environment body according to the following requirements:\n"
PROMPT_TAIL = """
Output constraints:
- Generate only the TikZ environment body (e.g., \\begin{tikzpicture} ... \\end{tikzpicture}).
- Do not output a LaTeX preamble, \\documentclass, \\usepackage, or \\PreviewEnvironment.
- Do not output a LaTeX document environment (begin/end document).
- Start directly with the TikZ environment and end with the matching close and the markdown fence.
- Preserve geometric constraints from the description (coordinates, labels, and relative placement).
- Use strict TikZ syntax: terminate paths with ';', use calc ($...$) for math.

```latex"""
HINTS = "\n[GEOMETRY HINTS]\n"
CLOSE = "\n```\n"


def description(*candidates: Column) -> Column:
    """The first text that is not blank, stripped."""
    return F.coalesce(*(T.filled(c) for c in candidates))


def preferred(*candidates: Column, otherwise: Column) -> Column:
    """The first text that is not blank, as it is; else another value, or an empty text."""
    return F.coalesce(*(F.when(T.filled(c).isNotNull(), c) for c in candidates), otherwise, F.lit(""))


def described(*candidates: Column, prompt_text: Column) -> Column:
    """A record's description: the first of its own that is not blank, else the prompt's own words."""
    return F.coalesce(description(*candidates), bare_prompt(prompt_text))


def evaluated(prompt_text: Column, completion: Column) -> Column:
    """The document that is compared: what stands before the prompt's fence, then the completion's body."""
    head = F.regexp_replace(F.split(prompt_text, "```latex", 2)[0], r"[\t\n\x0B\f\r ]+\z", "")
    return F.concat(T.strip(F.concat(head, F.lit("\n"), completion)), F.lit("\n"))


def hydrated(df: DataFrame, dataset: str, split: str) -> DataFrame:
    """Adds the metadata struct; origin falls back to uri, file_id and sample_id."""
    known = [c for c in ("file_id", "caption", "uri") if c in df.columns]
    origin = F.coalesce(*(T.filled(F.col(c).cast("string")) for c in ("origin", "uri", "file_id", "sample_id") if c in df.columns))
    return df.withColumn("metadata", F.struct(F.lit(dataset).alias("dataset_id"), F.lit(split).alias("split"), *known, origin.alias("origin")))


def compact(number: Column) -> Column:
    """A number as briefly as it can be written, to 6 places."""
    return F.regexp_replace(F.format_string("%.6f", number), r"\.?0+\z", "")


def hints(mode: Column, libraries: Column, box: Column) -> Column:
    """The hints block of a prompt; empty without any hint."""
    names = F.when((F.size(libraries) > 0) & (F.size(libraries) <= 6), F.concat(F.lit("tikzlibrary: "), F.array_join(libraries, ", ")))
    corner = lambda a, b: F.concat(F.lit("("), compact(box[a]), F.lit(", "), compact(box[b]), F.lit(")"))
    area = F.when(box.isNotNull(), F.concat(F.lit("bounding_box: "), corner("min_x", "min_y"), F.lit(" to "), corner("max_x", "max_y")))
    rows = F.array_compact(F.array(F.when(T.filled(mode).isNotNull(), F.concat(F.lit("mode: "), mode)), names, area))
    return F.when(F.size(rows) > 0, F.concat(F.lit(HINTS), F.array_join(rows, "\n"), F.lit("\n"))).otherwise("")


def prompt(text: Column, mode: Column, libraries: Column, box: Column) -> Column:
    """The generation prompt of a description."""
    return F.concat(F.lit(PROMPT_HEAD), T.strip(text), F.lit("\n"), hints(mode, libraries, box), F.lit(PROMPT_TAIL))


def _message(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("text"))


def training_records(samples: DataFrame) -> DataFrame:
    """(sample_id, source, messages, mode) of samples (sample_id, source, code, description): prompt and fenced target."""
    body = samples.withColumn("body", tex.series(tex.target)("code"))
    mode, names, box = T.generation_mode(F.col("code")), T.libraries(F.col("code")), T.bounding_box(F.col("code"))
    turns = F.array(_message("user", prompt(F.col("description"), mode, names, box)), _message("assistant", F.concat("body", F.lit(CLOSE))))
    return body.select("sample_id", "source", turns.alias("messages"), mode.alias("mode"))


def paired_records(samples: DataFrame) -> DataFrame:
    """(sample_id, prompt_text, reference_code) of the same samples."""
    code = F.col("code")
    return samples.select("sample_id", prompt(F.col("description"), T.generation_mode(code), T.libraries(code), T.bounding_box(code)).alias("prompt_text"), tex.series(tex.target)("code").alias("reference_code"))


def flattened(messages: Column, separator: str = "") -> Column:
    """Messages (role, content of typed parts) as (role, text): the text parts joined."""
    texts = lambda m: F.transform(F.filter(m["content"], lambda p: p["type"] == "text"), lambda p: F.coalesce(p["text"], F.lit("")))
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), F.array_join(texts(m), separator).alias("text")))


def of_role(messages: Column, role: str, position: int) -> Column:
    """All texts of a role joined by newlines; without any, the message at a position."""
    own = F.transform(F.filter(messages, lambda m: m["role"] == role), lambda m: m["text"])
    return F.when(F.size(own) > 0, F.array_join(own, "\n")).otherwise(F.coalesce(F.get(messages, F.lit(position))["text"], F.lit("")))


def first_text(messages: Column, role: str) -> Column:
    """The text of a role's first message; null without one."""
    return F.get(F.filter(messages, lambda m: m["role"] == role), F.lit(0))["text"]


def bare_prompt(text: Column) -> Column:
    """A prompt's own words: without its head, hints, constraints and fence."""
    own = F.regexp_replace(text, rf"(?i)\A{PROMPT_HEAD.rstrip()}\s*", "")
    own = F.split(own, r"\n\[GEOMETRY HINTS\]|\nOutput constraints:", 2)[0]
    return T.strip(F.regexp_replace(T.strip(own), r"(?i)```latex\s*\z", ""))


def source_key(*candidates: Column, loose: Column | None = None) -> Column:
    """Where a record comes from: the first name given, else a loose one that looks like a place."""
    names = [T.filled(c) for c in candidates]
    if loose is not None:
        names.append(F.when(loose.rlike(r"(?i)[/\\:]|arxiv|\.tex$|\.jsonl?$"), T.filled(loose)))
    return F.coalesce(*names)


def repaired(df: DataFrame) -> DataFrame:
    """Rows (sample_id, user, assistant, mode, libraries, box) in contract form, with what changed.

    The prompt is rendered anew from its own words, the answer cut to its environment and closed by one fence.
    """
    user = F.col("user")
    own = F.regexp_replace(F.regexp_replace(bare_prompt(user), r"(?is)\A.*?according to the following requirements:", ""), r"(?i)```(?:latex)?", "")
    new_user = prompt(F.split(own, "--- Starting Preamble ---", 2)[0], F.col("mode"), F.col("libraries"), F.col("box"))
    body = F.regexp_replace(F.col("assistant"), r"(?i)```(?:latex)?", "")
    body = F.regexp_replace(body, r"(?is)\A.*?\\begin\{document\}", "")
    body = F.regexp_replace(body, r"(?is)\\end\{document\}.*\z", "")
    body = F.regexp_replace(body, r"(?is)\A.*?(?=\\begin\{(?:tikzpicture|tikz-cd|tikzcd|circuitikz|axis)\})", "")
    made = df.select("sample_id", "user", "assistant", new_user.alias("new_user"), F.concat(T.strip(body), F.lit(CLOSE)).alias("new_assistant"))
    one = F.lit(1)
    return made.select(
        "sample_id", "new_user", "new_assistant", ((F.col("user") != F.col("new_user")) | (F.col("assistant") != F.col("new_assistant"))).alias("changed"),
        T.contract(F.col("user"), F.col("assistant"), one, one).alias("before"), T.contract(F.col("new_user"), F.col("new_assistant"), one, one).alias("after"),
    )


def reconstructed(preamble: Column, body: Column) -> Column:
    """A whole document of a prompt's preamble (what stands before its fence) and a body."""
    head = F.regexp_replace(F.split(preamble, "```latex", 2)[0], r"[\t\n\x0B\f\r ]+\z", "")
    return F.concat(head, F.lit("\n"), body, F.lit("\n\\end{document}"))


def candidate_code(response: Column) -> Column:
    """The code of a response: its longest fenced block, else a whole document in it, else its picture as one, else all of it."""
    document = T.filled(F.regexp_substr(response, F.lit(r"(?is)\\documentclass.*?\\end\{document\}")))
    picture = T.filled(F.regexp_substr(response, F.lit(r"(?is)\\begin\{tikzpicture\}.*?\\end\{tikzpicture\}")))
    wrapped = F.concat(F.lit("\\documentclass[tikz]{standalone}\n\\begin{document}\n"), picture, F.lit("\n\\end{document}"))
    return F.coalesce(T.filled(T.longest_fence(response)), document, wrapped, T.strip(response))


def log_fields(line: Column) -> Column:
    """struct(iteration, total, speed) of a progress line; nulls where it has none."""
    number = lambda p, g: T.filled(F.regexp_extract(line, p, g)).cast("double")
    at = r"(?i)iter(?:ation)?\s*:?\s*(\d+)(?:\s*/\s*(\d+))?"
    return F.struct(number(at, 1).cast("long").alias("iteration"), number(at, 2).cast("long").alias("total"), number(r"(?i)(\d+(?:\.\d+)?)\s*(?:it/s|tok(?:ens)?/s)", 1).alias("speed"))


def checkpoint_step(name: Column) -> Column:
    """The number at the start of a checkpoint's file name."""
    return T.filled(F.regexp_extract(name, r"(?:\A|/)(\d+)_", 1)).cast("long")


def layer_of(module: Column) -> Column:
    """The layer number in a module's name."""
    return T.filled(F.regexp_extract(module, r"layers\.(\d+)", 1)).cast("long")
