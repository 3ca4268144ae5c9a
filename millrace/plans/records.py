"""Figure-code records made from the part table, the same in Spark and in SQL.

Each record is put together from snippets that depend on its key, so that every
text operator finds something to do on the test tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: modulus, remainder, snippet: the snippet is in the code of the parts whose key leaves that remainder.
SNIPPETS = (
    (11, 3, "\\usepackage{tikz}\n"),
    (37, 5, "\\documentclass[tikz]{standalone}\n\\begin{document}\n"),
    (5, 1, "\\usetikzlibrary{calc, arrows.meta}\n"),
    (7, 2, "\\usetikzlibrary{mindmap,shadows}\n"),
    (1, 0, "\\begin{tikzpicture}\n"),
    (4, 1, "\\begin{axis}[xmin=0]\n\\addplot coordinates {(1,2)};\n\\end{axis}\n"),
    (9, 4, "% a comment with { in it\n"),
    (1, 0, "\\draw[thick] (0,0) -- (1.25,2.5);\n\\node (a) at (3,-4.75) {label};\n"),
    (6, 2, "\\draw (0,0) -- (1,1);\n\\draw (0,0) -- (1,1);\n\\draw (0,0) -- (1,1);\n\\draw (0,0) -- (1,1);\n\\draw (0,0) -- (1,1);\n\\draw (0,0) -- (1,1);\n"),
    (8, 3, "\\path (2000,1) -- (3,4);\n\\fill (0.123456,1.5) circle (2);\n"),
    (10, 7, "    >=stealth,\n" * 10),
    (13, 6, "\\begin{tikzcd} A \\arrow B \\end{tikzcd}\n"),
    (14, 9, "\\graph {a -> b};\n"),
    (15, 11, "{ ( [\n"),
    (12, 5, "\\tikzstyle{every node}=[draw]\n"),
    (16, 2, "<div>\nimport numpy\n"),
    (17, 8, "\\includegraphics[width=2cm]{a.png}\n"),
    (1, 0, "\\end{tikzpicture}\n"),
    (37, 5, "\\end{document}\n"),
    (3, 1, "```"),
    (19, 4, "```latex\n\\\\\\\\\n"),
)


_documents = False


@contextmanager
def over_documents() -> Iterator[None]:
    """While it lasts, `codes` are the texts of documents."""
    global _documents
    _documents = True
    try:
        yield
    finally:
        _documents = False


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, source, ord, code)"""
    if _documents:
        return spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("sample_id"), "source", F.col("doc_id").alias("ord"), F.col("text").alias("code"))
    parts = [F.when(F.col("p_partkey") % m == r, s).otherwise("") for m, r, s in SNIPPETS]
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("sample_id"), F.col("p_brand").alias("source"), F.col("p_partkey").alias("ord"), F.concat(*parts).alias("code"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: The same records as a common table expression.
CODES = "codes as (select p_partkey as sample_id, p_brand as source, p_partkey as ord, " + " || ".join(
    f"case when p_partkey % {m} = {r} then {_quoted(s)} else '' end" for m, r, s in SNIPPETS
) + " as code from part)"
#: Texts of documents in their place.
DOCUMENT_CODES = "codes as (select doc_id as sample_id, source, doc_id as ord, text as code from documents)"
