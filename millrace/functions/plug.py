"""Places for outside tools: compilers, token counters, scorers; and the hash of a small image."""

from __future__ import annotations

import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T


def compile_status(df: DataFrame, code: str, tool: str = "tectonic", timeout: float = 15.0) -> DataFrame:
    """Adds status (ok, failed, timeout or tool_missing) and the tool's log.

    Each text is compiled in a folder of its own that goes with the task; where the tool is not installed the status says so.
    """
    schema = df.schema.simpleString()[7:-1] + ",status:string,log:string"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = shutil.which(tool)
        for part in parts:
            out = []
            for source in part[code]:
                if not found:
                    out.append(("tool_missing", ""))
                    continue
                with tempfile.TemporaryDirectory() as folder:
                    Path(folder, "a.tex").write_text(source or "")
                    try:
                        done = subprocess.run([found, "a.tex"], cwd=folder, capture_output=True, text=True, timeout=timeout)
                        out.append(("ok" if done.returncode == 0 else "failed", done.stdout + done.stderr))
                    except subprocess.TimeoutExpired:
                        out.append(("timeout", ""))
            yield part.assign(status=[s for s, _ in out], log=[x for _, x in out])

    return df.mapInPandas(run, schema.replace(":", " "))


def token_count(text: Column) -> Column:
    """The count that stands in where no tokenizer is given."""
    return F.size(T.tokens(text))


def unit(value: Column) -> Column:
    """Into 0 to 1; what is no number is 0."""
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def weighted(df: DataFrame, text: str, ok: str, scorer: Callable[[pd.Series], pd.Series], on_error: str = "fail") -> DataFrame:
    """Adds sample_weight: a scorer's value of compiled rows, into 0 to 1, 0 for others.

    A batch whose scorer fails stops the job, or with on_error = "zero" counts 0.
    """

    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            try:
                got = scorer(part)
                if len(got) != len(part):
                    raise RuntimeError(f"{len(got)} scores for {len(part)} rows")
            except Exception:
                if on_error == "fail":
                    raise
                got = pd.Series([0.0] * len(part))
            yield got.astype("float64")

    score.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn("sample_weight", F.when(F.col(ok), unit(F.pandas_udf(score, "double")(text))).otherwise(0.0))


def difference_hash(pixels: Column) -> Column:
    """The 64-bit difference hash of 8 rows of 9 grey values, as 16 hex digits."""
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when(F.get(pixels, (F.floor(i / 8) * 9 + i % 8).cast("int")) > F.get(pixels, (F.floor(i / 8) * 9 + i % 8 + 1).cast("int")), F.lit("1")).otherwise("0"))
    return F.lpad(F.lower(F.conv(F.array_join(F.reverse(bits), ""), 2, 16)), 16, "0")
