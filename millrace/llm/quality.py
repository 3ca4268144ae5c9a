"""Quality rules as a learned decision list.

Statistics of every whole text are computed by word kernels; sequential
covering then grows one conjunction of threshold tests at a time on part of the
labelled rows, prunes it on the rest, and removes what it covers. The list is
emitted as one ordered Spark conditional expression over the statistics.

Defined results: a null or empty text has zero words and fails the base rules;
rows with a null label are no examples; without labelled rows of both classes
the list is empty and keeps what passes the base rules; of several texts of a labelled
id the one of the least counts is fitted; of tests of one gain the first by feature and
bound is taken; very long texts are counted whole; repeated rows each get the same verdict; columns other than doc_id and text are carried along or ignored.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import common
from .kernel import mix, sequence_hashes, text_chunks, word_edges, word_hashes

#: At most so many labelled rows are fitted; of more, those with the smallest hashes of their ids.
FIT_ROWS = 50_000
WINDOW = 5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_bars", "n_chars"]
#: Ratios on which rules test: numerator and denominator.
FEATURES = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "n_letters"),
    "digits": ("n_digits", "n_chars"),
    "bars": ("n_bars", "n_words"),
    "line_words": ("n_words", "n_lines"),
}

_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[list(b"#*$%&|<>")] = 1
_LEAD = np.ones(256, np.uint8)
_LEAD[0x80:0xC0] = 0
_UPPER = np.zeros(256, np.uint8)
_UPPER[65:91] = 1
_LETTER = np.zeros(256, np.uint8)
_LETTER[65:91] = _LETTER[97:123] = 1
_DIGIT = np.zeros(256, np.uint8)
_DIGIT[48:58] = 1
_BAR = np.zeros(256, np.uint8)
_BAR[ord("|")] = 1


def _row_sums(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated(words: np.ndarray, k: int = WINDOW) -> int:
    """Words that lie in a k-word window which occurs twice or more, the first one included."""
    if len(words) < k:
        return 0
    windows = sequence_hashes(words, k)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + k, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text of a string column."""
    out = {name: np.zeros(len(column), np.int64) for name in COUNTS}
    for a, b, data, offsets in text_chunks(column):
        starts, ends, first = word_edges(data, offsets)
        words = word_hashes(data, starts, ends, lower=False)
        n = np.diff(first)
        out["n_words"][a:b] = n
        points = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_LEAD[data], out=points[1:])
        length = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(points[ends] - points[starts], out=length[1:])
        out["word_chars"][a:b] = length[first[1:]] - length[first[:-1]]
        out["n_chars"][a:b] = points[offsets[1:]] - points[offsets[:-1]]
        for name, marks in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_letters", _LETTER), ("n_digits", _DIGIT), ("n_bars", _BAR)):
            out[name][a:b] = _row_sums(marks[data], offsets)
        breaks = np.flatnonzero(data == 10)
        row_breaks = np.searchsorted(breaks, offsets)
        for row in range(a, b):
            i = row - a
            if not n[i]:
                continue
            own = words[first[i] : first[i + 1]]
            out["n_repeat_words"][row] = _repeated(own)
            cuts = breaks[row_breaks[i] : row_breaks[i + 1]]
            if not len(cuts):
                out["n_lines"][row] = 1
                continue
            begin = np.concatenate([offsets[i : i + 1], cuts + 1])
            stop = np.concatenate([cuts, offsets[i + 1 : i + 2]])
            filled = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
            begin, stop = begin[filled], stop[filled]
            out["n_lines"][row] = len(begin)
            out["n_dup_lines"][row] = len(begin) - len({data[x:y].tobytes() for x, y in zip(begin.tolist(), stop.tolist(), strict=True)})
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row = batch.column("row")
        found = counts(row.field(row.type.get_field_index("text")))
        yield pa.RecordBatch.from_arrays([row, *(pa.array(found[name]) for name in COUNTS)], ["row", *COUNTS])


def _counted_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = counts(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(found[name]) for name in COUNTS], ["doc_id", *COUNTS])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every row's whole text."""
    common.prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _counted_only, "doc_id long, " + ", ".join(f"{name} long" for name in COUNTS)
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """Every row of docs as the struct column row, and the counts; no name of docs can clash."""
    common.prepare(docs.sparkSession)
    whole = docs.select(F.struct("*").alias("row"))
    schema = StructType([*whole.schema.fields, *(StructField(name, LongType()) for name in COUNTS)])
    return whole.mapInArrow(_counted, schema)


def base_failed() -> Column:
    """The fixed rules: under 10 words, or over 20 percent of the words in repeated windows."""
    n, r = F.col("n_words"), F.col("n_repeat_words")
    return (n < 10) | (100 * r > 20 * n)


def feature(name: str) -> Column:
    """A ratio as a column; 0 where the denominator is 0."""
    top, bottom = FEATURES[name]
    value = F.col(top).cast("double")
    return value if bottom is None else F.when(F.col(bottom) > 0, value / F.col(bottom)).otherwise(F.lit(0.0))


@dataclasses.dataclass(frozen=True)
class Test:
    """name <= bound, or name > bound."""

    name: str
    above: bool
    bound: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] > self.bound if self.above else x[self.name] <= self.bound

    def column(self) -> Column:
        value = feature(self.name)
        return value > F.lit(self.bound) if self.above else value <= F.lit(self.bound)


Rule = tuple[Test, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, bool)
    for test in rule:
        held &= test.holds(x)
    return held


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    """Add the test with the largest information gain until only bad rows are covered."""
    held, rule = np.ones(len(bad), bool), ()
    while len(rule) < most and held.any() and not bad[held].all():
        p0, n0 = bad[held].sum(), held.sum()
        best = (0.0, None)
        for name, values in x.items():
            order = np.argsort(values[held], kind="stable")
            v, y = values[held][order], bad[held][order]
            below = np.cumsum(y)
            ends = np.flatnonzero(v[1:] != v[:-1])
            if not len(ends):
                continue
            for above in (False, True):
                p = (p0 - below[ends]) if above else below[ends]
                n = (n0 - ends - 1) if above else ends + 1
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / n) - np.log2(p0 / n0)), 0.0)
                i = int(np.argmax(gain))
                if gain[i] > best[0] + 1e-9:
                    best = (float(gain[i]), Test(name, above, float((v[ends[i]] + v[ends[i] + 1]) / 2)))
        if best[1] is None:
            break
        rule = (*rule, best[1])
        held &= best[1].holds(x)
    return rule


def _worth(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> float:
    held = _covers(rule, x, len(bad))
    p = int((held & bad).sum())
    n = int((held & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.97, most_tests: int = 4, most_rules: int = 12) -> list[Rule]:
    """Sequential covering: the ordered rules whose bodies mark bad rows.

    Two rows of three grow a rule, the third prunes it (tests are dropped from the
    end while that does not lower its worth); a rule stays if at least `precision`
    of all rows that it covers are bad.
    """
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    prune_row = np.arange(len(bad)) % 3 == 2
    while len(rules) < most_rules and bad[left].sum() >= 5:
        grow, prune = left & ~prune_row, left & prune_row
        if not bad[grow].any():
            break
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow], most_tests)
        if not rule:
            break
        part = {k: v[prune] for k, v in x.items()}
        while len(rule) > 1 and _worth(rule[:-1], part, bad[prune]) >= _worth(rule, part, bad[prune]):
            rule = rule[:-1]
        held = _covers(rule, x, len(bad)) & left
        if not held.any() or bad[held].mean() < precision or (held & bad).sum() < 3:
            break
        rules.append(rule)
        left &= ~held
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as an ordered conditional expression: true keeps a row."""
    out = F.lit(True)
    for rule in reversed(rules):
        body = rule[0].column()
        for test in rule[1:]:
            body = body & test.column()
        out = F.when(body, F.lit(False)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[Rule]:
    """Learn the list from the labelled rows; labels has doc_id and quality (1 good, 0 bad).

    The fitted rows are a bounded sample: the fit_rows labelled ids of smallest hash,
    the first label of an id that has several.
    """
    wanted = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    # At most fit_rows ids of 8 bytes: a proven bound for the broadcast.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(wanted), "doc_id")
    one = statistics(rows.select("doc_id", "text")).where(~base_failed()).groupBy("doc_id").agg(F.min(F.struct(*COUNTS)).alias("s")).select("doc_id", "s.*")
    stats = one.join(F.broadcast(wanted), "doc_id").toPandas()
    if not len(stats):
        return []
    stats = stats.sort_values(["doc_id", *COUNTS], kind="stable")
    key = mix(stats["doc_id"].to_numpy().astype(np.uint64))
    stats = stats.iloc[np.argsort(key, kind="stable")]
    bad = stats["quality"].to_numpy() == 0
    if bad.all() or not bad.any():
        return []
    x = {}
    for name, (top, bottom) in FEATURES.items():
        value = stats[top].to_numpy(np.float64)
        x[name] = value if bottom is None else np.divide(value, stats[bottom].to_numpy(np.float64), out=np.zeros(len(value)), where=stats[bottom].to_numpy() > 0)
    return learn(x, bad)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8 over the whole documents table."""
    docs = common.table(spark, sf_dir, "documents")
    rules = fit(docs, common.table(spark, sf_dir, "labels"))
    return (
        statistics(docs)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & verdict(rules))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    )
