"""A counterfactually regularised toxicity classifier.

A document is the set of its folded words (A-Z lower-cased, no ASCII punctuation),
hashed to 2**BITS features. A logistic model is fitted by accelerated proximal
gradient steps on the labelled rows outside the held-out fold. Besides the usual
loss and an L1 term it pays for score changes on counterfactuals: labelled
documents in which an identity term is swapped for another of its group or taken
out, and every labelled document's neutral frame with one term or another in it.
Since a swap changes two features only, the squared change of the logit is a
quadratic in those weights, and mentions of groups end up without weight of their own.

Labels, lang, source and doc_id are never inputs of a score.

Defined results: null and empty texts get the model's bias; rows with a null label
are no examples; of several labels for an id the largest counts, of several texts one;
very long texts are read whole; a score of 0.5 is toxic; without examples of
both classes every score is the rate of the one class (0 without any); repeated rows
score alike; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .decontaminate import words_of
from .kernel import text_chunks, word_edges, word_hashes

BITS = 20
#: At most so many labelled rows are fitted: those whose ids have the smallest hashes.
FIT_ROWS = 12_000
#: The fold that is held out: crc32(doc_id as text) mod FOLDS is 0.
FOLDS = 5
SWAP_WEIGHT = 4.0
#: Deviations by which a word must differ between the classes before it gets a weight.
CHANCE = 3.5
STEPS = 300

#: Groups of identity terms that are swapped within a group.
IDENTITY = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist", "muslims", "christians", "jews"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("blind", "deaf", "disabled", "elderly", "young"),
)


def features_of(words: np.ndarray) -> np.ndarray:
    """Features of word hashes."""
    return (words >> np.uint64(64 - BITS)).astype(np.int64)


def identity_features() -> list[list[int]]:
    """The identity terms' features, by group."""
    out = []
    for group in IDENTITY:
        ((_, _, data, offsets),) = text_chunks(pa.array([" ".join(group)]))
        starts, ends, _ = word_edges(data, offsets)
        out.append(features_of(word_hashes(data, starts, ends, lower=False)).tolist())
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for _, words, first in words_of(batch.column("text")):
            own = features_of(words).astype(np.int32)
            out += [np.unique(own[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "features"])


def held_out() -> Column:
    """Whether a row is in the fold that labels are never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def swaps(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counterfactual differences as (feature in, feature out or -1, weight): each is a swap or a removal.

    Every identity term against its neighbour in its group and against no term, for
    the neutral frames; and, for each document with a term, that term against each
    other of its group that the document lacks.
    """
    pairs: dict[tuple[int, int], float] = {}
    n = max(1, len(rows))
    groups = identity_features()
    group_of = {f: g for g in groups for f in g}
    for group in groups:
        for a, b in zip(group, group[1:] + group[:1], strict=True):
            pairs[a, b] = pairs.get((a, b), 0.0) + 0.1
            pairs[a, -1] = pairs.get((a, -1), 0.0) + 0.1
    terms = np.array(sorted(group_of))
    for row in rows:
        for a in np.intersect1d(row, terms).tolist():
            pairs[a, -1] = pairs.get((a, -1), 0.0) + 1 / n
            others = [b for b in group_of[a] if b != a and b not in row]
            for b in others:
                pairs[a, b] = pairs.get((a, b), 0.0) + 1 / (n * len(others))
    keys = np.array(list(pairs), np.int64).reshape(-1, 2)
    return keys[:, 0], keys[:, 1], np.array(list(pairs.values()))


def fit(rows: list[np.ndarray], toxic: np.ndarray, swap_weight: float = SWAP_WEIGHT, chance: float = CHANCE) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, their weights, bias) from each example's sorted distinct features."""
    toxic = np.asarray(toxic, np.float64)
    rate = float(toxic.mean()) if len(toxic) else 0.0
    if rate in (0.0, 1.0):
        return np.zeros(0, np.int64), np.zeros(0), 20.0 if rate else -20.0
    every, inverse, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    left, right, pay = swaps(rows)
    wanted = np.isin(every, left) | np.isin(every, right) | (times >= 3)
    name = np.cumsum(wanted) - 1
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    held = wanted[inverse]
    column, owner, every = name[inverse][held], owner[held], every[wanted]
    place = {f: i for i, f in enumerate(every.tolist())}
    into = np.array([place.get(f, len(every)) for f in left.tolist()])
    out = np.array([place.get(f, len(every)) for f in right.tolist()])
    m, n = len(every), len(rows)
    # Classes weigh the same. A feature's L1 price is what chance alone would lift its slope by.
    n1 = toxic.sum()
    weight = np.where(toxic == 1, 0.5 / n1, 0.5 / (n - n1))
    spread = np.bincount(column, weights=weight[owner], minlength=m)
    price = chance * 0.25 * np.sqrt(np.maximum(spread * (1 - spread), 1 / n1) * (1 / n1 + 1 / (n - n1)))
    w, _ = _descend(owner, column, weight, toxic, into, out, swap_weight * pay, price)
    used = np.flatnonzero(w)
    # Once more on the features that were found, nearly without a price.
    rename = np.full(m + 1, len(used))
    rename[used] = np.arange(len(used))
    held = rename[column] < len(used)
    w, bias = _descend(owner[held], rename[column[held]], weight, toxic, rename[into], rename[out], swap_weight * pay, np.full(len(used), 1e-4))
    return every[used], w, bias


def _descend(owner: np.ndarray, column: np.ndarray, weight: np.ndarray, toxic: np.ndarray, into: np.ndarray, out: np.ndarray, pay: np.ndarray, price: np.ndarray) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient steps; (weights, bias). owner and column are the nonzero entries.

    into and out are features or, for none, the number of features.
    """
    m, n = len(price), len(toxic)
    load = np.bincount(owner, minlength=n) + 1
    drawn = np.bincount(into, weights=pay, minlength=m + 1)[:m] + np.bincount(out, weights=pay, minlength=m + 1)[:m]
    step = 1 / (0.25 * float((weight * load).sum()) + 4 * float(drawn.max(initial=0.0)))
    w, v, bias, vb, t = np.zeros(m + 1), np.zeros(m + 1), 0.0, 0.0, 1.0
    price = np.append(price, 0.0)
    for _ in range(STEPS):
        logit = np.bincount(owner, weights=v[column], minlength=n) + vb
        error = weight * (1 / (1 + np.exp(-np.clip(logit, -35, 35))) - toxic)
        slope = np.bincount(column, weights=error[owner], minlength=m + 1).astype(np.float64)
        change = 2 * pay * (v[into] - v[out])
        slope += np.bincount(into, weights=change, minlength=m + 1) - np.bincount(out, weights=change, minlength=m + 1)
        new = v - step * slope
        new = np.sign(new) * np.maximum(np.abs(new) - step * price, 0)
        new[-1] = 0
        new_bias = vb - step * float(error.sum())
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t_next * (new - w), new_bias + (t - 1) / t_next * (new_bias - bias)
        w, bias, t = new, new_bias, t_next
    return w[:-1], float(bias)


def _scorer(features: np.ndarray, weights: np.ndarray, bias: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS)
        dense[features] = weights
        used = dense != 0
        for batch in batches:
            logits = np.full(batch.num_rows, bias)
            for a, words, first in words_of(batch.column("text")):
                own = features_of(words)
                at = np.flatnonzero(used[own])
                rows = np.searchsorted(first, at, "right") - 1
                distinct = np.unique((rows << BITS) | own[at])
                np.add.at(logits, a + (distinct >> BITS), dense[distinct & ((1 << BITS) - 1)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(logits, -35, 35))))], ["doc_id", "score"])

    return score


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on the labelled rows outside the held-out fold; labels has doc_id and toxic (1 toxic)."""
    common.prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where("doc_id is not null and toxic is not null").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    answers = {r[0]: r[1] for r in known.collect()}
    # At most fit_rows ids: a proven bound for the broadcast.
    ids = docs.sparkSession.createDataFrame([(i,) for i in answers], "doc_id long")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id", "left_semi")
    # One text an id: of several, the one of the least features.
    rows = texts.mapInArrow(_featured, "doc_id long, features array<int>").groupBy("doc_id").agg(F.min("features").alias("features")).toArrow()
    ids = rows.column("doc_id").to_pylist()
    order = sorted(range(len(ids)), key=ids.__getitem__)
    found = [np.array(rows.column("features")[i].as_py(), np.int64) for i in order]
    return fit(found, np.array([answers[ids[i]] for i in order]))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    common.prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = docs.mapInArrow(_scorer(*model), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6 over the whole documents table."""
    docs = common.table(spark, sf_dir, "documents")
    return score(docs, train(docs, common.table(spark, sf_dir, "labels")))
