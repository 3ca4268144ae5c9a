"""Benchmark decontamination by spaced-seed hashing.

Words are folded (A-Z lower-cased, ASCII punctuation as space). Fixed masks of
SPAN words select which of them enter a hash, so a substituted word at an ignored
place leaves the hash as it was. Hashes of all benchmark windows are joined with
those of all document windows; around every hit the two word sequences are laid
on each other at the hit's shift, and a leak is a window of WINDOW words (the whole
item, if that is shorter) of which at least PERCENT percent agree.

Every qualifying overlap is hit: any two substitutions in WINDOW words leave a window
of one of the masks untouched; items shorter than WINDOW have masks of their own
length, which leave out every two (of SPAN words: one) of several groups of places.

Equal item texts are looked for once. The benchmark is taken in blocks of at most
BLOCK_WORDS words, each sent to the tasks whole; the documents are scanned once a
block, rows are the same for any number of blocks. Documents are never shuffled, and a
task holds one batch of texts; only with several blocks, (doc_id, digest) of the
documents is joined with the leaks.

Defined results: null and empty texts and items have no words and match nothing;
an item of fewer than SPAN words is looked for whole and exactly; very long texts and
items are taken whole; items of equal text are each reported, one without an item_id as
null, after the others; of several items the most agreeing words and the largest share
count; repeated documents are each judged; other columns are ignored (or kept by
`clean`); without benchmark rows every document is clean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .kernel import fold, text_chunks, word_edges, word_hashes

#: Any two substitutions in 12 neighbouring words leave a window of one of these untouched.
MASKS = ("111111000", "101010111", "111010011", "110001111", "110110101")
SPAN = 9
WINDOW = 12
PERCENT = 80
BLOCK_WORDS = 400_000
_BITS = 22

_FACTORS = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64) for i in range(1, 17)], np.uint64)


def words_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, first word of each row) of runs of a column's texts."""
    for a, _, data, offsets in text_chunks(column):
        data = fold(data)
        starts, ends, first = word_edges(data, offsets)
        yield a, word_hashes(data, starts, ends, lower=False), first


def masked(words: np.ndarray, mask: str) -> np.ndarray:
    """A hash of the selected words of each window."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(mask) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i, mark in enumerate(mask):
        if mark == "1":
            out += words[i : i + n] * _FACTORS[i]
    return out


def masks_of(size: int) -> list[str]:
    """Masks for items of so many words: whatever may be substituted in a qualifying window leaves one of them untouched.

    Items shorter than WINDOW lie whole in theirs. Their places are dealt into groups, two
    (one) of which a mask leaves out: two (one) substitutions lie in no more groups.
    """
    if size >= WINDOW:
        return list(MASKS)
    if size < SPAN:
        return ["1" * size]
    gone = size - -(-size * PERCENT // 100)
    groups = 5 if gone == 2 else 3
    return ["".join("0" if i % groups in out else "1" for i in range(size)) for out in combinations(range(groups), gone)]


class Index:
    """Masked hashes of the windows of some benchmark items: distinct texts, each with its ids."""

    def __init__(self, items: list[list[int | None]], texts: list[str]) -> None:
        self.items, self.words = items, []
        for _, words, first in words_of(pa.array(texts, pa.string())):
            self.words += [words[a:b].copy() for a, b in zip(first[:-1], first[1:], strict=True)]
        sizes = {min(len(w), WINDOW) for w in self.words if len(w)}
        self.masks: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for size, mask in [(size, mask) for size in sorted(sizes) for mask in masks_of(size)]:
            found = [(i, masked(w, mask)) for i, w in enumerate(self.words) if min(len(w), WINDOW) == size]
            hashes = np.concatenate([h for _, h in found])
            owner = np.repeat([i for i, _ in found], [len(h) for _, h in found])
            place = np.concatenate([np.arange(len(h)) for _, h in found])
            order = np.argsort(hashes, kind="stable")
            seen = np.zeros(1 << _BITS, bool)
            seen[hashes >> np.uint64(64 - _BITS)] = True
            self.masks[mask] = (hashes[order], owner[order], place[order], seen)

    def leaks(self, words: np.ndarray, first: np.ndarray) -> dict[int, list[tuple[int | None, int, float]]]:
        """By row: (item id, agreeing words at the best shift, their share) of each leaked item."""
        hits: set[tuple[int, int, int]] = set()
        for mask, (hashes, owner, place, seen) in self.masks.items():
            own = masked(words, mask)
            at = np.flatnonzero(seen[own >> np.uint64(64 - _BITS)])
            low, high = np.searchsorted(hashes, own[at], "left"), np.searchsorted(hashes, own[at], "right")
            at, low, high = at[high > low], low[high > low], high[high > low]
            rows = np.searchsorted(first, at, "right") - 1
            inside = at + len(mask) <= first[rows + 1]
            for p, row, a, b in zip(at[inside].tolist(), rows[inside].tolist(), low[inside].tolist(), high[inside].tolist(), strict=True):
                hits.update((row, int(owner[j]), p - int(place[j])) for j in range(a, b))
        best: dict[int, dict[int, tuple[int, float]]] = {}
        for row, item, shift in hits:
            test = self.words[item]
            begin, end = max(shift, int(first[row])), min(shift + len(test), int(first[row + 1]))
            size = min(WINDOW, len(test))
            if end - begin < size:
                continue
            sums = np.zeros(end - begin + 1, np.int64)
            np.cumsum(words[begin:end] == test[begin - shift : end - shift], out=sums[1:])
            most = int((sums[size:] - sums[:-size]).max())
            exact = len(test) < SPAN
            if most == size if exact else 100 * most >= PERCENT * size:
                kept = best.setdefault(row, {})
                kept[item] = max(kept.get(item, (0, 0.0)), (int(sums[-1]), int(sums[-1]) / len(test)))
        return {row: [(item, n, share) for i, (n, share) in sorted(kept.items()) for item in self.items[i]] for row, kept in best.items()}


def _by_id(items: set[int | None]) -> list[int | None]:
    return sorted(items, key=lambda i: (i is None, i or 0))


def _reporter(index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items: list[list[int | None]] = [[] for _ in range(batch.num_rows)]
            matched, overlap = [0] * batch.num_rows, [0.0] * batch.num_rows
            for a, words, first in words_of(batch.column("text")):
                for row, found in index.leaks(words, first).items():
                    items[a + row] = _by_id({i for i, _, _ in found})
                    matched[a + row], overlap[a + row] = max(k for _, k, _ in found), max(s for _, _, s in found)
            own = [batch.column("doc_id"), batch.column("tag"), pa.array(items, pa.list_(pa.int64())), pa.array(matched, pa.int64()), pa.array(overlap, pa.float64())]
            yield pa.RecordBatch.from_arrays(own, ["doc_id", "tag", "items", "matched", "overlap"])

    return find


def _dropper(index: Index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = np.ones(batch.num_rows, bool)
            for a, words, first in words_of(batch.column("text")):
                stays[[a + row for row in index.leaks(words, first)]] = False
            yield batch.filter(pa.array(stays))

    return drop


def _blocks(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes over all items, each over about BLOCK_WORDS words of distinct texts."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-total // (5 * BLOCK_WORDS)))
    for i in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i).collect()
        items: dict[str, set[int | None]] = {}
        for item, text in own:
            items.setdefault(text, set()).add(item)
        if items:
            texts = sorted(items)
            yield Index([_by_id(items[t]) for t in texts], texts)


_FOUND = "doc_id long, tag string, items array<long>, matched long, overlap double"


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: which items leaked into it, the most agreeing words, their share of the item, and kept."""
    common.prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    indexes = list(_blocks(benchmark))
    if len(indexes) == 1:
        out = docs.select("doc_id", F.lit(None).cast("string").alias("tag"), "text").mapInArrow(_reporter(indexes[0]), _FOUND)
    else:
        # A document's leaks of all blocks, by its id and its text's digest; equal rows have equal leaks.
        tagged = docs.select("doc_id", F.md5("text").alias("tag"), "text")
        found = tagged.limit(0).mapInArrow(_reporter(Index([], [])), _FOUND)
        for index in indexes:
            found = found.union(tagged.mapInArrow(_reporter(index), _FOUND).where("size(items) > 0"))
        items = F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))))
        found = common.keep(found.groupBy(F.col("doc_id").alias("own_id"), F.col("tag").alias("own_tag")).agg(items.alias("items"), F.max("matched").alias("matched"), F.max("overlap").alias("overlap")), "leaks")
        out = tagged.select("doc_id", "tag").join(found, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("tag") == F.col("own_tag")), "left")
        out = out.select("doc_id", F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("matched", F.lit(0)).alias("matched"), F.coalesce("overlap", F.lit(0.0)).alias("overlap"))
    n = F.size("items")
    return out.select("doc_id", n.cast("long").alias("n_items"), F.col("items").alias("item_ids"), F.col("matched").alias("matched_words"), "overlap", (n == 0).alias("kept"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak; their columns, whatever they are, stay as they are."""
    common.prepare(docs.sparkSession)
    for index in _blocks(benchmark):
        docs = docs.mapInArrow(_dropper(index), docs.schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4 over the whole documents and benchmark tables."""
    return report(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
