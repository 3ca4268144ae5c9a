"""Near-duplicate groups by min-max hashing.

A document's shingle hashes go through `HASHES` mixing functions; of each both
the minimum and the maximum are kept, so the signature has twice as many values
as functions evaluated. Values are grouped into bands. Documents with equal
shingle sets (by a 128-bit digest) form one class; from then on only classes count,
under ids of their own.

Links: in each band bucket every member is tried against the bucket's hub, its least
member, and the links found are joined to components. Buckets whose members then lie
in several components are gone through once more, in blocks of bounded size; pairs of
two blocks of the bucket's largest component are left out. All links are confirmed on
full shingle sets, whatever the bucket's size. A pair of similarity 0.8 shares no
band, and could be missed, with probability 3e-6.

Memory: a task holds one batch of texts, or one hub's set and a batch of others, or two
blocks of up to BLOCK_BYTES of sets (or a single set, if that is larger). Hubs of many
members are dealt out in parts, and a hub's set is sent once a part.

Defined results: a null or empty text, or one without words, has 0 shingles and is
linked with nothing; so is a row without doc_id; a text of fewer than k words is one
shingle of them all, a very long one is taken whole; ties of equal texts go to the
smallest doc_id; rows that repeat a doc_id are judged each by its own text, and
`clean` leaves one of equal rows; an empty table gives no rows; other columns, whatever
their names, are ignored. Lower-casing is that of A-Z alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .kernel import mix, shingle_sets, text_chunks, word_edges, word_hashes
from .links import components

HASHES = 80
BANDS = 32
ROWS = 2 * HASHES // BANDS
#: Most members and bytes of shingle sets of a block; two blocks are compared at once.
BLOCK = 256
BLOCK_BYTES = 4 << 20
#: Most members, and bytes of their shingle sets, that are held against one hub in one place.
STAR = 512
STAR_BYTES = 32 << 20
#: Up to so many candidate ids or keys (24 bytes each) are broadcast; beyond it they are joined.
BROADCAST_IDS = 200_000

_RNG = np.random.default_rng(20240229)
_XOR = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_MUL = _RNG.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of the mixed shingle hashes."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(HASHES, 0xFFFFFFFF, np.uint32), np.zeros(HASHES, np.uint32)
    for at in range(0, len(short), 2048):
        x = (short[at : at + 2048, None] ^ _XOR) * _MUL
        x ^= x >> np.uint32(15)
        low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
    return np.concatenate([low, high])


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[np.ndarray]:
    for a, b, data, offsets in text_chunks(batch.column("text")):
        starts, ends, first = word_edges(data, offsets)
        words = word_hashes(data, starts, ends, lower=True)
        for i in range(b - a):
            yield shingle_sets(words[first[i] : first[i + 1]], k)


_SIGNED = "doc_id long, tag string, n_shingles long, d1 long, d2 long, bands array<long>"


def _digest(found: np.ndarray) -> tuple[np.int64, np.int64]:
    """128 bits that tell shingle sets apart."""
    return np.bitwise_xor.reduce(mix(found)).view(np.int64), np.add.reduce(mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5))).view(np.int64)


def _signer(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            n, d1, d2, bands = [], [], [], []
            for found in _sets(batch, k):
                n.append(len(found))
                if not len(found):
                    d1.append(None), d2.append(None), bands.append(None)
                    continue
                for kept, own in zip((d1, d2), _digest(found), strict=True):
                    kept.append(own)
                rows = signature(found).reshape(BANDS, ROWS).astype(np.uint64)
                key = salt.copy()
                for j in range(ROWS):
                    key = mix(key ^ rows[:, j])
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "tag", "n_shingles", "d1", "d2", "bands"])

    return sign


def _setter(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2, sets, size = [], [], [], 0
            for found in _sets(batch, k):
                if not len(found):
                    continue
                for kept, own in zip((d1, d2), _digest(found), strict=True):
                    kept.append(own)
                sets.append(found.tobytes())
                size += found.nbytes
                if size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sets, pa.binary())], ["d1", "d2", "shingles"])
                    d1, d2, sets, size = [], [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sets, pa.binary())], ["d1", "d2", "shingles"])

    return give


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct hashes."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _star_links(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links (a, b) of rows (a, part, b, shingles) sorted so that a hub's own row, of null b, comes before its members."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            held = []
            for b, shingles in zip(batch.column("b").to_pylist(), batch.column("shingles"), strict=True):
                own = np.frombuffer(shingles.as_buffer(), np.uint64)
                if b is None:
                    hub = own.copy()
                held.append(b is not None and linked(hub, own, percent))
            held = pa.array(held, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(held), batch.column("b").filter(held)], ["a", "b"])

    return confirm


def _across(ids: np.ndarray, comp: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between members of `left` and of `right` that lie in different components, thinned to those that join something."""
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    number = np.empty(len(flat), np.int64)
    number[order] = np.cumsum(np.concatenate([[False], ranked[1:] != ranked[:-1]]))
    posts, begin = owner[order], np.searchsorted(number[order], np.arange(number[order[-1]] + 2))
    at = np.cumsum(sizes) - sizes
    parent = {int(c): int(c) for c in comp}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    out = []
    for i in np.flatnonzero(left):
        own = number[at[i] : at[i] + sizes[i]]
        lengths = begin[own + 1] - begin[own]
        ends = np.cumsum(lengths)
        near = posts[np.repeat(begin[own] - (ends - lengths), lengths) + np.arange(int(ends[-1]))]
        both = np.bincount(near, minlength=len(sets))
        good = (100 * both >= percent * (sizes + sizes[i] - both)) & right & (comp != comp[i])
        for j in np.flatnonzero(good):
            x, y = root(int(comp[i])), root(int(comp[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((int(ids[i]), int(ids[j])))
    return out


def _block_links(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links (a, b) across components of rows sorted by (hub, one, two), a group of which is a pair of blocks."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []

        def close() -> None:
            if len(rows) < 2 or len({c for _, _, c, _ in rows}) < 2:
                return
            block, ids, comp = (np.array([r[i] for r in rows]) for i in range(3))
            out.extend(_across(ids, comp, [r[3] for r in rows], block == key[1], block == key[2], percent))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("hub", "one", "two", "block", "rid", "component")]
            for hub, one, two, block, rid, component, shingles in zip(*columns, batch.column("shingles"), strict=True):
                if (hub, one, two) != key:
                    close()
                    key, rows = (hub, one, two), []
                rows.append((block, rid, component, np.frombuffer(shingles.as_py(), np.uint64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    return compare


def _few(df: DataFrame) -> DataFrame:
    """A written table of ids or keys, broadcast where its size allows that."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def _stars(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members and their hubs: (a, b)."""
    stars = members.where(f"rid <> hub and 100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)").select(F.col("hub").alias("a"), F.col("rid").alias("b"), "n").distinct()
    parts = stars.groupBy("a").agg(F.greatest(F.ceil(8 * F.sum("n") / STAR_BYTES), F.ceil(F.count(F.lit(1)) / STAR)).cast("int").alias("parts"))
    others = stars.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b").join(sets.withColumnRenamed("rid", "b"), "b")
    hubs = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b")).join(sets.withColumnRenamed("rid", "a"), "a")
    rows = hubs.select("a", "part", "b", "shingles").union(others.select("a", "part", "b", "shingles"))
    return rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first()).mapInArrow(_star_links(percent), "a long, b long")


def _blocks(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components among members (hub, rid, n, component) of one hub's buckets."""
    comps = mixed.groupBy("hub", "component").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"))
    hubs = comps.groupBy("hub").agg(F.max_by("component", "c").alias("bulk"), F.max("c").alias("c_bulk"), F.max_by("w", "c").alias("w_bulk"), F.sum("c").alias("c_all"), F.sum("w").alias("w_all"))
    share = lambda c, w: F.greatest(F.ceil(c / BLOCK), F.ceil(8 * w / BLOCK_BYTES)).cast("int")
    hubs = hubs.select("hub", "bulk", share(F.col("c_bulk"), F.col("w_bulk")).alias("p"), share(F.col("c_all") - F.col("c_bulk"), F.col("w_all") - F.col("w_bulk")).alias("q"))
    # Written first, so that the join with a hub of very many members is split.
    hubs = common.keep(hubs, "bulks")
    place = F.xxhash64("rid")
    placed = mixed.join(_few(hubs), "hub").withColumn("in_bulk", F.col("component") == F.col("bulk"))
    placed = placed.withColumn("block", F.when(F.col("in_bulk"), F.pmod(place, F.col("p"))).otherwise(F.col("p") + F.pmod(place, F.col("q"))).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.when(F.col("in_bulk"), F.col("p")).otherwise(0), F.col("p") + F.col("q") - 1)))
    rows = placed.join(sets, "rid").select("hub", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "rid", "component", "shingles")
    return rows.repartition("hub", "one", "two").sortWithinPartitions("hub", "one", "two", "rid").mapInArrow(_block_links(percent), "a long, b long")


def _grouped(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """(doc_id, tag, n_shingles, component_id) of every row, and the written tables that it is read from."""
    spark = docs.sparkSession
    common.prepare(spark)
    signed = common.keep(docs.select("doc_id", "tag", "text").mapInArrow(_signer(k), _SIGNED), "signed")
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    # One row a class; written at once, so that its ids stay what they are.
    reps = filled.groupBy("d1", "d2").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    reps = common.keep(reps.select(F.monotonically_increasing_id().alias("rid"), "d1", "d2", "least", "n", "bands"), "representatives")

    # Buckets of two or more and their hubs, then the members.
    spread = reps.select("rid", "n", F.explode("bands").alias("key"))
    hubs = common.keep(spread.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("rid").alias("hub"), F.min_by("n", "rid").alias("hub_n")).where("m > 1").drop("m"), "hubs")
    members = common.keep(spread.join(_few(hubs), "key"), "members")

    # Shingle sets of the members alone, told apart by digest where rows repeat a doc_id.
    wanted = common.keep(reps.select("rid", "d1", "d2", "least").join(members.select("rid").distinct(), "rid", "left_semi"), "wanted")
    texts = docs.select("doc_id", "text").join(_few(wanted.select(F.col("least").alias("doc_id"))), "doc_id", "left_semi").select("text")
    found = texts.mapInArrow(_setter(k), "d1 long, d2 long, shingles binary")
    sets = common.keep(found.join(_few(wanted), ["d1", "d2"]).groupBy("rid").agg(F.first("shingles").alias("shingles")), "sets")

    # First pass: members against their hubs.
    links = common.keep(_stars(members, sets, percent), "stars")
    known = components(links)

    # Second pass: what still lies in several components of one bucket.
    placed = common.keep(members.join(known.select(F.col("node").alias("rid"), "component"), "rid", "left").withColumn("component", F.coalesce("component", "rid")), "placed")
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    mixed = common.keep(placed.join(several, "key").select("hub", "rid", "n", "component").distinct(), "mixed")
    more = common.keep(_blocks(mixed, sets, percent), "blocks")
    if not more.isEmpty():
        common.discard(known)
        known = components(links.union(more))

    # Back to all rows: component by class, its smallest doc_id, then classes by digest.
    # Written first: a join of two plain tables is split where one digest has very many documents.
    linked_reps = common.keep(reps.select("rid", "d1", "d2", "least").join(known.withColumnRenamed("node", "rid"), "rid"), "linked")
    names = linked_reps.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = linked_reps.join(names, "component").select("rid", "component_id")
    classes = common.keep(reps.select("rid", "d1", "d2", "least").join(classes, "rid", "left").select("d1", "d2", F.coalesce("component_id", "least").alias("component_id")), "classes")
    common.discard(reps, hubs, members, wanted, sets, links, known, placed, mixed, more, linked_reps)
    joined = filled.select("doc_id", "tag", "n_shingles", "d1", "d2").join(classes, ["d1", "d2"]).select("doc_id", "tag", "n_shingles", "component_id")
    rest = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "tag", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.union(rest), [signed, classes]


def groups(docs: DataFrame, k: int, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: groups of linked documents.

    component_id is the smallest doc_id reachable over links, kept marks that document.
    """
    found, _ = _grouped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("string").alias("tag"), F.col("text").cast("string").alias("text")), k, percent)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def clean(docs: DataFrame, k: int, percent: int = 80) -> DataFrame:
    """One document of each group, the one of the smallest doc_id, with its columns as they are; of rows equal in doc_id and text one stays."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("tag"), F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    found, parts = _grouped(rows.drop("row"), k, percent)
    doomed = found.groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("copies"), F.first(F.col("doc_id") == F.col("component_id")).alias("first"), F.first("n_shingles").alias("n"))
    doomed = common.keep(doomed.where("doc_id is not null and n > 0 and (copies > 1 or not first)").select("doc_id", "tag", "first"), "doomed")
    common.discard(*parts)
    rows = rows.drop("text")
    kept = rows.join(_few(doomed), ["doc_id", "tag"], "left_anti").select("row")
    again = doomed.where("first").select("doc_id", "tag")
    if not again.isEmpty():
        kept = kept.union(rows.join(_few(again), ["doc_id", "tag"], "left_semi").dropDuplicates(["doc_id", "tag"]).select("row"))
    return kept.select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3 over the whole documents table: 4-word shingles, similarity of 0.8 or more."""
    return groups(common.table(spark, sf_dir, "documents"), k=4)
