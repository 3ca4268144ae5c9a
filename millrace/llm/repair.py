"""Token-ID output in a grammar-compressed binary format.

Documents are range-partitioned by doc_id, encoded, and gathered into shards of
about `SHARD_IDS` ids, in ascending doc_id order (equal ids by text). Each
shard is compressed by Re-Pair until no pair occurs LEAST_USES times: a round counts
the neighbouring pairs, replaces the most frequent ones by new symbols (where two
overlap the more frequent one, then the smaller; of a run of one pair every second from
the left; never across a document's end) and goes on with what is left. A pair that has
become rare stays rare, so a round looks only at pairs that may still be frequent and at
those with a new symbol. A shard's bytes hold the
rules, each symbol's expansion length and every document's place, so one
document, or a range of its ids, is decoded without the others.

Shards are rows (part, shard, n_ids, payload) of a table that Spark writes, so
a lost executor's shards are written again and any store that Spark knows will do.

Defined results: a null or empty text has the end id only, a very long one is a shard
by itself if need be; a null doc_id sorts first; repeated rows are all written; other columns are ignored; an empty table
gives an empty file set.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common
from .encode import encoder, tokenizer_path

END_ID = 2
SHARD_IDS = 1 << 19
MAGIC = b"RPG2"
#: A round replaces the pairs that occur over half as often as the most frequent one, and so many at least; one pair at a time would be plain Re-Pair.
PAIRS = 4096
#: A pair is replaced while it occurs so often.
LEAST_USES = 2
#: Up to so many shards (16 bytes each), their starts are broadcast; beyond it, joined.
BROADCAST_SHARDS = 1_000_000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_BITS = 20

SHARDS = "part int, shard int, n_docs long, n_ids long, payload binary"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _frequent(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that occur LEAST_USES times or more, overlaps included, in order, and how often."""
    ordered = np.sort(pair)
    begin = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] + np.uint64(1)))
    times = np.diff(np.append(begin, len(ordered)))
    often = times >= LEAST_USES
    return ordered[begin[often]], times[often]


def _chosen(which: np.ndarray, weight: np.ndarray, touch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the places, in order, are replaced, and which pairs lost a place to another pair.

    which is the pair of each place, weight tells which pair goes first (the highest), touch whether a place overlaps the next one.
    """
    own = weight[which]
    wins = np.ones(len(which), bool)
    wins[1:] &= ~touch | (own[1:] >= own[:-1])
    wins[:-1] &= ~touch | (own[:-1] >= own[1:])
    lost = np.zeros(len(weight), bool)
    lost[which[~wins]] = True
    same = np.zeros(len(which), bool)
    same[1:] = touch & (which[1:] == which[:-1])
    if same.any():
        at = np.arange(len(which))
        wins &= (at - np.maximum.accumulate(np.where(same, 0, at))) & 1 == 0
    return wins, lost


def compress(ids: np.ndarray, ends: np.ndarray, first_symbol: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair of one shard: (symbols, where each document's symbols end, rules of two symbols, how many ids each rule stands for).

    ids holds all documents' ids, ends where each document ends in it; symbols of
    first_symbol or more are rules, in order. The sequence stays in place as a linked list.
    """
    n = len(ids)
    seq, following, preceding = ids.astype(np.uint32), np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    last, gone = np.zeros(n, bool), np.zeros(n, bool)
    last[ends[ends > 0] - 1] = True
    # Places whose pair may be frequent.
    open_ = ~last
    lengths = np.ones(first_symbol, np.uint32)
    table = np.full(1 << _BITS, -1, np.int32)
    rules: list[np.ndarray] = []
    made = first_symbol
    while True:
        at = np.flatnonzero(open_)
        pair = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[following[at]]
        found, times = _frequent(pair) if len(at) else (pair, at)
        if not len(found):
            break
        # Frequent pairs by hash: of two in one slot, the other has its turn later.
        slot = (found * _SPREAD) >> np.uint64(64 - _BITS)
        table[slot] = np.arange(len(found), dtype=np.int32)
        which = table[(pair * _SPREAD) >> np.uint64(64 - _BITS)]
        own = table[slot] == np.arange(len(found))
        table[slot] = -1
        open_[at[which < 0]] = False
        weight = (times << 32) - np.arange(len(found))
        taken = own & (2 * times > times.max())
        if len(found) <= PAIRS:
            taken = own
        elif np.count_nonzero(taken) < PAIRS:
            taken = own & (weight >= np.partition(weight, -PAIRS)[-PAIRS])
        fits = (which >= 0) & taken[which]
        at, which, pair = at[fits], which[fits], pair[fits]
        fits = found[which] == pair
        at, which = at[fits], which[fits]
        wins, lost = _chosen(which, weight, following[at[:-1]] == at[1:])
        enough = np.bincount(which[wins], minlength=len(found)) >= LEAST_USES
        # Too few places, though none was lost to another pair: they overlap each other.
        open_[at[(~enough & ~lost)[which]]] = False
        wins &= enough[which]
        at, which = at[wins], which[wins]
        if not len(at):
            continue
        rules.append(found[enough])
        lengths = np.concatenate([lengths, lengths[rules[-1] >> np.uint64(32)] + lengths[rules[-1] & np.uint64(0xFFFFFFFF)]])
        right = following[at]
        seq[at] = (np.cumsum(enough) - 1 + made)[which]
        made += int(enough.sum())
        last[at] = last[right]
        gone[right], open_[right] = True, False
        following[at] = following[right]
        preceding[following[right]] = at
        open_[at] = ~last[at]
        before = preceding[at]
        before = before[before >= 0]
        open_[before] = ~last[before]
    pairs = np.concatenate(rules) if rules else np.zeros(0, np.uint64)
    closed = np.cumsum(~gone)[last & ~gone]
    places = np.zeros(len(ends), np.int64)
    places[np.diff(ends, prepend=0) > 0] = closed
    places = np.maximum.accumulate(places) if len(places) else places
    return seq[~gone], places, np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32), lengths[first_symbol:]


def _packed(numbers: np.ndarray, bits: int) -> bytes:
    """Unsigned numbers in so many bits each."""
    raised = numbers.astype(np.uint64)
    out = np.zeros(len(raised) * bits // 64 + 2, np.uint64)
    at = np.arange(len(raised), dtype=np.int64) * bits
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    np.bitwise_or.at(out, word, raised << shift)
    over = shift + np.uint64(bits) > np.uint64(64)
    np.bitwise_or.at(out, word[over] + 1, raised[over] >> (np.uint64(64) - shift[over]))
    return out.astype("<u8").tobytes()


def _unpacked(words: np.ndarray, n: int, bits: int) -> np.ndarray:
    at = np.arange(n, dtype=np.int64) * bits
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    # Shifted in two steps: a shift by 64 is undefined.
    high = words[word + 1] << (np.uint64(63) - shift) << np.uint64(1)
    return ((words[word] >> shift | high) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def dump(doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray) -> bytes:
    """A shard's bytes: header, document ids, places, id counts and the shard's own ids, then rules, expansion lengths and symbols in as few bits as hold them.

    Symbols below `first` number the shard's own ids in order, those from there on its rules.
    """
    own = np.flatnonzero(np.bincount(ids)) if len(ids) else np.zeros(0, np.int64)
    number = np.zeros(int(own[-1]) + 1 if len(own) else 0, np.uint32)
    number[own] = np.arange(len(own))
    first = len(own)
    seq, places, rules, lengths = compress(number[ids], ends, first)
    bits, length_bits = max(1, (first + len(rules)).bit_length()), int(lengths.max(initial=1)).bit_length()
    known = np.array([d is not None for d in doc_ids], np.uint8)
    head = struct.pack("<4sIIIQBB", MAGIC, len(doc_ids), first, len(rules), len(seq), bits, length_bits)
    return b"".join([
        head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), known.tobytes(), places.astype("<i8").tobytes(), np.diff(ends, prepend=0).astype("<i8").tobytes(),
        own.astype("<u4").tobytes(), _packed(rules.ravel(), bits), _packed(lengths, length_bits), _packed(seq, bits),
    ])


class Shard:
    """Random access to a shard's bytes."""

    def __init__(self, payload: bytes) -> None:
        head = "<4sIIIQBB"
        magic, docs, self.first, rules, symbols, bits, length_bits = struct.unpack_from(head, payload)
        if magic != MAGIC:
            raise ValueError("not a shard of this format")
        at = struct.calcsize(head)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(payload, kind, n, at)
            at += got.nbytes
            return got

        def numbers(n: int, bits: int) -> np.ndarray:
            return _unpacked(take("<u8", n * bits // 64 + 2), n, bits)

        ids, known = take("<i8", docs), take("<u1", docs)
        self.doc_ids = [d if k else None for d, k in zip(ids.tolist(), known.tolist(), strict=True)]
        self.places, self.counts, self.own = take("<i8", docs), take("<i8", docs), take("<u4", self.first)
        self.rules, self.rule_lengths = numbers(2 * rules, bits).reshape(-1, 2), numbers(rules, length_bits)
        self.symbols = numbers(symbols, bits)
        self._flat: np.ndarray | None = None

    def _expansions(self) -> None:
        """All expansions one after another, the shard's own ids first."""
        lengths = np.concatenate([np.ones(self.first, np.int64), self.rule_lengths.astype(np.int64)])
        self._starts = np.cumsum(lengths) - lengths
        self._lengths = lengths
        flat = np.empty(int(lengths.sum()), np.uint32)
        flat[: self.first] = self.own
        # Of ascending lengths: a rule's two symbols are shorter than itself.
        order = np.argsort(self.rule_lengths, kind="stable")
        sizes, begin = np.unique(self.rule_lengths[order], return_index=True)
        for size, own in zip(sizes.tolist(), np.split(order, begin[1:])):
            a, b = self.rules[own, 0], self.rules[own, 1]
            step, cut = np.arange(size), lengths[a][:, None]
            flat[self._starts[self.first + own][:, None] + step] = flat[np.where(step < cut, self._starts[a][:, None] + step, self._starts[b][:, None] + step - cut)]
        self._flat = flat

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of a run of symbols."""
        if self._flat is None:
            self._expansions()
        lengths = self._lengths[symbols]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self._flat[np.repeat(self._starts[symbols] - (ends - lengths), lengths) + np.arange(total)]

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document."""
        return self.expand(self.symbols[self.places[i - 1] if i else 0 : self.places[i]])

    def ids(self, i: int, start: int, end: int) -> np.ndarray:
        """Ids start to end of the i-th document: only the symbols that hold them are expanded."""
        if self._flat is None:
            self._expansions()
        own = self.symbols[self.places[i - 1] if i else 0 : self.places[i]]
        ends = np.cumsum(self._lengths[own])
        a, b = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(ends, end, side="left")) + 1
        before = int(ends[a - 1]) if a else 0
        return self.expand(own[a:b])[start - before : end - before]


def _writer(path: str, end_id: int, shard_ids: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, enc, end = context.partitionId() if context else 0, encoder(path), end_id.to_bytes(4, "little")
        docs: list[int | None] = []
        held: list[bytes] = []
        size = shard = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            ends = np.cumsum([len(x) // 4 for x in held])
            row = [[part], [shard], [len(docs)], [len(ids)], [dump(docs, ids, ends)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["part", "shard", "n_docs", "n_ids", "payload"])

        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), enc.encode_column(batch.column("text")), strict=True):
                docs.append(doc)
                held.append(ids.tobytes() + end)
                size += len(ids) + 1
                if size >= shard_ids:
                    yield flush()
                    docs, held, size, shard = [], [], 0, shard + 1
        if docs:
            yield flush()

    return write


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode all documents and write the shards to a folder of any store that Spark knows."""
    common.prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text").mapInArrow(_writer(path or tokenizer_path(), end_id, shard_ids), SHARDS).write.parquet(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, payload in zip(batch.column("start").to_pylist(), batch.column("payload"), strict=True):
            shard = Shard(payload.as_py())
            every = shard.expand(shard.symbols).astype("<u4").tobytes()
            ends = np.cumsum(shard.counts)
            begins = ends - shard.counts
            crc = [zlib.crc32(every[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), pa.array(begins + start), pa.array(shard.counts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, decoded from the shards: doc_id, start, n_tokens, ids_crc32.

    Starts are prefix sums in two levels: over the partitions (as many rows as the
    range partitioning made), and over the shards of each.
    """
    common.prepare(spark)
    shards = spark.read.schema(SHARDS).parquet(folder)
    sizes = shards.select("part", "shard", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("shard").rowsBetween(W.unboundedPreceding, 0)) - F.col("n_ids")
    starts = sizes.select("part", "shard", inside.alias("inside")).join(parts, "part").select("part", "shard", (F.col("before") + F.col("inside")).alias("start"))
    if sizes.count() <= BROADCAST_SHARDS:
        starts = F.broadcast(starts)
    return shards.select("part", "shard", "payload").join(starts, ["part", "shard"]).select("start", "payload").mapInArrow(_read, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5 over the whole documents table: written, then read back."""
    folder = common.scratch(spark, "token-ids")
    write(common.table(spark, sf_dir, "documents"), folder)
    return read(spark, folder)
