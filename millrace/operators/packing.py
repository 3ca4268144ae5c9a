"""Next-fit packing of token sequences into fixed lengths, masks and boundaries."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR, PAD, MOST_BOUNDARIES = 1, 0, 10


#: Orders that are packed together.
SPAN = 1_000_000


def assign(lengths: DataFrame, limit: int, span: int = SPAN) -> DataFrame:
    """(shard, ord, length, pack, offset) from rows (ord, length).

    Next fit is a fold in input order: each sequence, cut to the limit, goes after a separator into the
    open pack or opens the next. Only (ord, length) pairs reach it. A shard is `span` orders from a
    multiple of it on; shards are packed by themselves, each with at most one more pack than one
    fold over all would make.
    """
    own = F.col("ord").cast("long")
    rows = lengths.select(F.floor(own / span).cast("long").alias("shard"), own.alias("ord"), F.least(F.col("length").cast("long"), F.lit(limit)).alias("length"))

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack, used, last = 0, 0, None
        for part in parts:
            packs, offsets = [], []
            for shard, length in zip(part["shard"].tolist(), part["length"].tolist(), strict=True):
                if shard != last:
                    pack, used, last = 0, 0, shard
                if used and used + 1 + length > limit:
                    pack, used = pack + 1, 0
                at = used + 1 if used else 0
                packs.append(pack)
                offsets.append(at)
                used = at + length
            yield part.assign(pack=packs, offset=offsets)[["shard", "ord", "length", "pack", "offset"]]

    return rows.repartition("shard").sortWithinPartitions("shard", "ord").mapInPandas(fold, "shard long, ord long, length long, pack long, offset long")


def mask(tokens: Column, marker: int) -> Column:
    """1 for what follows the first marker, 0 before it, at it and without one."""
    at = F.array_position(tokens, F.lit(marker))
    return F.transform(tokens, lambda _, i: F.when((at > 0) & (i >= at), 1).otherwise(0).cast("tinyint"))


def subsequence(tokens: Column, marker: list[int]) -> Column:
    """Positions from 0 at which a run of ids begins."""
    m = F.array(*map(F.lit, marker))
    last = F.size(tokens) - len(marker)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), lambda i: F.slice(tokens, i + 1, len(marker)) == m)).otherwise(F.array().cast("array<int>"))


def zero_fraction(n: Column, boundary: Column) -> Column:
    """The masked share of a shifted sequence of n tokens with its boundary."""
    return F.when((boundary < 0) | (n <= 1), F.lit(0.0)).otherwise(F.least(boundary, n - 1) / (n - 1))


def padded(tokens: Column, limit: int, multiple: int = 32) -> Column:
    """Cut to the limit and padded to one more than a multiple, the limit at most."""
    cut = F.slice(tokens, 1, limit)
    size = F.least(F.lit(limit), 1 + multiple * F.ceil(F.size(cut) / multiple))
    return F.concat(cut, F.array_repeat(F.lit(PAD), F.greatest(F.lit(0), size - F.size(cut)).cast("int")))


def packed(tokens: DataFrame, places: DataFrame, limit: int, marker: int, weight: str | None = None) -> DataFrame:
    """(shard, pack, ids, mask, boundaries, weights) from (ord, tokens) and `assign`'s places.

    One pack's sequences hold at most `limit` ids together, so a group is bounded.
    """
    cut = F.slice("tokens", 1, limit)
    at = F.array_position(cut, F.lit(marker)) - 1
    own = tokens.select("ord", cut.alias("t"), mask(cut, marker).alias("m"), F.when(at >= 0, at).alias("b"), (F.col(weight) if weight else F.lit(1.0)).cast("float").alias("w")).join(places, "ord")
    rows = F.array_sort(F.collect_list(F.struct("offset", "t", "m", "b", "w")))
    own = own.groupBy("shard", "pack").agg(rows.alias("r"))

    def joined(name: str, gap, cast: str):
        pieces = F.transform("r", lambda x, i: F.concat(F.when(i > 0, F.array(F.lit(gap).cast(cast))).otherwise(F.array().cast(f"array<{cast}>")), (x["t"] if name == "t" else x["m"] if name == "m" else F.transform(x["m"], lambda v: v * x["w"])).cast(f"array<{cast}>")))
        flat = F.flatten(pieces)
        return F.concat(flat, F.array_repeat(F.lit(PAD).cast(cast), F.lit(limit) - F.size(flat)))

    bounds = F.slice(F.filter(F.transform("r", lambda x: (x["offset"] + x["b"]).cast("int")), lambda v: v.isNotNull()), 1, MOST_BOUNDARIES)
    bounds = F.concat(bounds, F.array_repeat(F.lit(-1), F.lit(MOST_BOUNDARIES) - F.size(bounds)))
    return own.select("shard", "pack", joined("t", SEPARATOR, "int").alias("ids"), joined("m", 0, "tinyint").alias("mask"), bounds.alias("boundaries"), joined("w", 0.0, "float").alias("weights"))


def token_weight(token: Column) -> Column:
    """5 for structure, 2 for commands, 1 for coordinates and all else."""
    return F.when(token.rlike(r"\A[{}\[\];,\\]+\z"), 5.0).when(token.rlike(r"\A\\[A-Za-z@]+\z"), 2.0).otherwise(1.0)
