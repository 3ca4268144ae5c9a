"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in
alternation, user first and assistant last. Dynamic programming over that automaton
(a state is the role of the turn written last) chooses for every turn a role and
whether it opens a turn, after empty turns put in where needed, or is merged into
the turn before it. Costs: RELABEL for another role than the row's (UNKNOWN for a
null or unknown one), MERGE, and INSERT for each empty turn.

Long conversations are cut into blocks of BLOCK turn numbers, and a block of more than
BLOCK_ROWS rows (a turn number that many rows bear) into parts of so many. Each block's
least cost from every state to every state is found by itself, in a fold that holds one
row. The blocks of a conversation are joined by min-plus products over these 4 x 4
numbers, in two levels of up to FAN blocks; then each block writes its own turns with
both its end states known: one huge conversation is spread over tasks, and no text but
a block's is held.

Ties prefer the earlier of: end states in STATES order, then the predecessor state in
STATES order. Defined results: rows are ordered by turn (null first), then role and
text, so repeated rows are repeated turns, merged; a null text is empty; null
conv_ids are one conversation; very long texts are written whole; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

ROLES = ("system", "user", "assistant")
#: Nothing written yet, then the role written last.
STATES = ("start", *ROLES)
NEXT = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
RELABEL, UNKNOWN, MERGE, INSERT = 2, 1, 1, 3
BLOCK = 512
BLOCK_ROWS = 4096
FAN = 1024
FAR = 1 << 40
RESULT = "conv_id long, turn long, role string, new_role string, action string, inserted array<string>, block_cost long, fragment string"


def _between(state: str, role: str | None) -> tuple[str, ...] | None:
    """The fewest empty turns after which `role` may follow; role None is the end."""
    if role == "system":
        return () if state == "start" else None
    if role is None:
        return {"start": (), "system": ("user", "assistant"), "user": ("assistant",), "assistant": ()}[state]
    out: tuple[str, ...] = ()
    while role not in NEXT[state]:
        state = "assistant" if state == "user" else "user"
        out += (state,)
    return out


_GAPS = {(s, r): _between(s, r) for s in STATES for r in ROLES}
_ENDS = np.array([INSERT * len(_between(s, None)) for s in STATES])
#: STEP[i, j]: cost of writing a turn as role j - 1 in state i, and whether it is merged.
_STEP = np.full((4, 4), FAR)
_MERGED = np.zeros((4, 4), bool)
for _i, _s in enumerate(STATES):
    for _j, _r in enumerate(ROLES, 1):
        _gap = _GAPS[_s, _r]
        _cost = FAR if _gap is None else INSERT * len(_gap)
        if _s == _r and MERGE < _cost:
            _cost, _MERGED[_i, _j] = MERGE, True
        _STEP[_i, _j] = _cost


def _label(role: str | None) -> np.ndarray:
    """The cost of each role for a row."""
    own = (role or "").strip().lower()
    return np.array([FAR, *((0 if own == r else RELABEL) if own in ROLES else UNKNOWN for r in ROLES)])


_LABELS = {r: _label(r) for r in (*ROLES, "")}


def _costs(role: str | None) -> np.ndarray:
    own = (role or "").strip().lower()
    return _STEP + _LABELS[own if own in ROLES else ""]


_ONE = np.where(np.eye(4, dtype=bool), 0, FAR)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least cost from each state to each state, first over one stretch and then over another."""
    return np.minimum((a[:, :, None] + b[None]).min(1), FAR)


def transfer(roles: Iterable[str | None]) -> np.ndarray:
    """Least cost from each state to each state over a block of turns."""
    out = _ONE
    for role in roles:
        out = product(out, _costs(role))
    return out


def path(roles: list[str | None], start: int, end: int | None) -> tuple[list[int], int]:
    """The states after each turn on the cheapest way, and its cost; end None: any, with the cost of ending there."""
    cost, back = np.full(4, FAR), []
    cost[start] = 0
    for role in roles:
        every = cost[:, None] + _costs(role)
        back.append(every.argmin(0))
        cost = np.minimum(every.min(0), FAR)
    final = cost + _ENDS
    at = int(final.argmin()) if end is None else end
    total, states = int(final[at] if end is None else cost[at]), []
    for choice in reversed(back):
        states.append(at)
        at = int(choice[at])
    return states[::-1], total


def open_turn(role: str) -> str:
    return f"<|{role}|>\n"


CLOSE = "<|end|>\n"


def written(turns: list[tuple[str | None, str | None]], start: int, end: int | None, closes: bool) -> tuple[list[tuple[str, str, list[str], str]], int]:
    """For each turn of a block: (new role, action, roles put in, text to append), and the block's cost."""
    states, total = path([r for r, _ in turns], start, end)
    out, last = [], start
    for i, ((role, text), state) in enumerate(zip(turns, states, strict=True)):
        new, text = STATES[state], text or ""
        gap = list(_GAPS[STATES[last], new] or ())
        same = (role or "").strip().lower() == new
        if _MERGED[last, state]:
            action, gap, piece = "merge", [], "\n" + text
        else:
            action = "open"
            piece = (CLOSE if last else "") + "".join(open_turn(r) + CLOSE for r in gap) + open_turn(new) + text
        if closes and i == len(turns) - 1:
            ends = list(_between(new, None))
            gap, piece = gap + ends, piece + CLOSE + "".join(open_turn(r) + CLOSE for r in ends)
        out.append((new, action if same else f"{action}+relabel", gap, piece))
        last = state
    return out, total


def _blocks(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], rest: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of equal keys, in the order in which they come."""
    key, rows = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*keys, *rest)]
        for row in zip(*columns, strict=True):
            if row[: len(keys)] != key:
                if rows:
                    yield key, rows
                key, rows = row[: len(keys)], []
            rows.append(row[len(keys) :])
    if rows:
        yield key, rows


def _transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's least costs, from its rows in order; a batch's finished blocks at a time."""
    key, cost, out = None, _ONE, []

    def made() -> pa.RecordBatch:
        conv, block, part, costs = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(block, pa.int64()), pa.array(part, pa.int64()), pa.array(costs, pa.list_(pa.int64()))], ["conv_id", "block", "part", "costs"])

    for batch in batches:
        for *own, role in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "part", "role")), strict=True):
            if own != key:
                if key is not None:
                    out.append((*key, cost.ravel().tolist()))
                key, cost = own, _ONE
            cost = product(cost, _costs(role))
        if out:
            yield made()
            out.clear()
    if key is not None:
        out.append((*key, cost.ravel().tolist()))
        yield made()


def join_blocks(costs: list[np.ndarray], start: int = 0, end: int | None = None) -> list[tuple[int, int | None]]:
    """(start, end) state of each of some blocks in a row, from a start to an end; end None is free, with the cost of ending."""
    first = np.full(4, FAR)
    first[start] = 0
    reach = [first]
    for m in costs:
        reach.append(np.minimum((reach[-1][:, None] + m).min(0), FAR))
    at = int((reach[-1] + _ENDS).argmin()) if end is None else end
    out: list[tuple[int, int | None]] = []
    for before, m in zip(reach[-2::-1], costs[::-1], strict=True):
        here = int((before + m[:, at]).argmin())
        out.append((here, at))
        at = here
    out.reverse()
    return [*out[:-1], (out[-1][0], end)]


def _matrices(rows: pd.DataFrame) -> list[np.ndarray]:
    return [np.array(c, np.int64).reshape(4, 4) for c in rows["costs"]]


def _group_costs(rows: pd.DataFrame) -> pd.DataFrame:
    """A group's product."""
    rows, out = rows.sort_values("place", kind="stable"), _ONE
    for m in _matrices(rows):
        out = product(out, m)
    return pd.DataFrame({"conv_id": rows["conv_id"].astype("Int64").iloc[:1], "fan": rows["fan"].iloc[:1], "costs": [out.ravel().tolist()]})


def _group_ends(rows: pd.DataFrame) -> pd.DataFrame:
    """The end states of a conversation's groups."""
    rows = rows.sort_values("fan", kind="stable")
    ends = join_blocks(_matrices(rows))
    return pd.DataFrame({"conv_key": rows["conv_id"].astype("Int64").to_numpy(), "fan_key": rows["fan"].to_numpy(), "start": [s for s, _ in ends], "end": [-1 if e is None else e for _, e in ends]})


def _block_ends(rows: pd.DataFrame) -> pd.DataFrame:
    """The end states of a group's blocks."""
    rows = rows.sort_values("place", kind="stable")
    last = int(rows["end"].iloc[0])
    ends = join_blocks(_matrices(rows), int(rows["start"].iloc[0]), None if last < 0 else last)
    return pd.DataFrame({"conv_key": rows["conv_id"].astype("Int64").to_numpy(), "block_key": rows["block"].to_numpy(), "part_key": rows["part"].to_numpy(), "start": [s for s, _ in ends], "end": [-1 if e is None else e for _, e in ends]})


def _writer() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], [x.split()[0] for x in RESULT.split(", ")])

        for (conv, _, _, start, end), rows in _blocks(batches, ("conv_id", "block", "part", "start", "end"), ("turn", "role", "text")):
            made, total = written([(r, t) for _, r, t in rows], start, None if end < 0 else end, closes=end < 0)
            held += [(conv, turn, role, *m[:3], total, m[3]) for (turn, role, _), m in zip(rows, made, strict=True)]
            if len(held) >= 1000:
                yield flush()
                held.clear()
        if held:
            yield flush()

    return write


def repair(turns: DataFrame) -> DataFrame:
    """One row per turn: its new role and the text to append; a conversation's fragments in order are its rendering.

    action is open or merge, with +relabel if the role changed; inserted lists the
    empty turns put in before the turn (after the last one: at the end, too); block_cost is the
    least cost of the turn's block.
    """
    common.prepare(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 60))))
    # Blocks of too many rows are cut by rank; there are few such blocks, if any.
    big = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK_ROWS)
    big = common.keep(big.select(F.col("conv_id").alias("big_id"), F.col("block").alias("big_block")), "big")
    if big.isEmpty():
        rows = rows.withColumn("part", F.lit(0).cast("long"))
    else:
        same = rows["conv_id"].eqNullSafe(big["big_id"]) & (rows["block"] == big["big_block"])
        rank = F.row_number().over(W.partitionBy("conv_id", "block").orderBy("turn", "role", "text"))
        cut = rows.join(big, same, "left_semi").withColumn("part", F.floor((rank - 1) / BLOCK_ROWS))
        rows = rows.join(big, same, "left_anti").withColumn("part", F.lit(0).cast("long")).union(cut)
    order = ["conv_id", "block", "part", "turn", "role", "text"]
    costs = rows.repartition("conv_id", "block", "part").sortWithinPartitions(*order).select("conv_id", "block", "part", "role").mapInArrow(_transfers, "conv_id long, block long, part long, costs array<long>")
    costs = common.keep(costs, "blocks")
    many = costs.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("conv_id", "many_id")
    # Only conversations of several blocks; a row of 16 numbers for each block.
    place = F.row_number().over(W.partitionBy("conv_id").orderBy("block", "part")) - 1
    placed = costs.join(many, costs["conv_id"].eqNullSafe(many["many_id"]), "left_semi").withColumn("place", place.cast("long")).withColumn("fan", F.floor(F.col("place") / FAN))
    placed = common.keep(placed, "places")
    groups = placed.groupBy("conv_id", "fan").applyInPandas(_group_costs, "conv_id long, fan long, costs array<long>")
    bounds = groups.groupBy("conv_id").applyInPandas(_group_ends, "conv_key long, fan_key long, start int, end int")
    inner = placed.join(bounds, placed["conv_id"].eqNullSafe(bounds["conv_key"]) & (placed["fan"] == bounds["fan_key"])).drop("conv_key", "fan_key")
    ends = common.keep(inner.groupBy("conv_id", "fan").applyInPandas(_block_ends, "conv_key long, block_key long, part_key long, start int, end int"), "ends")
    same = rows["conv_id"].eqNullSafe(ends["conv_key"]) & (rows["block"] == ends["block_key"]) & (rows["part"] == ends["part_key"])
    known = rows.join(ends, same, "left").select("conv_id", "block", "part", F.coalesce("start", F.lit(0)).alias("start"), F.coalesce("end", F.lit(-1)).alias("end"), "turn", "role", "text")
    return known.repartition("conv_id", "block", "part").sortWithinPartitions(*order).mapInArrow(_writer(), RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2 over the whole conversations table."""
    return repair(common.table(spark, sf_dir, "conversations"))
