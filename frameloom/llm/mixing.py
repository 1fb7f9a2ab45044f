"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``block_rows`` documents. With weight w out
of the weights' sum D, block j of a source is released at slot floor(j * D / w)
and due by slot ceil((j + 1) * D / w). Slots are filled by the released block
with the earliest deadline, which is optimal on one processor: every block
meets its window, so at every slot each source's share is off its target by
less than one block. After D slots all sources are exactly on target, so the
schedule of D slots repeats and the slot of any block follows from its number.

Sources that the weights don't name share the weight ``other`` as one group
and take turns in it, each in every round while it has blocks, the larger ones
first. So a plan depends on the weights only, and there may be any number of
sources. Before round j the group has had as many blocks as the sum of
min(blocks, j) over its sources, which follows from a table of the distinct
numbers of blocks; N blocks allow no more than sqrt(2 N) of these. Each run of
a source's rows gets the few lines of the table that its blocks need.

When a source or the group has no blocks left, the others go on with their
weights and a new schedule: all documents are kept, and the targets hold as far
as the sources reach. A source's documents are ordered by a hash of doc_id and
text.

Documents are numbered in the order of (source, hash) by ranges: one shuffle
and sort, written; a document's number is its place in its partition plus what
the partitions before have of that source. A source with a third of all rows,
or as many equal rows, spreads over partitions. The driver sees a count for each
named source, the group's distinct numbers of blocks, and a table of slots for
each named source and phase (at most as many phases as named sources and one).

Documents without source form a source of their own, which the weight of None
names. Weights are positive whole numbers. Null and very long texts are only
hashed. Repeated rows each have a place; an empty table gives an empty result;
carried columns may have any names, but those of results give way to these.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Slots that the driver plans for all phases and sources, at most: a bound on weights, whatever the documents.
MOST_SLOTS = 1 << 22


def schedule(weights: dict[str, int]) -> list[str]:
    """The sources of D slots, D being the sum of the weights."""
    total = sum(weights.values())
    release = lambda j, w: j * total // w
    due = lambda j, w: -(-(j + 1) * total // w)
    waiting = [(0, due(0, w), s, 0) for s, w in sorted(weights.items()) if w > 0]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, deadline, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, s, j))
        deadline, s, j = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a block has missed its deadline")
        out.append(s)
        if j + 1 < weights[s]:
            heapq.heappush(waiting, (release(j + 1, weights[s]), due(j + 1, weights[s]), s, j + 1))
    return out


def phases(blocks: dict[str, int], weights: dict[str, int]) -> list[dict]:
    """A row for each phase and source in it: its blocks from ``first`` on
    take the slots base + period * (k // n) + slots[k % n], k counting from
    ``first``, up to ``last`` (exclusive)."""
    left, done, base, rows = dict(blocks), dict.fromkeys(blocks, 0), 0, []
    while active := {s: weights[s] for s, n in left.items() if n > 0}:
        order = schedule(active)
        slots: dict[str, list[int]] = {s: [] for s in active}
        for slot, s in enumerate(order):
            slots[s].append(slot)
        last_slot = lambda s: (left[s] - 1) // active[s] * len(order) + slots[s][(left[s] - 1) % active[s]]
        end = min(map(last_slot, active)) + 1  # the phase ends with the first source to run dry
        for s, own in slots.items():
            n = end // len(order) * len(own) + sum(x < end % len(order) for x in own)
            if n:
                rows.append({"source": s, "first": done[s], "last": done[s] + n, "base": base, "period": len(order), "slots": own})
            done[s] += n
            left[s] -= n
        base += end
    return rows


#: Bits of monotonically_increasing_id() for the place in a partition.
_PLACE = 33


def numbered(df: DataFrame, order: list[Column | str], scratch: common.Scratch, name: str) -> DataFrame:
    """df, written, with fl_part and fl_at: rows ascend by these in the order
    given, and those of a part have consecutive places."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("fl_at", F.monotonically_increasing_id())
    rows = rows.withColumns({"fl_part": F.shiftright("fl_at", _PLACE), "fl_at": F.col("fl_at").bitwiseAND((1 << _PLACE) - 1)})
    return scratch.keep(rows, name)


class Rounds:
    """What a group that takes turns has had before a round: from (blocks,
    how many sources have them), ascending."""

    def __init__(self, counts: list[tuple[int, int]]):
        self.blocks = np.array([0, *(b for b, _ in counts)], dtype=np.int64)
        n = np.array([0, *(k for _, k in counts)], dtype=np.int64)
        self.ended = np.cumsum(n * self.blocks)  # blocks of the sources that have no more than so many
        self.alive = n.sum() - np.cumsum(n)  # sources that have more

    def steps(self, first: int, last: int) -> list[dict[str, int]]:
        """For rounds j from first to last, where b <= j of the last step that
        has it: ended + alive * j."""
        a, b = np.searchsorted(self.blocks, [first, last], side="right")
        return [{"b": int(self.blocks[k]), "ended": int(self.ended[k]), "alive": int(self.alive[k])} for k in range(a - 1, b)]

    @property
    def total(self) -> int:
        return int(self.ended[-1])


def _stepped(rounds: Rounds, block_rows: int):
    """Adds to each run of a group's source the steps for its blocks."""
    kind = pa.list_(pa.struct([("b", pa.int64()), ("ended", pa.int64()), ("alive", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("fl_before", "fl_n", "fl_turn")), strict=True)
            steps = [None if turn is None else rounds.steps(k // block_rows, (k + n - 1) // block_rows) for k, n, turn in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(steps, kind)], [*batch.schema.names, "fl_steps"])

    return run


def mix(docs: DataFrame, weights: dict[str, int] | None = None, *, other: int = 1, block_rows: int = 32, carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (doc_id, source if not given) with fl_block (of
    the source), fl_slot and fl_position (the place in the mix; its order is
    that of the slots, with gaps after a source's last block)."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark, "mixing")
    carry = ["doc_id", "source"] if carry is None else carry
    # A source's name and whether it has one: no name can clash with null. The group's name is none of these.
    label = lambda s: "-" if s is None else f"+{s}"
    group, chosen = "*", {label(s): w for s, w in (weights or {}).items()}
    if bad := [s for s, w in [*chosen.items(), (group, other)] if not isinstance(w, int) or w < 1]:
        raise ValueError(f"weights must be positive whole numbers: {bad}")
    if (sum(chosen.values()) + other) * (len(chosen) + 1) > MOST_SLOTS:
        raise ValueError("the weights' sum times their number is too large; use smaller weights")
    source = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source").cast("string")))
    # The last key parts even equal rows. Once written, places are fixed.
    whole = docs.select(common.carried(carry), source.alias("fl_source"), F.xxhash64(F.lit(1), "doc_id", "text").alias("fl_h"), F.monotonically_increasing_id().alias("fl_salt"))
    rows = numbered(whole, ["fl_source", "fl_h", "fl_salt"], scratch, "rows")
    # A row for each source and part that has some of it.
    runs = rows.groupBy("fl_source", "fl_part").agg(F.min("fl_at").alias("fl_first"), F.count("*").alias("fl_n"))
    before = Window.partitionBy("fl_source").orderBy("fl_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = scratch.keep(runs.withColumn("fl_before", F.coalesce(F.sum("fl_n").over(before), F.lit(0))), "runs")
    sources = runs.groupBy("fl_source").agg(F.expr(f"cast(ceil(sum(fl_n) / {block_rows}) as long)").alias("fl_blocks"))
    named = F.col("fl_source").isin(list(chosen)) if chosen else F.lit(False)
    blocks = {r.fl_source: r.fl_blocks for r in sources.filter(named).collect()}
    # Distinct numbers of blocks, of which there are few.
    rounds = Rounds([tuple(r) for r in sources.filter(~named).groupBy("fl_blocks").count().orderBy("fl_blocks").collect()])
    if rounds.total:
        blocks[group], chosen[group] = rounds.total, other
    # Turns in the group: by blocks, then by a hash of the name.
    turns = numbered(sources.filter(~named), [F.col("fl_blocks").desc(), F.xxhash64("fl_source"), "fl_source"], scratch, "turns")
    parts, base = [], 0
    for part, n in turns.groupBy("fl_part").count().orderBy("fl_part").collect():
        parts.append((part, base))
        base += n
    turns = turns.join(F.broadcast(spark.createDataFrame(parts, "fl_part long, fl_base long")), "fl_part").select("fl_source", (F.col("fl_at") + F.col("fl_base")).alias("fl_turn"))
    runs = runs.join(turns, "fl_source", "left").select("fl_source", "fl_part", "fl_first", "fl_n", "fl_before", "fl_turn")
    kind = "fl_source string, fl_part long, fl_first long, fl_n long, fl_before long, fl_turn long, fl_steps array<struct<b: long, ended: long, alive: long>>"
    runs = scratch.keep(runs.mapInArrow(common.tidy(_stepped(rounds, block_rows)), kind), "planned")
    scratch.drop("runs", "turns")

    placed = rows.join(runs, ["fl_source", "fl_part"]).withColumn("fl_k", F.col("fl_at") - F.col("fl_first") + F.col("fl_before"))
    placed = placed.withColumn("fl_block", F.expr(f"fl_k div {block_rows}"))
    # How often the group has been served when a block's turn comes.
    placed = placed.withColumn("fl_step", F.expr("element_at(filter(fl_steps, s -> s.b <= fl_block), -1)"))
    alone = F.col("fl_turn").isNull()
    placed = placed.withColumns({"fl_entity": F.when(alone, F.col("fl_source")).otherwise(F.lit(group)), "fl_seq": F.when(alone, F.col("fl_block")).otherwise(F.expr("fl_step.ended + fl_step.alive * fl_block + fl_turn"))})
    kind = "fl_entity string, fl_from long, fl_to long, fl_base long, fl_period long, fl_slots array<long>"
    slots = spark.createDataFrame([tuple(r.values()) for r in phases(blocks, {s: chosen[s] for s in blocks})], kind)
    # The slots are bounded by the weights, not by documents.
    out = placed.join(F.broadcast(slots), "fl_entity").filter("fl_seq >= fl_from and fl_seq < fl_to")
    k = "(fl_seq - fl_from)"
    slot = F.expr(f"fl_base + {k} div size(fl_slots) * fl_period + fl_slots[cast({k} % size(fl_slots) as int)]")
    out = out.withColumn("fl_slot", slot).withColumn("fl_position", F.col("fl_slot") * block_rows + F.col("fl_k") % block_rows)
    return out.select(*common.spread(carry, ["fl_block", "fl_slot", "fl_position"]))
