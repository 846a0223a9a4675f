"""Mixing sources to target weights by Pfair scheduling.

Each source's rows, in a fixed pseudo-random order, are cut into blocks. Target weights are whole
numbers; a source of share w = weight / sum of weights gets for its block j (from 0) the release
time floor(j / w) and the deadline ceil((j + 1) / w), both in integer arithmetic. Of the released
blocks, the one with the earliest deadline takes the next slot. Every block then meets its window,
so at every slot a source is less than one block away from its target.

The windows repeat exactly after as many slots as the weights sum to, and so does the schedule:
the driver makes one such round, and a block's slot is plain arithmetic on its number. No weight is
rounded: weights like 0.35 or "1/3" are brought to their common denominator. At the slot
where a source runs out a new phase begins, in which the others keep their weights, until all rows
are placed: no row is dropped or repeated.

Without given weights a source's weight is its blocks' number to the power of ``power`` relative to
the largest source, in hundredths and rounded up: that whole number is the target.

Everything on the executors is DataFrame operations. Row numbers within a source are counted in
two levels, within hash ranges of the id and over these ranges, so a source with a third of all
rows is no single task's work.

Cases: a null source is a source of its own; a source without a weight, or with 0, waits until the
others have run out and then gets the weight it would have without given weights; a negative
weight is an error; repeated ids keep their rows (rows that are equal in id take the order of
``tie``, by default none); rows without id are spread by a hash of their numbers, dates and truth
values, and those that are equal in all of these share a hash range; a source of one row has one short block; an empty table
gives no rows; columns of the input are kept, whatever their names, but one named like an added column
gets ``input_`` before its name. Sources and weights that need a schedule of more
than ``MOST_SLOTS`` slots over all phases are an error, not a rounding.
"""

from __future__ import annotations

import bisect
import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

#: Rows in a block.
BLOCK_ROWS = 16
#: Slots that the driver schedules over all phases at most, which bounds the tables it sends out.
MOST_SLOTS = 2_000_000
#: Rows that one hash range of a source has at most, on average.
RANGE_ROWS = 1000
#: Places of the mixture that are dealt out together, and their begins in ranges that are broadcast.
BUCKET_ROWS = 500
BROADCAST_RANGES = 200_000
ADDED = ("phase", "block", "release", "deadline", "slot", "mix_position")


def own_weights(blocks: dict, power: float) -> dict:
    """The weights of sources that are given none, from their numbers of blocks."""
    most = max(blocks.values(), default=1)
    return {s: math.ceil(round(100 * (n / most) ** power, 6)) for s, n in blocks.items()}


def whole_weights(weights: dict) -> dict:
    """Given weights as whole numbers of the same proportions; zeros are left out."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    if any(w < 0 for w in exact.values()):
        raise ValueError("a weight is negative")
    exact = {s: w for s, w in exact.items() if w}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    return {s: int(w * scale) for s, w in exact.items()}


def pfair(parts: dict, left: dict, most: int) -> tuple[dict, str | None]:
    """One round of the schedule for whole weights ``parts``: of each source the slots of its
    blocks, by earliest deadline among the released (ties to the earlier release, then the
    source's name); and the source that runs out within the round, where it ends, or None."""
    length = sum(parts.values())
    at: dict = {s: [] for s in parts}
    # The next block of each source waits by release time or is ready by deadline.
    waiting, ready = [(0, str(s), s) for s in parts], []
    heapq.heapify(waiting)
    for slot in range(length):
        if slot >= most:
            raise ValueError("the weights need too long a schedule; give them a smaller common denominator")
        while waiting and waiting[0][0] <= slot:
            release, name, s = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(len(at[s]) + 1) * length // parts[s]), release, name, s))
        deadline, _, name, s = heapq.heappop(ready)  # at full use some block is always released
        if deadline <= slot:
            raise ArithmeticError("a block missed its deadline")
        at[s].append(slot)
        if len(at[s]) == left[s]:
            return at, s
        if len(at[s]) < parts[s]:
            heapq.heappush(waiting, (len(at[s]) * length // parts[s], name, s))
    return at, None


def phases(blocks: dict, weights: dict, power: float = 0.5, most: int = MOST_SLOTS) -> list[dict]:
    """The phases of a mixture: its first slot and slots, weights, the slots of a round by source,
    and blocks of each source before and within it. A phase ends with the slot at which some
    source has nothing left."""
    left, done, slot, out = dict(blocks), dict.fromkeys(blocks, 0), 0, []
    while any(left.values()):
        parts = {s: weights[s] for s, n in left.items() if n and weights.get(s)}
        if not parts:
            weights = own_weights({s: n for s, n in left.items() if n}, power)
            continue
        common = math.gcd(*parts.values())
        parts = {s: p // common for s, p in parts.items()}
        length = sum(parts.values())
        at, ended = pfair(parts, left, most)
        most -= sum(map(len, at.values()))
        if ended is None:
            slots = 1 + min((left[s] - 1) // p * length + at[s][(left[s] - 1) % p] for s, p in parts.items())
        else:
            slots = at[ended][-1] + 1
        rounds, rest = divmod(slots, length)
        placed = {s: rounds * p + bisect.bisect_left(at[s], rest) for s, p in parts.items()}
        out.append({"slot": slot, "slots": slots, "parts": parts, "at": at, "before": dict(done), "placed": placed})
        for s, n in placed.items():
            left[s] -= n
            done[s] += n
        slot += slots
    return out


def ranges(docs: DataFrame, id_col: str, source_col: str, range_rows: int, tie: F.Column | None) -> tuple[DataFrame, DataFrame, dict]:
    """``docs`` with ``__source``, ``__hash`` and ``__range``; for each source and range the rows of
    the source in the ranges before it; and the rows of each source."""
    name = F.coalesce(F.concat(F.lit("s:"), F.col(source_col).cast("string")), F.lit("null"))
    own = F.col(id_col).cast("string")
    key = F.md5((own if tie is None else F.concat_ws("/", own, tie.cast("string"))).cast("binary"))
    # Whole texts are not read to find places.
    short = [F.col(f"`{f.name}`") for f in docs.schema if isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType))]
    unnamed = F.shiftrightunsigned(F.xxhash64(F.lit(0), *short), 4)
    hashed = F.when(F.col(id_col).isNull(), unnamed).otherwise(F.conv(F.substring(key, 1, 15), 16, 10).cast("long"))
    rows = docs.withColumns({"__source": name, "__hash": hashed})
    counts = rows.groupBy("__source").count().limit(MOST_SLOTS + 1).collect()  # a phase has a slot for each source
    if len(counts) > MOST_SLOTS:
        raise ValueError(f"more than {MOST_SLOTS} sources; group them first")
    sizes = {r["__source"]: r["count"] for r in counts}
    bits = (max([1, *(-(-n // range_rows) for n in sizes.values())]) - 1).bit_length()
    rows = rows.withColumn("__range", F.shiftright("__hash", 60 - bits))
    parts = rows.groupBy("__source", "__range").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return rows, parts.select("__source", "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")), sizes


class Plan:
    """The phases of a mixture as a table whose size ``MOST_SLOTS`` bounds, whatever the number of rows."""

    def __init__(self, spark, sizes: dict, weights: dict | None, power: float, block_rows: int):
        blocks = {s: -(-n // block_rows) for s, n in sizes.items()}
        if weights is None:
            given = own_weights(blocks, power)
        else:
            given = whole_weights({"null" if s is None else f"s:{s}": w for s, w in weights.items()})
        spans = []
        for number, p in enumerate(phases(blocks, given, power)):
            length = sum(p["parts"].values())
            for s, n in p["placed"].items():
                first = p["before"][s]
                spans.append((s, number, first, first + n, p["parts"][s], p["slot"], length, p["at"][s]))
        self.block_rows = block_rows
        schema = "source string, phase int, first long, past long, part long, start long, length long, at array<int>"
        self.spans = shared.literal_rows(spark, spans, schema)

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``__source`` and ``__row``) with ``__phase``, ``__block``, ``__release``,
        ``__deadline``, ``__slot`` and ``__position``: arithmetic on the number of the block."""
        rows = rows.withColumn("__block", F.expr(f"__row div {self.block_rows}"))
        on = [F.col("__source") == F.col("p.source"), F.col("__block") >= F.col("p.first"), F.col("__block") < F.col("p.past")]
        found = rows.join(F.broadcast(self.spans).alias("p"), on).select(
            rows["*"], F.col("p.phase").alias("__phase"), F.col("p.part").alias("__part"), F.col("p.length").alias("__length"),
            F.expr("p.start + (__block - p.first) div p.part * p.length").alias("__base"),
            F.expr("(__block - p.first) % p.part").alias("__j"),
            F.expr("element_at(p.at, cast((__block - p.first) % p.part as int) + 1)").alias("__at"),
        )
        return found.withColumns({
            "__release": F.expr("__base + __j * __length div __part"),
            "__deadline": F.expr("__base + ((__j + 1) * __length + __part - 1) div __part"),
            "__slot": F.expr("__base + __at"),
            "__position": F.expr(f"(__base + __at) * {self.block_rows} + __row % {self.block_rows}"),
        })


def _own_order(id_col: str, tie: F.Column | None, *keys: str):
    return Window.partitionBy(*keys).orderBy("__hash", F.col(id_col), F.lit(0) if tie is None else tie)


def mixed(
    docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", source_col: str = "source", power: float = 0.5,
    block_rows: int = BLOCK_ROWS, range_rows: int = RANGE_ROWS, tie: F.Column | None = None,
) -> DataFrame:
    """``docs`` with phase, block (of its source, from 0), release, deadline and slot (of the whole
    mixture), and mix_position (gapless but for the last block of each source)."""
    names = [f"input_{c}" if c.lower() in ADDED else c for c in docs.columns]
    docs = shared.shielded(docs)
    docs = docs.toDF(*(f"__input_{c}" if c.lower() in ADDED else c for c in docs.columns))
    rows, parts, sizes = ranges(docs, id_col, source_col, range_rows, tie)
    rank = F.row_number().over(_own_order(id_col, tie, "__source", "__range")) - 1
    rows = rows.withColumn("__rank", rank).join(parts, ["__source", "__range"]).withColumn("__row", F.col("__rank") + F.col("__before"))
    placed = Plan(docs.sparkSession, sizes, weights, power, block_rows).placed(rows)
    return placed.select(*(F.col(f"`{c}`") for c in docs.columns), *(F.col(f"__{n}").alias(n) for n in ADDED[:-1]), F.col("__position").alias("mix_position")).toDF(*names, *ADDED)


def in_mixed_order(
    docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", source_col: str = "source", power: float = 0.5,
    block_rows: int = BLOCK_ROWS, range_rows: int = RANGE_ROWS, tie: F.Column | None = None,
) -> DataFrame:
    """The rows and columns of ``docs``, each file in the order of the places in the mixture.

    Whole rows are shuffled once, dealt by ranges of buckets of places. The places of all rows are
    first found from source and hash alone; where a bucket begins within a range of a source is
    kept as a hash, by which whole rows find their buckets. The rank within a bucket, and so the
    exact place, is found after that shuffle. Files follow each other in the mixture: they overlap
    only where rows of one source have one hash, which stay together."""
    names, docs = docs.columns, shared.shielded(docs)
    rows, parts, sizes = ranges(docs, id_col, source_col, range_rows, tie)
    plan = Plan(docs.sparkSession, sizes, weights, power, block_rows)
    rank = F.rank().over(Window.partitionBy("__source", "__range").orderBy("__hash")) - 1
    narrow = rows.select("__source", "__range", "__hash").withColumn("__rank", rank).join(parts, ["__source", "__range"])
    places = plan.placed(narrow.withColumn("__row", F.col("__rank") + F.col("__before")))
    begins = places.groupBy("__source", "__range", F.floor(F.col("__position") / BUCKET_ROWS).alias("bucket"))
    begins = begins.agg(F.min("__hash").alias("hash"), F.min("__row").alias("before"))
    begins = begins.groupBy("__source", "__range").agg(F.array_sort(F.collect_list(F.struct("hash", "before", "bucket"))).alias("__begins"))
    begins = shared.stored(begins, "range_places")
    if (begins.agg(F.sum(F.size("__begins"))).first()[0] or 0) <= BROADCAST_RANGES:
        begins = F.broadcast(begins)
    found = F.element_at(F.filter("__begins", lambda b: b["hash"] <= F.col("__hash")), -1)
    dealt = rows.join(begins, ["__source", "__range"]).withColumn("__begin", found)
    dealt = dealt.withColumns({"__before": F.col("__begin.before"), "__bucket": F.col("__begin.bucket")}).drop("__begins", "__begin")
    dealt = dealt.repartitionByRange("__bucket")
    rank = F.row_number().over(_own_order(id_col, tie, "__bucket", "__source", "__range")) - 1
    placed = plan.placed(dealt.withColumn("__row", rank + F.col("__before")))
    return placed.sortWithinPartitions("__position").select(*(F.col(f"`{c}`") for c in docs.columns)).toDF(*names)
