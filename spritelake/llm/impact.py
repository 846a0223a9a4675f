"""Exact top-k search by inner product over an impact-ordered index, a score at a time.

Vectors become integers (floor of scale * x). The index deals them into blocks. A block holds its
postings (row, dimension) in segments, one for each quantised impact (the integer value), by
falling absolute impact; as impacts are integers the index is exact.

A group of queries takes the blocks of a lane one after another and keeps the k best rows of each
query found so far; the least of these is the query's running bar. Within a block segments are
processed in falling order of impact. At each stop (an impact relative to the block's largest) a
row's score is known up to the norm of its unprocessed postings times the norm of the query over
their dimensions (Cauchy-Schwarz). A query leaves the block only on that proof: when few rows can
still reach its bar, or the k-th best of the block's own lower bounds, those are scored exactly from
all their postings, and the block's remaining segments are skipped. Ties go to the smaller id.

Queries and index blocks meet as blocks: pieces of the index are copied to the groups of queries and
no pair of rows is made. A lane is a bounded number of blocks (the memory of a task); it gives k rows
a query, and a window over the lanes' rows gives the k best. The work is that of an exact search by
a share of all rows; only the segments that are skipped save some of it.

Sums stay exact: they run in 32-bit floats where all possible sums are below 2**24, in 64-bit
floats below 2**53, else in Python integers.

Scores beyond 64 bits are cut to the nearest 64-bit integer.

Cases: a vector that is null or holds a null or non-finite component takes no part, nor does a row
without id; shorter vectors count as filled up with zeros; a row never meets rows of its own id;
repeated ids keep their rows; fewer candidates than k give fewer rows; an empty table gives none;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

SCALE = 64
K = 20
#: Rows of an index block, queries of a group and blocks of a lane: the memory of a task.
BLOCK_ROWS = 2048
GROUP_QUERIES = 512
LANE_BLOCKS = 32
#: Impacts at which the proof is tried, as shares of the block's largest.
STOPS = (0.3, 0.15, 0.08)
#: Share of a block that may be left to exact scoring; with more, the next segments are processed.
FEW = 0.05


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the rows that take part."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(x.isNotNull() & finite, v).alias("v"))
    return rows.filter("vec_id is not null and v is not null")


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def build_block(ids: np.ndarray, vectors: list) -> dict:
    """A block: its rows' ids, the impacts of its segments by falling absolute value, how many
    postings each has, and the postings (row * width + dimension)."""
    order = np.argsort(ids, kind="stable")
    ids, width = ids[order], max(map(len, vectors), default=0)
    flat = _matrix([vectors[i] for i in order], width).ravel()
    cells = np.flatnonzero(flat)
    value = flat[cells]
    cells = cells[np.lexsort((cells, value, -np.abs(value)))]
    value = flat[cells]
    firsts = np.concatenate([np.zeros(min(1, len(value)), np.int64), np.flatnonzero(np.diff(value)) + 1])
    return {
        "width": width, "ids": ids.astype("<i8").tobytes(), "impacts": value[firsts].astype("<i8").tobytes(),
        "sizes": np.diff(np.append(firsts, len(value))).astype("<i4").tobytes(), "postings": cells.astype("<i4").tobytes(),
    }


def _build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([{"block": np.int64(key[0]), **build_block(pdf["vec_id"].to_numpy(np.int64), list(pdf["v"]))}])


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """The index as a stored table: a row for each block."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))
    schema = "block long, width int, ids binary, impacts binary, sizes binary, postings binary"
    return shared.stored(dealt.groupBy("block").applyInPandas(_build, schema), "impact_index")


class Search:
    """A group of queries and the k best rows of each so far."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = query_ids, queries, k
        self.owner, self.found, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object)
        self.bar: list = [None] * len(query_ids)  # of queries that have k rows
        self.offered = self.processed = 0  # postings times queries: of the blocks, and those processed in segments

    def add(self, owner: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
        """Keep the k best of the rows so far and more of them."""
        own = found == self.ids[owner]
        owner, found, score = owner[~own], found[~own], score[~own]
        owner, found = np.concatenate([self.owner, owner]), np.concatenate([self.found, found])
        score = np.concatenate([self.score, score]) if len(self.score) else score  # whole numbers as floats, or Python's
        order = np.lexsort((found, -score, owner))
        owner, found, score = owner[order], found[order], score[order]
        starts = np.searchsorted(owner, np.arange(len(self.ids)))
        rank = np.arange(len(owner)) - starts[owner]
        kept = rank < self.k
        self.owner, self.found, self.score = owner[kept], found[kept], score[kept]
        for i, v in zip(owner[rank == self.k - 1].tolist(), score[rank == self.k - 1].tolist(), strict=True):
            self.bar[i] = v

    def block(self, block: dict) -> None:
        ids = np.frombuffer(block["ids"], "<i8")
        impacts, sizes = np.frombuffer(block["impacts"], "<i8"), np.frombuffer(block["sizes"], "<i4")
        postings, n = np.frombuffer(block["postings"], "<i4"), len(ids)
        width = max(int(block["width"]), self.queries.shape[1])
        q = np.zeros((len(self.ids), width), np.int64)
        q[:, : self.queries.shape[1]] = self.queries
        top = int(np.abs(impacts).max(initial=0))
        most = int(np.abs(q).max(initial=0)) * top * width
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object
        row, dim = np.divmod(postings, max(1, int(block["width"])))
        value = np.repeat(impacts, sizes)
        whole = np.zeros((n, width), kind)
        whole[row, dim] = value if kind is not object else value.astype(object)
        self.offered += len(postings) * len(q)
        if kind is object:  # no float holds the sums: score every row
            self.processed += len(postings) * len(q)
            for i, v in enumerate(q.astype(object)):
                self.add(np.full(n, i), ids, whole @ v)
            return
        typed, active = q.astype(kind), np.arange(len(q))
        squares = typed * typed
        score, at = np.zeros((len(q), n), kind), 0
        ends = [int(np.searchsorted(-np.abs(impacts), -share * top, side="right")) for share in STOPS] + [len(impacts)]
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        for stop, end in enumerate(ends):
            until = int(bounds[end])
            part = np.zeros((n, width), kind)
            part[row[at:until], dim[at:until]] = value[at:until]
            score[active] = score[active] + typed[active] @ part.T
            self.processed += (until - at) * len(active)
            at = until
            if stop + 1 == len(ends):  # every segment is processed: the scores are exact
                self._settle(active, ids, score[active])
                return
            rest = np.zeros((n, width), kind)
            rest[row[at:], dim[at:]] = value[at:]
            left = np.sqrt((rest.astype(np.float64) ** 2).sum(1)).astype(kind)
            slack = np.sqrt(squares[active] @ (rest != 0).astype(kind).T) * left[None, :]
            slack = slack * kind(1 + 1e-6 * (width + 8)) + kind(1e-3)
            low, high = score[active] - slack, score[active] + slack
            low[ids[None, :] == self.ids[active][:, None]] = -np.inf  # a query's own row proves nothing
            bar = np.array([-np.inf if self.bar[i] is None else self.bar[i] for i in active.tolist()])
            if n > self.k:
                bar = np.maximum(bar, np.partition(low, n - self.k, axis=1)[:, n - self.k])
            possible = high >= bar[:, None]
            done = possible.sum(1) <= max(2 * self.k, FEW * n)
            if done.any():
                who, which = np.nonzero(possible[done])
                who = active[done][who]
                step = max(1, (1 << 24) // max(1, width))
                exact = [np.einsum("ij,ij->i", typed[who[i : i + step]], whole[which[i : i + step]]) for i in range(0, len(who), step)]
                self.add(who, ids[which], np.concatenate([*exact, np.zeros(0, kind)]).astype(np.float64))
            active = active[~done]
            if not len(active):
                return

    def _settle(self, active: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        n = len(ids)
        seen = np.where(ids[None, :] == self.ids[active][:, None], -np.inf, score)
        bar = np.partition(seen, n - self.k, axis=1)[:, n - self.k] if n > self.k else np.full(len(active), -np.inf)
        who, which = np.nonzero((seen >= bar[:, None]) & (seen > -np.inf))
        self.add(active[who], ids[which], score[who, which].astype(np.float64))

    def rows(self) -> list[tuple[int, int, int]]:
        """(place of the query, vec_id, score)."""
        limit = 1 << 63
        return [(int(i), int(j), max(-limit, min(limit - 1, int(v)))) for i, j, v in zip(self.owner, self.found, self.score, strict=True)]


def _cell(k: int):
    def cell(key: tuple, queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        names = ["query", "query_id", "vec_id", "score"]
        if not len(queries) or not len(index):
            return pd.DataFrame({n: np.zeros(0, np.int64) for n in names})
        ids = queries["query_id"].to_numpy(np.int64)
        search = Search(ids, _matrix(list(queries["v"]), max(map(len, queries["v"]))), k)
        for block in index.sort_values("block").to_dict("records"):
            search.block(block)
        marks = queries["query"].to_numpy(np.int64)
        found = [(marks[i], ids[i], vec_id, score) for i, vec_id, score in search.rows()]
        return pd.DataFrame(found, columns=names).astype(np.int64)

    return cell


def top_k(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = K, scale: int = SCALE,
    block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES, lane_blocks: int = LANE_BLOCKS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the queries whose id is divisible by ``every``, against all rows."""
    spark = vectors.sparkSession
    shared.ship(spark)
    rows = integers(vectors, id_col, vector_col, scale)
    is_query = F.col("vec_id") % every == 0
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    blocks, groups = max(1, -(-n // block_rows)), max(1, -(-n_queries // group_queries))
    lanes = -(-blocks // lane_blocks)
    index = build_index(rows, blocks).withColumn("lane", F.col("block") % lanes)
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "v").distinct()
    queries = queries.withColumn("query", F.xxhash64("query_id", "v"))
    queries = queries.withColumn("group", F.pmod(F.col("query"), F.lit(groups)))
    # A query goes to every lane, an index block to every group, and they meet by (group, lane).
    queries = queries.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))
    index = index.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    cells = queries.groupBy("group", "lane").cogroup(index.groupBy("group", "lane"))
    found = cells.applyInPandas(_cell(k), "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
