"""Exact top-k by inner product: columnar branch and bound over blocks of vectors.

Vectors become whole numbers and are stored in blocks, dimension by dimension (vertical layout). A task holds some
blocks of candidates and some of queries, and adds up scores one block of dimensions at a time. What the dimensions
not yet read can still add to a pair is at most the product of the two remaining norms; a pair whose score so far and
that bound don't beat its query's k-th best is dropped, and the rest are compacted to a list of pairs. While most pairs
survive, a block of dimensions is one matrix product instead. Each task's best k of a query meet those of the others.

Scores are exact: sums stay below 2**53, where doubles are whole, and are made in Python integers beyond.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stowage.session import share

BLOCK = 2048  # candidates of a block
DIMENSIONS = 16  # added up before pairs are dropped
SPARSE = 0.2  # share of pairs below which they are compacted
LANE = 8  # parts of the table whose queries one task holds
EXACT = 2.0**53
KINDS = ["<i2", "<i4", "<f8"]

PACKED = "part long, block long, dim int, kind int, n_asks int, ids binary, asks binary, matrix binary"
BEST = "query_block long, query_at int, query_id long, vec_id long, block long, at int, score long"


def whole_vectors(vectors: DataFrame, asks: Column, scale: float, id_col: str, embedding: str) -> DataFrame:
    """(id, asks, dim, v): ids and vectors floor(scale * x) without null, NaN or infinite components."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"), F.col(embedding).cast("array<double>").alias("x")
    )
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & (F.size("x") > 0) & F.forall("x", fine))
    return rows.select("id", "asks", F.size("x").alias("dim"), F.transform("x", lambda v: v * F.lit(float(scale))).alias("v"))


def packed(rows: DataFrame, per_part: int) -> DataFrame:
    """Blocks of up to ``BLOCK`` vectors of one length, in order of their ids; a part holds about ``per_part`` rows."""
    parts = max(1, -(-rows.count() // per_part))
    order = ["dim", "id", "_tie"]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            dims = batch.column(2).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(dims)) + 1), batch.num_rows]
            for low, high in zip(cuts[:-1], cuts[1:]):
                for start in range(low, high, BLOCK):
                    some = batch.slice(start, min(BLOCK, high - start))
                    if not some.num_rows:
                        continue
                    dim = int(dims[start])
                    x = np.floor(some.column(3).flatten().to_numpy().reshape(-1, dim)).T
                    peak = np.abs(x).max()
                    kind = 0 if peak < 2**15 else 1 if peak < 2**31 else 2
                    asks = some.column(1).to_numpy(zero_copy_only=False).astype("?")
                    yield pa.RecordBatch.from_pydict({
                        "part": [part], "block": [(part << 32) + made], "dim": pa.array([dim], pa.int32()), "kind": pa.array([kind], pa.int32()),
                        "n_asks": pa.array([asks.sum()], pa.int32()),
                        "ids": [some.column(0).to_numpy().astype("<i8").tobytes()], "asks": [asks.tobytes()],
                        "matrix": [np.ascontiguousarray(x.astype(KINDS[kind])).tobytes()],
                    })
                    made += 1

    return share(dealt.select("id", "asks", "dim", "v").mapInArrow(pack, PACKED), "vector-blocks")


class Block:
    """A stored block: ids, a (dim, rows) matrix, and the norms of what is left after each block of dimensions."""

    def __init__(self, number: int, dim: int, kind: int, ids: bytes, matrix: bytes, at: np.ndarray | None = None):
        self.number = number
        self.ids = np.frombuffer(ids, "<i8")
        self.x = np.frombuffer(matrix, KINDS[kind]).reshape(dim, -1).astype(np.float64)
        self.at = np.arange(len(self.ids))
        if at is not None:
            self.ids, self.x, self.at = self.ids[at], np.ascontiguousarray(self.x[:, at]), at
        squares = (self.x * self.x).reshape(dim, -1)
        cuts = range(0, dim, DIMENSIONS)
        mass = np.stack([squares[k : k + DIMENSIONS].sum(axis=0) for k in cuts])
        # rest[k]: norm of the blocks of dimensions from k on; a little more than it, for the rounding of roots
        self.rest = np.sqrt(np.concatenate([mass[::-1].cumsum(axis=0)[::-1], np.zeros((1, len(self.ids)))])) * (1 + 1e-9)
        self.steps = [slice(k, k + DIMENSIONS) for k in cuts]


class Best:
    """The best k candidates of each query so far; of equal scores the one that came first stays."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.rows = np.zeros((3, 0), np.int64)
        self.least = np.full(n, -np.inf)  # what a candidate must beat

    def add(self, query: np.ndarray, score: np.ndarray, block: Block, at: np.ndarray) -> None:
        rows = np.stack([block.ids[at], np.full(len(at), block.number), block.at[at]])
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        rows = np.concatenate([self.rows, rows], axis=1)
        order = np.lexsort((~score, query))  # stable; ~x falls as x rises and fits every long
        query, score, rows = query[order], score[order], rows[:, order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = rank < self.k
        self.query, self.score, self.rows = query[kept], score[kept], rows[:, kept]
        full = np.flatnonzero(rank[kept] == self.k - 1)
        self.least[self.query[full]] = self.score[full]


def scan(queries: Block, block: Block, best: Best) -> None:
    """Take the block's candidates into ``best``. Blocks must come in order of their ids, so ties change nothing."""
    own = np.flatnonzero(queries.home == block.number)
    if queries.rest[0].max(initial=0) * block.rest[0].max(initial=0) * (1 + 1e-6) >= EXACT:
        whole = np.vectorize(int, otypes=[object])
        scores = whole(queries.x).T @ whole(block.x)
        if max(map(abs, scores.ravel())) >= 2**63:
            raise OverflowError("a score does not fit a long")
        scores = scores.astype(np.int64)
        some = np.ones(scores.shape, bool)
        some[own, queries.at[own]] = False
        q, c = np.nonzero(some)
        best.add(q, scores[q, c], block, c)
        return
    partial, q, c = np.zeros((len(queries.ids), len(block.ids))), None, None
    for k, step in enumerate(queries.steps):
        left, right = queries.rest[k + 1], block.rest[k + 1]
        if q is None:
            partial += queries.x[step].T @ block.x[step]
            some = partial + left[:, None] * right > best.least[:, None]
            some[own, queries.at[own]] = False
            if k + 1 == len(queries.steps):  # of all scores only the k best of a query and their ties go on
                if some.shape[1] > best.k:
                    scores = np.where(some, partial, -np.inf)
                    some &= partial >= np.partition(scores, -best.k, axis=1)[:, -best.k][:, None]
            elif some.mean() > SPARSE:
                continue
            q, c = np.nonzero(some)
            sums = partial[q, c]
        else:
            sums = sums + np.einsum("ij,ij->j", queries.x[step][:, q], block.x[step][:, c])
            kept = sums + left[q] * right[c] > best.least[q]
            q, c, sums = q[kept], c[kept], sums[kept]
        if not len(q):
            return
    best.add(q, sums.astype(np.int64), block, c)


def top_k(
    vectors: DataFrame, asks: Column, k: int = 20, scale: float = 64.0, per_part: int | None = None, id_col: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` best rows for every row that ``asks``.

    A score is the inner product of the vectors floor(``scale`` * x), exact; ties go to the smaller id. Every row but
    the query's own is a candidate, so of rows with the same id one may find another; fewer than ``k`` candidates
    give fewer ranks. Vectors that are null, empty, or hold null, NaN or infinite components take no part, nor do rows
    with a null id; vectors of different length don't meet. A score beyond a long raises. An empty table gives no
    rows; other columns are not read.

    Candidates lie in parts, each compared with lanes of queries: the work of all queries against all rows is spread
    over parts times lanes tasks, and a task holds one part and one lane.
    """
    rows = whole_vectors(vectors, asks, scale, id_col, embedding)
    per_part = per_part or min(65_536, max(4096, rows.count() // 64))
    blocks = packed(rows, per_part)
    parts = blocks.agg(F.max("part")).first()[0]
    if parts is None:
        parts = 0
    lanes = parts // LANE + 1
    named = [F.col(c) for c in ("part", "block", "dim", "kind", "ids", "asks", "matrix")]
    lane = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane")
    candidates = blocks.select(*named, lane)
    asking = blocks.filter("n_asks > 0")
    goal = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts).cast("long"))).alias("goal")
    questions = asking.select(*named, F.floor(F.col("part") / LANE).alias("lane"), goal)

    def search(questions: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        held = [Block(r.block, r.dim, r.kind, r.ids, r.matrix) for r in found.sort_values("block").itertuples()]
        out = []
        for r in questions.sort_values("block").itertuples():
            asking = Block(r.block, r.dim, r.kind, r.ids, r.matrix, np.flatnonzero(np.frombuffer(r.asks, "?")))
            asking.home = np.full(len(asking.ids), r.block)
            if not held or not len(asking.ids):
                continue
            best = Best(len(asking.ids), k)
            for block in held:
                # own rows are found by their place in the stored block, which is the candidates' place too
                scan(asking, block, best)
            out.append(pd.DataFrame({
                "query_block": r.block, "query_at": asking.at[best.query], "query_id": asking.ids[best.query],
                "vec_id": best.rows[0], "block": best.rows[1], "at": best.rows[2], "score": best.score,
            }))
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in BEST.split(", ")})

    by_task = questions.groupBy("goal", "lane", "dim").cogroup(candidates.groupBy("part", "lane", "dim"))
    some = by_task.applyInPandas(search, BEST)
    order = Window.partitionBy("query_block", "query_at").orderBy(F.desc("score"), "vec_id", "block", "at")
    best = some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as x
    from embeddings
    where embedding is not null and vec_id is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id
    where q.vec_id % 20 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored
qualify rank <= 20
"""
