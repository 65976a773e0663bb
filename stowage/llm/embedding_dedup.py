"""Near-duplicate vectors by counting collisions on sorted projections.

A table of the index projects every vector on a number of random directions. All but one are cut into cells; in
each combination of cells, rows are sorted by the last projection, and a pair collides when one lies in the window
centred on the other. Vectors at the threshold collide in a known share of the tables, unrelated ones hardly ever.
Collisions are counted per pair over all tables; pairs that reach a count are verified on the vectors. Cells per
table grow with the number of vectors, which makes a collision rarer, so the number of tables follows from them: a
pair right at the threshold reaches two collisions with chance 1 - ``MISS``, at any size. The count is calibrated: a
bounded sample of vectors is compared with all others by brute force, and half of the largest count that still finds
all of its links is taken, as far as a pair at the threshold still reaches it with that chance. Tables are added
until the sample's own loss at that count is no more than ``MISS``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.llm.components import components
from stowage.llm.words import mix
from stowage.session import share

CELL = 4.0  # cell width, in standard deviations of a projected difference at the threshold
WINDOW = 3.0  # half width of the window, alike
APART = 0.40  # chance that unrelated vectors share a cell; fixes how many cells a table needs
MOST_ROWS = 4000  # rows of a cell that one task pairs at once
SAMPLE = 400  # vectors compared with all others to calibrate the count
MISS = 0.001  # share of links at the threshold that may be lost


def chance(cells: int) -> float:
    """That a pair right at the threshold collides in a table: its projected difference is normal."""
    within = lambda x: math.erf(x / math.sqrt(2))
    same = within(CELL) - math.sqrt(2 / math.pi) * (1 - math.exp(-CELL * CELL / 2)) / CELL
    return same**cells * within(WINDOW)


def recall(tables: int, cells: int, count: int) -> float:
    """That such a pair collides in ``count`` tables at least."""
    q = chance(cells)
    return 1 - sum(math.comb(tables, k) * q**k * (1 - q) ** (tables - k) for k in range(count))


def tables_for(cells: int, least: int) -> tuple[int, int]:
    """Tables, ``least`` or more, in which a pair at the threshold reaches two collisions, and the count it reaches."""
    tables, count = least, 2
    while recall(tables, cells, count) < 1 - MISS:
        tables += max(1, tables // 50)
    while recall(tables, cells, count + 1) >= 1 - MISS:
        count += 1
    return tables, count


def directions(dim: int, tables: int, cells: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    return random.standard_normal((dim, tables * (cells + 1))), random.random(tables * cells)


def unit_vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def project(vectors: DataFrame, dim: int, tables: int, cells: int, cosine: float, seed: int) -> DataFrame:
    """(cell, id, at): a row per table, and one more where a row's window reaches into the next slab.

    A slab is a stretch of the sorted projection four windows long, which bounds what is sorted together.
    """
    spread = np.sqrt(2 - 2 * cosine)
    window = WINDOW * spread

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways, shift = directions(dim, tables, cells, seed)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids = part.column(0).to_numpy()
                p = (unit_vectors(part.column(1)) @ ways).reshape(len(ids), tables, cells + 1)
                grid = np.floor(p[:, :, :cells] / (CELL * spread) + shift.reshape(1, tables, cells)).astype(np.int64)
                key = np.broadcast_to(np.arange(1, tables + 1, dtype=np.uint64), (len(ids), tables)).copy()
                for k in range(cells):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + grid[:, :, k].astype(np.uint64))
                at = p[:, :, cells]
                slab = np.floor(at / (4 * window)).astype(np.int64)
                guest = np.floor((at + window) / (4 * window)).astype(np.int64) > slab
                home = mix(key + slab.astype(np.uint64))
                near = mix(key + (slab + 1).astype(np.uint64))
                who = np.broadcast_to(ids[:, None], at.shape)
                yield pa.RecordBatch.from_pydict({
                    "cell": np.concatenate([home.ravel(), near[guest]]).view(np.int64),
                    "id": np.concatenate([who.ravel(), who[guest]]), "at": np.concatenate([at.ravel(), at[guest]]),
                    "guest": np.concatenate([np.zeros(at.size, bool), np.ones(int(guest.sum()), bool)]),
                })

    return vectors.select("id", "embedding").mapInArrow(run, "cell long, id long, at double, guest boolean")


def collide(window: float):
    """Pairs inside a window, for a bucket of cells: sorted once, then row against the k-th next row."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["unit", "cell", "at", "id"], ignore_index=True)
        unit, cell, at, ids = (rows[c].to_numpy() for c in ("unit", "cell", "at", "id"))
        guest, side = rows["guest"].to_numpy(), rows["side"].to_numpy()
        found, step, some = [], 1, np.arange(len(rows))
        while len(some):
            some = some[some + step < len(rows)]
            other = some + step
            some = some[(cell[some] == cell[other]) & (unit[some] == unit[other]) & (at[other] - at[some] <= window)]
            other = some + step
            # two guests meet in their own slab; of a split cell, only rows of its two parts meet here
            good = ~(guest[some] & guest[other]) & (ids[some] != ids[other]) & ((side[some] != side[other]) | (side[some] < 0))
            found.append(np.stack([ids[some[good]], ids[other[good]]]))
            step += 1
        pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pd.DataFrame({"a": pairs.min(axis=0), "b": pairs.max(axis=0)})

    return run


def collisions(rows: DataFrame, window: float, size: int) -> DataFrame:
    """(a, b, n): in how many tables a pair collides.

    Cells are hashed into buckets of bounded size. A cell of more than ``MOST_ROWS`` rows is cut into parts, and its
    rows are sent to every pair of parts that includes their own, so that no task holds a crowded cell.
    """
    crowded = rows.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > MOST_ROWS)
    crowded = share(crowded.select(F.col("cell").alias("_cell"), F.ceil(F.col("n") / (MOST_ROWS // 2)).cast("int").alias("parts")), "crowded")
    buckets = max(8, size // 100_000)
    marked = rows.join(crowded, F.col("cell") == F.col("_cell"), "left")
    plain = marked.filter("parts is null").select(
        "cell", "id", "at", "guest", F.lit(0).cast("long").alias("unit"), F.lit(-1).alias("side"),
        F.pmod("cell", F.lit(buckets)).alias("bucket"),
    )
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    split = marked.filter("parts is not null").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    unit = (low * F.col("parts") + high + 1).cast("long")
    split = split.select(
        "cell", "id", "at", "guest", unit.alias("unit"),
        F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side"),
        F.pmod(F.xxhash64("cell", unit), F.lit(buckets)).alias("bucket"),
    )
    pairs = plain.unionByName(split).groupBy("bucket").applyInPandas(collide(window), "a long, b long")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"))


def cosines(pairs: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """The pairs whose vectors reach the cosine, in double precision."""
    both = pairs.join(vectors.select(F.col("id").alias("a"), F.col("embedding").alias("x")), "a").join(
        vectors.select(F.col("id").alias("b"), F.col("embedding").alias("y")), "b"
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                dot = (unit_vectors(batch.column(2)) * unit_vectors(batch.column(3))).sum(axis=1)
                yield batch.select([0, 1]).filter(pa.array(dot >= cosine))

    return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def sample_links(vectors: DataFrame, rows: int, cosine: float) -> DataFrame:
    """(a, b): links of a bounded sample of vectors with all vectors, by brute force in blocks."""
    chosen = vectors.orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(rows).collect()
    ids = np.array([r["id"] for r in chosen], dtype=np.int64)
    x = np.array([r["embedding"] for r in chosen], dtype=np.float64)
    x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                other = batch.column(0).to_numpy()
                q, r = np.nonzero(x @ unit_vectors(batch.column(1)).T >= cosine)
                a, b = ids[q], other[r]
                a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
                yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    return vectors.select("id", "embedding").mapInArrow(run, "a long, b long").distinct()


def usable(embedding: str):
    """A vector with numbers only, at least one of them other than zero."""
    x = F.col(embedding)
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & F.forall(x, fine) & F.exists(x, lambda v: v != 0)


def near_vectors(
    vectors: DataFrame, cosine: float = 0.95, tables: int = 96, seed: int = 11, id_col: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id`` (smallest id reachable by links) and ``kept``.

    Equal vectors are one from the start, with their number kept as weight, so a crowd of copies costs as much as
    one vector; all of them link with each other. Links are verified in double precision, none lies below
    ``cosine``, and one at ``cosine`` is lost with chance ``MISS``, nearer ones more seldom; ``tables`` is the least number
    of tables, and grows with the rows. Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
    those of different lengths with each other; rows with a null id link with nothing and have null
    ``component_id`` and ``kept``. Rows that share an id count as one vector. An empty table gives none. Other
    columns are not read.
    """
    all_rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("embedding"))
    good = all_rows.filter(usable("embedding") & F.col("id").isNotNull()).dropDuplicates(["id"])
    bodies = F.xxhash64("embedding"), F.xxhash64(F.lit(1), "embedding")
    hashed = good.select("id", bodies[0].alias("h1"), bodies[1].alias("h2"), F.size("embedding").alias("dim"))
    hashed = share(hashed, "vector-ids")
    groups = share(hashed.groupBy("h1", "h2", "dim").agg(F.min("id").alias("node"), F.count("*").alias("weight")), "vector-groups")
    dims = [r["dim"] for r in groups.select("dim").distinct().collect()]
    nodes = share(good.join(groups.select(F.col("node").alias("id"), "weight"), "id"), "vectors")
    found = None
    for dim in dims:
        links = _links_of(nodes.filter(F.size("embedding") == dim), dim, cosine, tables, seed)
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = nodes.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    links = share(found, "vector-links")
    weights = nodes.select("id", "weight")
    sums = (
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .join(weights.select(F.col("id").alias("b"), "weight"), "b")
        .groupBy("a").agg(F.sum("weight").alias("others"))
    )
    labels = components(links)
    told = (
        groups.join(sums, F.col("node") == F.col("a"), "left").join(labels.withColumnRenamed("id", "_id"), F.col("node") == F.col("_id"), "left")
        .select("h1", "h2", "dim", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    )
    of_id = hashed.join(told, ["h1", "h2", "dim"]).select(F.col("id").alias("_id"), "n_links", "component_id")
    return all_rows.select("id").join(of_id, F.col("id") == F.col("_id"), "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"), (F.coalesce("component_id", "id") == F.col("id")).alias("kept"),
    )


def _links_of(nodes: DataFrame, dim: int, cosine: float, tables: int, seed: int) -> DataFrame:
    n = nodes.count()
    cells = min(24, max(2, round(np.log(max(n, 2)) / -np.log(APART))))
    more, sure = tables_for(cells, tables)
    window = WINDOW * float(np.sqrt(2 - 2 * cosine))

    def counts(tables: int, seed: int) -> DataFrame:
        rows = share(project(nodes, dim, tables, cells, cosine, seed), "projections")
        return share(collisions(rows, window, n * tables), "collisions")

    counted = counts(more, seed)
    truth = share(sample_links(nodes, SAMPLE, cosine), "sample-links")

    def found(counted: DataFrame) -> dict[int, int]:
        seen = truth.join(counted, ["a", "b"], "left").groupBy(F.coalesce("n", F.lit(0)).alias("n")).agg(F.count("*").alias("k"))
        return {r["n"]: r["k"] for r in seen.collect()}

    seen = found(counted)
    count = max(1, min(sure, min(seen, default=0) // 2)) if seen else sure
    while sum(k for m, k in seen.items() if m < count) > MISS * sum(seen.values()):
        seed += 1
        both = counted.unionByName(counts(tables, seed))
        counted = share(both.groupBy("a", "b").agg(F.sum("n").alias("n")), "collisions")
        seen = found(counted)
    return cosines(counted.filter(F.col("n") >= count).select("a", "b"), nodes, cosine)
