"""A mix of sources at target weights: exact block quotas, split down a tree of output shards.

Each source is a stream of its documents in random order, cut into blocks of equally many words. A source's
target fixes how many blocks the mix draws from it: whole passes over the stream, and a part of one more. The
tree starts with these quotas at its root. Each node deals its blocks to its two halves by a multivariate
hypergeometric draw, so that every shard ends with the number of blocks of each source that one great shuffle
would have given it, without any shuffle of the data. Shards take consecutive ranks of a source's permuted
blocks, so what they draw is disjoint, and order their blocks on their own.

Whole passes hand out whole documents, in the block where they start. In the partial pass a document is cut
where a drawn block begins or ends, which is what makes a source's words meet its target exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stowage.llm.native import word_count
from stowage.llm.shipping import let_go
from stowage.llm.words import WORD, chunks, mix
from stowage.session import share

BLOCK = 4096  # most words of a block
LEAST_BLOCKS = 64  # blocks of a small source
SHARD_BLOCKS = 256  # blocks of an output shard
BUCKET_ROWS = 1000  # documents whose words are summed in one window
SUBTREE = 64  # shards of a subtree that is expanded at once
TASK_SHARDS = 256  # shards a task expands
GROUP = 1024  # sources whose blocks are dealt by one tree
DECK = 500_000_000  # blocks of one draw


def numbered(sums: DataFrame) -> DataFrame:
    """``sums`` with ``source_id``: places by code point, null last, counted per sorted partition and added up."""
    at = F.monotonically_increasing_id()
    placed = share(sums.orderBy(F.col("source").asc_nulls_last()).withColumn("_at", at), "mix-sources")
    placed = placed.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    parts = placed.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per partition, however many sources
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return placed.join(parts, "_part").withColumn("source_id", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def water_level(sources: DataFrame, total: float, most: float) -> float | None:
    """The level u at which targets of min(weight * u, most * size) add up to ``total``; none if no source is below.

    Starts with no source at its bound and raises the level by what the bounds cut off, until no further source
    reaches its own. A round is one sum over the sources; only that sum comes to the driver.
    """
    bound, level, over = F.lit(most) * F.col("size"), None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > bound
        sums = sources.filter("size > 0").agg(
            F.count_if(full).alias("n"), F.sum(F.when(full, F.col("size")).otherwise(0)).alias("full"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not sums["weight"]:
            return None
        if sums["n"] == over:
            return level
        over, level = sums["n"], (total - most * sums["full"]) / sums["weight"]


def recipe(
    sums: DataFrame, share_of_all: float = 1.5, most: float = 2.0, cycle: tuple[int, ...] = (5, 2, 1)
) -> DataFrame:
    """(stream, source_id, source_size, target, passes, extra, block_words, n_blocks, quota) per row of ``sums``.

    Weights repeat ``cycle`` in the order of the sources. A target stops at ``most`` times its source, the excess is
    shared again by weight. ``passes`` are whole turns of the source, ``extra`` the words of one more, ``quota`` the
    blocks of both. ``sums`` holds stream, source and size, one row per source.
    """
    weights = F.array(*[F.lit(w) for w in cycle])
    sources = numbered(sums).withColumn("weight", F.element_at(weights, (F.col("source_id") % len(cycle) + 1).cast("int")))
    total = sources.agg(F.sum("size").alias("n")).first()["n"] or 0
    level = water_level(sources, share_of_all * total, most)
    bound = F.lit(most) * F.col("size")
    target = bound if level is None else F.least(F.col("weight") * F.lit(level), bound)
    taken = F.least(F.bround("target").cast("long"), F.floor(bound))
    sized = sources.withColumn("target", target.cast("double")).withColumn("_taken", taken)
    some = F.col("size") > 0
    blocks = sized.select(
        "stream", "source_id", F.col("size").alias("source_size"), "target",
        F.when(some, F.expr("_taken div size")).otherwise(0).alias("passes"),
        F.when(some, F.expr("_taken % size")).otherwise(0).alias("extra"),
        F.least(F.lit(BLOCK), F.greatest(F.lit(1), F.expr(f"(size + {LEAST_BLOCKS - 1}) div {LEAST_BLOCKS}"))).alias("block_words"),
    )
    blocks = blocks.withColumn("n_blocks", F.expr("(source_size + block_words - 1) div block_words"))
    quota = F.expr("passes * n_blocks + (extra + block_words - 1) div block_words")
    return share(blocks.withColumn("quota", quota), "mix-recipe")


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: four Feistel rounds over the next even number of bits, walked into range."""
    if n <= 1:
        return x.copy()
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out, todo = x.astype(np.uint64), np.arange(len(x))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in range(4):
            noise = mix(right + np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) & mask
            left, right = right, left ^ noise
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def deal(random: np.random.Generator, quota: np.ndarray, count: int) -> np.ndarray:
    """A multivariate hypergeometric draw; blocks beyond ``DECK`` are dealt as several decks of equal make-up."""
    total = int(quota.sum())
    decks = total // DECK + 1
    hand, dealt, drawn = np.zeros_like(quota), 0, 0
    for j in range(decks):
        deck = (quota + j) // decks
        dealt += int(deck.sum())
        part = count * dealt // total - drawn if total else 0
        hand += random.multivariate_hypergeometric(deck, part, method="marginals")
        drawn += part
    return hand


def split(node: int, shards: int, quota: np.ndarray, seed: int, group: int = 0) -> tuple[np.ndarray, int]:
    """Blocks of each source that go to the left half, and that half's shards.

    The half takes its part of the group's blocks; what is left over of a block is decided by chance, so that groups
    don't all favour the same half.
    """
    left = shards // 2
    random = np.random.default_rng([seed, node, group])
    count, rest = divmod(int(quota.sum()) * left, shards)
    return deal(random, quota, count + int(random.integers(shards) < rest)), left


def descend(node: int, shards: int, first: int, quota: np.ndarray, start: np.ndarray, seed: int, stop: int, group: int = 0):
    """Nodes of at most ``stop`` shards below a node that hold blocks: (node, shards, first shard, quota, first ranks)."""
    todo = [(node, shards, first, quota, start)]
    while todo:
        node, shards, first, quota, start = todo.pop()
        if not quota.any():
            continue
        if shards <= stop:
            yield node, shards, first, quota, start
            continue
        left, n = split(node, shards, quota, seed, group)
        todo.append((2 * node + 1, shards - n, first + n, quota - left, start + left))
        todo.append((2 * node, n, first, left, start))


def leaf(shard: int, quota: np.ndarray, start: np.ndarray, n_blocks: np.ndarray, low: int, seed: int) -> pd.DataFrame:
    """The blocks a shard draws from a group of sources, ``low`` the first, each at a random place of the shard."""
    parts = []
    for k in np.flatnonzero(quota):
        n, source = int(n_blocks[k]), low + int(k)
        ranks = np.arange(start[k], start[k] + quota[k])
        turn, at = ranks // n, ranks % n
        block = at.copy()
        for e in np.unique(turn):  # the short block at the stream's end keeps the last rank of a pass
            inner = (turn == e) & (at < n - 1)
            block[inner] = permute(at[inner], n - 1, seed * 1_000_003 + source * 64 + int(e))
        parts.append(pd.DataFrame({"source_id": source, "block": block, "pass": turn, "at": at}))
    out = pd.concat(parts)
    out["shard"] = shard
    out["place"] = np.random.default_rng([seed, 1, shard, low]).integers(1 << 62, size=len(out))
    return out


def draws(plan: DataFrame, seed: int) -> DataFrame:
    """(source_id, block, pass, at, shard, place): every block the mix draws, ``at`` its rank in the pass.

    A tree of shards deals out the blocks of ``GROUP`` sources; with more sources there is a tree per group over the
    same shards, each dealing every shard its part of the group. Trees are cut into subtrees of ``SUBTREE`` shards,
    which are dealt to tasks; the driver sees the number of blocks only.
    """
    shards = max(1, -(-(plan.agg(F.sum("quota").alias("n")).first()["n"] or 0) // SHARD_BLOCKS))
    rows = F.array_sort(F.collect_list(F.struct("source_id", "quota", "n_blocks")))
    groups = plan.groupBy(F.expr(f"source_id div {GROUP}").alias("group")).agg(rows.alias("_rows")).select(
        "group", F.col("_rows.quota").alias("quota"), F.col("_rows.n_blocks").alias("n_blocks")
    )
    subtree, width = SUBTREE, GROUP

    def plant(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group, quota, n_blocks in batch.itertuples(index=False):
                quota = np.array(quota, dtype=np.int64)
                for node, n, first, q, s in descend(1, shards, 0, quota, np.zeros_like(quota), seed, subtree, group):
                    yield pd.DataFrame({
                        "group": [group], "node": [str(node)], "shards": [n], "first": [first], "quota": [q], "start": [s],
                        "n_blocks": [n_blocks],
                    })

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group, node, n, first, quota, start, n_blocks in batch.itertuples(index=False):
                quota, start = np.array(quota, dtype=np.int64), np.array(start, dtype=np.int64)
                for _, _, shard, q, s in descend(int(node), n, first, quota, start, seed, 1, group):
                    yield leaf(shard, q, s, n_blocks, group * width, seed).astype("int64")

    arrays = "quota array<long>, start array<long>, n_blocks array<long>"
    planted = groups.mapInPandas(plant, f"group long, node string, shards long, first long, {arrays}")
    tasks = -(-shards // TASK_SHARDS)  # a number, since a row of a few kB grows to many blocks
    return planted.repartition(tasks, "group", "node").mapInPandas(
        expand, "source_id long, block long, pass long, at long, shard long, place long"
    )


def streams(sized: DataFrame, plan: DataFrame, buckets: int) -> DataFrame:
    """``sized`` rows with their source's recipe and ``begin``: the words of the stream before the document.

    Prefix sums in three levels, documents of a bucket, buckets of a range, ranges of a source, so that no window
    holds a whole source. The recipe joins the sums per bucket, not the documents: a hot source is many buckets, and
    rows meet their bucket in the partitioning that their window has already.
    """
    top = buckets.bit_length() - 1
    rows = sized.withColumn("bucket", F.shiftrightunsigned("ticket", 64 - top) if top else F.lit(0).cast("long"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("stream", "bucket").orderBy("ticket", "doc_id", "row")
    within = rows.withColumn("_in", F.coalesce(F.sum("size").over(before(inner)), F.lit(0)))
    totals = rows.groupBy("stream", "bucket").agg(F.sum("size").alias("_words"))
    ranges = totals.withColumn("_range", F.shiftright("bucket", 10))
    by_range = ranges.groupBy("stream", "_range").agg(F.sum("_words").alias("_sum")).select(
        "stream", "_range",
        F.coalesce(F.sum("_sum").over(before(Window.partitionBy("stream").orderBy("_range"))), F.lit(0)).alias("_r"),
    )
    in_range = ranges.withColumn(
        "_b", F.coalesce(F.sum("_words").over(before(Window.partitionBy("stream", "_range").orderBy("bucket"))), F.lit(0))
    )
    starts = in_range.join(by_range, ["stream", "_range"]).join(plan, "stream").select(
        "stream", "bucket", (F.col("_b") + F.col("_r")).alias("_at"), "source_id", "source_size", "target", "passes",
        "extra", "block_words",
    )
    return within.join(starts, ["stream", "bucket"]).withColumn("begin", F.col("_at") + F.col("_in")).drop("_at", "_in", "stream")


def mix_sources(docs: DataFrame, seed: int = 7, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, mixture). ``rows``: ``row``, ``doc_id``, ``body`` (hash of the text), ``size``, ``source_size`` and
    ``target`` per row of ``docs``. ``mixture``: ``row``, ``from_word``, ``n_words``, ``shard``, ``place`` and
    ``begin``: which words of which row the mix takes, and where; order by the last three to lay out a shard.

    The order within a source follows from a hash of id and text, so reruns agree. Sources stay a table; sums over all
    of them are what the driver sees. A null text has no words; a row without words is never taken; a null source is
    a source, the last one. Repeated rows are taken each on their own. An empty table gives empty results. Columns
    other than ``doc_id``, ``source`` and the text are not read.
    """
    body = F.xxhash64(docs[text])
    source = F.col("source").cast("string")
    sized = share(
        docs.select(
            "doc_id", source.alias("source"), F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("stream"),
            word_count(docs[text]).alias("size"), body.alias("body"), F.xxhash64(F.lit(seed), "doc_id", body).alias("ticket"),
        ),
        "mix-sizes",
    ).withColumn("row", F.monotonically_increasing_id())
    plan = recipe(sized.groupBy("stream", "source").agg(F.sum("size").alias("size")))
    buckets = 1 << max(0, (sized.count() // BUCKET_ROWS).bit_length())
    rows = share(streams(sized.drop("source"), plan, buckets), "mix-rows")
    drawn = draws(plan, seed)

    first, last = F.floor(F.col("begin") / F.col("block_words")), F.floor((F.col("begin") + F.col("size") - 1) / F.col("block_words"))
    some = rows.filter("size > 0").select("row", "begin", "size", "source_id", "passes", "extra", "block_words", first.alias("_first"), last.alias("_last"))
    whole = (
        some.withColumnRenamed("_first", "block")
        .join(drawn, ["source_id", "block"])
        .filter(F.col("pass") < F.col("passes"))
        .select("row", F.lit(0).cast("long").alias("from_word"), F.col("size").alias("n_words"), "shard", "place", "begin")
    )
    left, right = F.greatest("begin", F.col("block") * F.col("block_words")), F.least(
        F.col("begin") + F.col("size"), F.col("block") * F.col("block_words")
        + F.least(F.col("block_words"), F.col("extra") - F.col("at") * F.col("block_words")),
    )
    cut = (
        some.filter("extra > 0").withColumn("block", F.explode(F.sequence("_first", "_last")))
        .join(drawn, ["source_id", "block"])
        .filter(F.col("pass") == F.col("passes"))
        .select("row", (left - F.col("begin")).alias("from_word"), (right - left).alias("n_words"), "shard", "place", "begin")
        .filter("n_words > 0")
    )
    return rows.select("row", "doc_id", "body", "size", "source_size", "target"), whole.unionByName(cut)


def taken_words(rows: DataFrame, mixture: DataFrame) -> DataFrame:
    """``rows`` with ``taken``: the words the mix takes from each, repeats counted."""
    sums = mixture.groupBy("row").agg(F.sum("n_words").alias("taken"))
    return rows.join(sums, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def word_slice(text: str, first: int, n: int) -> str:
    """Words ``first`` to ``first + n`` of a text with the blanks between them."""
    begin = end = 0
    for k, m in enumerate(re.finditer(WORD, text)):
        if k == first:
            begin = m.start()
        if k == first + n - 1:
            end = m.end()
            break
    return text[begin:end]


def mixed_documents(docs: DataFrame, seed: int = 7, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each run of words the mix takes, laid out by shard.

    Texts that are taken whole are unchanged, cut ones keep the blanks between their words; ``chars`` is the length
    of the new text. A document drawn twice gives two rows with its id. Of rows that repeat an id and a text, each is
    drawn on its own, with the other columns of one of them; rows without words (null, empty or blank texts) are never
    drawn; an empty table gives none. Columns may have any names. Each run of words is a row of its own from the
    join on, so a document that is drawn very often is no group of a task.
    """
    rows, mixture = mix_sources(docs, seed, text)
    runs = mixture.join(rows.select("row", F.col("doc_id").alias("_doc"), F.col("body").alias("_body"), F.col("size").alias("_size")), "row").drop("row")
    runs = share(runs, "mix-runs")
    again = share(rows.groupBy("doc_id", "body").agg(F.count("*").alias("_n")).filter("_n > 1").select("doc_id", "body"), "mix-repeats")
    keyed = docs.select(F.struct("*").alias("_row"), docs["doc_id"].alias("_id"), F.xxhash64(docs[text]).alias("_hash"))
    repeated = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("body"))
    once = keyed.join(again, repeated, "left_semi").dropDuplicates(["_id", "_hash"])
    keyed = keyed.join(again, repeated, "left_anti").unionByName(once)
    same = F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_body"))
    own = [F.col("_row").getField(c).alias(f"c{k}") for k, c in enumerate(docs.columns)]
    places = ["shard", "place", "begin"]
    joined = runs.join(keyed, same).select(*own, "_size", "from_word", "n_words", *places)
    width = len(docs.columns)
    text_at, chars_at = docs.columns.index(text), docs.columns.index(chars)
    names = [*[f"c{k}" for k in range(width)], *places]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in chunks(batch, f"c{text_at}"):
                size, first, n = (some.column(width + k).to_pylist() for k in range(3))
                texts = some.column(text_at).to_pylist()
                texts = [t if n[k] == size[k] else word_slice(t, first[k], n[k]) for k, t in enumerate(texts)]
                columns = some.columns[:width]
                columns[text_at] = pa.array(texts, pa.string())
                columns[chars_at] = pa.array([len(t) for t in texts], columns[chars_at].type)
                yield pa.RecordBatch.from_arrays([*columns, *some.columns[width + 3 :]], names=names)
        let_go()

    fields = ", ".join(f"c{k} {kind}" for k, (_, kind) in enumerate(docs.dtypes))
    laid = joined.mapInArrow(cut, f"{fields}, shard long, place long, begin long")
    laid = laid.repartition("shard").sortWithinPartitions(*places)
    return laid.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)])
