"""Documents that share most of their word windows, found through parity sketches.

A document is the set of its distinct 5-word shingles. Two sets of sizes a and b with a Jaccard similarity of at
least 0.8 differ in at most D = (a + b) / 9 shingles. A level has K > D parts; each shingle belongs to one part by
its hash, and a part's value is the XOR of its shingles' hashes. Parts that differ hold a differing shingle, so
at least K - D parts agree, and documents that link meet on a (level, part, value) key: the pigeonhole join. Sizes
choose the level, so a document takes part in one or two.

Candidates are then compared by a parity sketch of one bit per shingle hash: a shingle flips a bit, so the Hamming
distance is a lower bound of the symmetric difference, and a pair above D is out. What is left is verified on the
shingles themselves.

Documents that share a key are a group; equal groups are kept once. Each member is compared with two leaders of its
group first, and only members that are still in different components then meet one another. A key shared by more
than ``HOT`` different sets makes no group. A document with fewer such keys than
the K - D it is sure to share has another one, and is found through it. Only pairs of documents that have many hot
keys, large groups of near copies, depend on them. These are compared with leaders of each key first. What then is
still in different components of a group is compared by the parity sketches alone, inside tasks, in blocks of
documents of like size; only pairs that the sketches allow leave a task, to be verified. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.llm.components import components
from stowage.llm.shipping import let_go
from stowage.llm.words import chunks, mix, mix_int, windows, word_hashes
from stowage.session import share

WIDTH = 5
HOT = 32
GROWTH = 1.6
IDS = 2_000_000  # ids of eight bytes that are broadcast to pick texts, sixteen megabytes
BLOCK = 2000  # documents of a block whose sketches are compared with another's
ENTRIES = 1_000_000  # keys of a bucket, and of a task's buffer
_PARTS = [4]
while _PARTS[-1] < 1 << 40:
    _PARTS.append(int(_PARTS[-1] * GROWTH) + 1)
PARTS = np.array(_PARTS)


def slack(d: np.ndarray) -> np.ndarray:
    return 1 + (d + 7) // 8


# The largest D of each level: K parts leave at least a ninth of them to agree.
REACH = np.array([max(d for d in (k * 8 // 9 - 2 + j for j in range(5)) if d + slack(np.int64(d)) <= k) for k in _PARTS])


def levels_of(n: int) -> list[tuple[int, int]]:
    """(level, parts sure to agree) of a set of n shingles, over all sizes it can link with."""
    low, high = (n + -(-4 * n // 5)) // 9, (n + 5 * n // 4) // 9
    if high == 0:
        return []  # only an equal set can link
    first, last = (int(np.searchsorted(REACH, max(d, 1))) for d in (low, high))
    return [(k, int(PARTS[k]) - min(int(REACH[k]), high)) for k in range(first, last + 1)]


def sets_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    shingles, ends = windows(*word_hashes(column), WIDTH)
    for k in range(len(column)):
        yield np.unique(shingles[ends[k] : ends[k + 1]])


def parity(values: np.ndarray) -> bytes:
    """One bit per hash place, flipped by each shingle; four to eight times as many places as shingles."""
    bits = max(6, len(values).bit_length() + 2)
    places = (values >> np.uint64(64 - bits)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=1 << bits) & 1).astype(np.uint8)).tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch with neighbouring places merged until it has ``size`` bytes."""
    bits = np.unpackbits(np.frombuffer(sketch, dtype=np.uint8))
    while len(bits) > 8 * size:
        bits = bits[0::2] ^ bits[1::2]
    return bits


def part_of(values: np.ndarray, level: int) -> np.ndarray:
    """The part of each shingle hash on a level."""
    parts = int(PARTS[level])
    if parts < 1 << 30:
        return ((values >> np.uint64(20)) & np.uint64(0xFFFFFFFF)).astype(np.int64) * parts >> 32
    return (values % np.uint64(parts)).astype(np.int64)


def bears(values: np.ndarray) -> int:
    """How many hot keys a set bears: with fewer, it shares another key with every set it links with."""
    found = [sure - int(PARTS[k]) + len(np.unique(part_of(values, k))) for k, sure in levels_of(len(values))]
    return max(0, min(found, default=0))


def part_keys(values: np.ndarray) -> np.ndarray:
    """Keys of a set on all its levels.

    A part without shingles is no key, unless the set has so many that all sure ones might be empty.
    """
    keys = []
    for level, sure in levels_of(len(values)):
        part = part_of(values, level)
        order = np.argsort(part, kind="stable")
        at = part[order]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        words = np.bitwise_xor.reduceat(mix(values[order]), first)
        found, parts = at[first], int(PARTS[level])
        if sure <= parts - len(found):
            empty = np.setdiff1d(np.arange(parts), found)
            found, words = np.concatenate([found, empty]), np.concatenate([words, np.zeros(len(empty), np.uint64)])
        keys.append(mix(words + found.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(mix_int(level + 1))))
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def signatures(docs: DataFrame, text: str) -> DataFrame:
    """Per row: id, set size, a digest of the set in two numbers, its parity sketch, and the hot keys it bears."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text"):
                rows = []
                for doc_id, s in zip(part.column(0).to_pylist(), sets_of(part.column(1))):
                    d = [int(x) - (1 << 63) for x in (np.add.reduce(s, dtype=np.uint64), np.bitwise_xor.reduce(mix(s ^ np.uint64(0x5555)), initial=np.uint64(0)))]
                    rows.append((doc_id, len(s), d[0], d[1], parity(s), bears(s)))
                names = ["doc_id", "n_shingles", "d1", "d2", "sketch", "bears"]
                kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs[text].alias("_text"))
    return thin.mapInArrow(sign, "doc_id long, n_shingles long, d1 long, d2 long, sketch binary, bears long")


def runs_of(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct (key, document) pairs in order, how many documents each one's key has, and its place among them."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    keys, docs = keys[fresh], docs[fresh]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(keys)))
    return keys, docs, np.repeat(size, size), np.arange(len(keys)) - np.repeat(first, size)


def packed_keys(docs: DataFrame, buckets: int, most: int) -> DataFrame:
    """(bucket, keys, docs): the keys of many documents, sorted by bucket, as packed arrays.

    Of a key with more than ``most`` documents, a task sends ``most`` + 1 to the key's bucket, which shows there that
    the key is hot; the others get buckets of their own, below zero, so that no group holds a hot key's documents.
    """

    def emit(keys: list[np.ndarray], ids: list[int], number: int) -> pa.RecordBatch:
        k = np.concatenate(keys)
        d = np.repeat(np.array(ids, dtype=np.int64), [len(x) for x in keys])
        k, d, _, place = runs_of(k, d)
        bucket = np.where(place <= most, (k % np.uint64(buckets)).astype(np.int64), -1 - number)
        order = np.argsort(bucket, kind="stable")
        k, d, bucket = k[order], d[order], bucket[order]
        found, first = np.unique(bucket, return_index=True)
        stops = [*first[1:], len(k)]
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array(found, pa.int64()),
            "keys": pa.array([k[a:b].tobytes() for a, b in zip(first, stops)], pa.binary()),
            "docs": pa.array([d[a:b].tobytes() for a, b in zip(first, stops)], pa.binary()),
        })

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        keys, ids, held, number = [], [], 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            for part in chunks(batch, "_text"):
                for doc_id, s in zip(part.column(0).to_pylist(), sets_of(part.column(1))):
                    own = part_keys(s)
                    if len(own):
                        keys.append(own)
                        ids.append(doc_id)
                        held += len(own)
                if held >= ENTRIES:
                    yield emit(keys, ids, number)
                    keys, ids, held, number = [], [], 0, number + 1
        if held:
            yield emit(keys, ids, number)
        let_go()

    return docs.mapInArrow(make, "bucket long, keys binary, docs binary")


MET = "key long, doc_id long, members array<long>"


def meet(most: int):
    """Of one bucket: the sets of documents that share a key, each once (``members``), and, of keys with more than
    ``most`` documents, a row per document (``key``, ``doc_id``). Both have fewer rows than the bucket has keys."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(group["keys"]), dtype=np.uint64)
        docs = np.frombuffer(b"".join(group["docs"]), dtype=np.int64)
        keys, docs, of, place = runs_of(keys, docs)
        hot = of > most if group["bucket"].iloc[0] >= 0 else np.ones(len(keys), dtype=bool)
        members: list[np.ndarray] = []
        for size in range(2, most + 1):
            first = np.flatnonzero((of == size) & (place == 0) & ~hot)
            if len(first):
                members.extend(np.unique(docs[first[:, None] + np.arange(size)], axis=0))
        n, m = int(hot.sum()), len(members)
        blank = lambda x, rest: pd.array([*x.tolist(), *[None] * rest], dtype="Int64")
        return pd.DataFrame({
            "key": blank(keys[hot].view(np.int64), m), "doc_id": blank(docs[hot], m),
            "members": pd.Series([*[None] * n, *members], dtype=object),
        })

    return run


def stars(groups: DataFrame) -> DataFrame:
    """(a, b): each member of a group with the group's first and last; a number of rows in proportion to members."""
    m = F.col("members")
    ends = [F.transform(m, lambda x, e=e: F.struct(F.least(x, e).alias("a"), F.greatest(x, e).alias("b"))) for e in (m[0], F.element_at(m, -1))]
    return groups.select(F.explode(F.array_distinct(F.concat(*ends))).alias("p")).select("p.a", "p.b").filter("a < b").distinct()


def across(groups: DataFrame, chosen: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b): members of a group that are in different components so far and whose sizes let them link."""
    told = chosen.select("doc_id", "n_shingles").join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    told = told.select("doc_id", F.struct("doc_id", F.coalesce("component", "doc_id").alias("label"), F.col("n_shingles").alias("n")).alias("x"))
    told = share(told, "labelled-sets")
    # a hash that two groups have in common would make them one, which only adds pairs to look at
    named = groups.select(F.xxhash64("members").alias("group"), F.explode("members").alias("doc_id")).join(told, "doc_id")
    kept = named.groupBy("group").agg(F.collect_list("x").alias("x"), F.min("x.label").alias("low"), F.max("x.label").alias("high"))

    def partners(x):
        def fits(y):
            return (y["doc_id"] > x["doc_id"]) & (y["label"] != x["label"]) & (x["n"] * 4 <= y["n"] * 5) & (y["n"] * 4 <= x["n"] * 5)

        return F.transform(F.filter("x", fits), lambda y: F.struct(x["doc_id"].alias("a"), y["doc_id"].alias("b")))

    pairs = kept.filter("low < high").select(F.explode(F.flatten(F.transform("x", partners))).alias("p"))
    return pairs.select("p.a", "p.b").distinct()


def close(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Of distinct pairs (a, b), those that sizes and parity sketches allow, with their Hamming distance."""
    def side(name: str) -> DataFrame:
        return signed.select(F.col("doc_id").alias(name), F.col("n_shingles").alias(f"{name}n"), F.col("sketch").alias(f"{name}s"))

    sizes = F.col("an") * 4 <= F.col("bn") * 5
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(sizes & (F.col("bn") * 4 <= F.col("an") * 5))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            apart = [
                int((folded(x, min(len(x), len(y))) ^ folded(y, min(len(x), len(y)))).sum())
                for x, y in zip(rows["as"], rows["bs"])
            ]
            rows = rows.assign(apart=np.array(apart, dtype=np.int64))
            yield rows.loc[rows["apart"] * 9 <= rows["an"] + rows["bn"], ["a", "b", "apart"]]

    return both.mapInPandas(compare, "a long, b long, apart long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs (a, b), those whose shingle sets have a Jaccard similarity of at least 0.8."""
    both = (
        pairs.select("a", "b")
        .join(texts.select(F.col("doc_id").alias("a"), F.col("_text").alias("x")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("_text").alias("y")), "b")
        .select("a", "b", "x", "y")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "x"):
                linked = []
                for s, t in zip(sets_of(part.column(2)), sets_of(part.column(3))):
                    common = len(np.intersect1d(s, t, assume_unique=True))
                    linked.append(100 * common >= 80 * (len(s) + len(t) - common))
                yield part.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def texts_of(texts: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """The texts that pairs (a, b) name, stored. Up to ``IDS`` ids are broadcast, so that only their texts move."""
    ids = share(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{name}-ids")
    few = ids.count() <= IDS
    return share(texts.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi"), f"{name}-texts")


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def heavy_members(met: DataFrame, chosen: DataFrame) -> DataFrame:
    """(key, doc_id): hot keys of the documents that have too many of them to be sure of another.

    Hot keys are counted over all levels, so a document may be found too heavy, never too light.
    """
    hot = met.filter(F.col("key").isNotNull()).select("key", "doc_id")
    counts = hot.groupBy("doc_id").agg(F.count("*").alias("n"))
    heavy = counts.join(chosen.select("doc_id", "bears"), "doc_id").filter(F.col("n") >= F.col("bears")).select("doc_id")
    return hot.join(heavy, "doc_id", "left_semi")


def with_leaders(members: DataFrame, seed: int) -> DataFrame:
    """(a, b): each member of a key with the member that leads it under this seed."""
    rank = F.struct(F.xxhash64(F.lit(seed), "doc_id").alias("h"), F.col("doc_id"))
    lead = members.groupBy(F.xxhash64("key").alias("_h"), "key").agg(F.min(rank).alias("l")).select("key", F.col("l.doc_id").alias("lead"))
    return ordered(members.join(lead, "key").select(F.col("doc_id").alias("a"), F.col("lead").alias("b")))


def block_pairs(members: DataFrame, leaders: DataFrame, chosen: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b): documents of a hot group, in different components so far, that sizes and sketches allow to link.

    A group is what hot keys connect. Its documents are cut into blocks by size, a factor of 1.25 wide, and by hash
    where more than ``BLOCK`` are of a size; blocks of the same or neighbouring sizes are compared.
    """
    groups = components(leaders)
    size = F.floor(F.log(F.col("n_shingles")) / F.log(F.lit(1.25)) + 1e-9).cast("long")
    docs = (
        members.select("doc_id").distinct()
        .join(groups.select(F.col("id").alias("doc_id"), F.col("component").alias("cluster")), "doc_id")
        .join(labels.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left")
        .join(chosen, "doc_id")
        .select("doc_id", "cluster", F.coalesce("component", "doc_id").alias("label"), "n_shingles", "sketch", size.alias("size"))
    )
    docs = share(docs, "hot-documents")
    counts = docs.groupBy("cluster", "size").agg(F.count("*").alias("n"))
    sizes = share(counts.select("cluster", "size", F.ceil(F.col("n") / BLOCK).alias("parts")), "hot-blocks")
    own = docs.join(sizes, ["cluster", "size"]).withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts"))
    parts = sizes.select("cluster", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    left, right = (parts.select("cluster", F.col("size").alias(f"{x}size"), F.col("part").alias(f"{x}part")) for x in "lr")
    same_size = (F.col("lsize") == F.col("rsize")) & (F.col("lpart") <= F.col("rpart"))
    pairs = share(
        left.join(right, "cluster").filter(same_size | (F.col("lsize") + 1 == F.col("rsize"))), "hot-block-pairs"
    ).withColumn("pair", F.monotonically_increasing_id())
    sent = [
        own.join(pairs, ["cluster"]).filter((F.col("size") == F.col(f"{x}size")) & (F.col("part") == F.col(f"{x}part")))
        .select("pair", F.lit(x).alias("side"), "doc_id", "label", "n_shingles", "sketch")
        for x in "lr"
    ]
    return ordered(sent[0].unionByName(sent[1]).groupBy("pair").applyInPandas(compare_blocks, "a long, b long"))


def compare_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs across the two blocks that are allowed to link; a block that stands on both sides meets itself."""
    size = int(rows["sketch"].map(len).min())
    left, right = (rows[rows["side"] == x] for x in "lr")

    def read(block: pd.DataFrame):
        bits = [np.packbits(folded(s, size)) for s in block["sketch"]]
        words = np.stack(bits).view(np.uint64) if bits else np.zeros((0, size // 8), np.uint64)
        return words, *(block[c].to_numpy() for c in ("doc_id", "label", "n_shingles"))

    (lw, ld, ll, ln), (rw, rd, rl, rn) = read(left), read(right)
    found = []
    for k in range(len(ld)):
        some = np.flatnonzero((rl != ll[k]) & (4 * rn <= 5 * ln[k]) & (4 * ln[k] <= 5 * rn) & (rd != ld[k]))
        apart = np.bitwise_count(rw[some] ^ lw[k]).sum(axis=1, dtype=np.int64)
        good = rd[some[9 * apart <= ln[k] + rn[some]]]
        found.append(np.stack([np.full(len(good), ld[k]), good]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return pd.DataFrame({"a": pairs[0], "b": pairs[1]})


def jaccard_join(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles`` (set size) and ``component_id`` (the smallest id reachable by links).

    Equal sets are one document from the start, however many copies there are. Texts of fewer than five words have
    their whole word sequence as one shingle; null, empty and blank texts have none and link with nothing. Rows
    with the same ``doc_id`` are one document and linked; rows with a null one link with nothing and have a null
    ``component_id``. An empty table gives none. Columns other than ``doc_id`` and the text are not read.
    """
    signed = share(signatures(docs, text), "signatures")
    some = signed.filter("n_shingles > 0 and doc_id is not null")
    nodes = share(
        some.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("_last")), "sets"
    )
    copies = share(
        some.join(nodes.filter("node < _last"), ["d1", "d2", "n_shingles"]).filter("doc_id <> node").select("doc_id", "node"),
        "copies",
    )
    chosen = share(some.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "chosen")
    total = chosen.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    buckets = max(8, total // (2 * ENTRIES))

    # Copies are few against the rest, and left out by an anti join; Spark broadcasts them where they are few enough.
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs[text].alias("_text"))
        .filter(F.col("doc_id").isNotNull())
        .join(copies.select("doc_id").distinct(), "doc_id", "left_anti")
    )
    met = share(packed_keys(texts, buckets, HOT).groupBy("bucket").applyInPandas(meet(HOT), MET), "met")
    groups = share(met.filter(F.col("members").isNotNull()).select("members").distinct(), "groups")
    members = share(heavy_members(met, chosen), "heavy")
    led = share(with_leaders(members, 1), "leaders")
    candidates = stars(groups).unionByName(led)
    near = share(close(candidates.unionByName(with_leaders(members, 2)).distinct(), chosen), "near")

    # A pair per document first, its closest; whatever that leaves apart is verified in full.
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
    best = both.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("m"), F.min("b").alias("least"))
    first = ordered(
        best.select("a", F.col("m.b").alias("b")).unionByName(best.select("a", F.col("least").alias("b")))
    )
    picked = texts_of(texts, near, "near")
    links = share(verified(first, picked), "links")
    labels = components(links)

    def named(side: str) -> DataFrame:
        return labels.select(F.col("id").alias(side), F.col("component").alias(f"{side}c"))

    apart = F.coalesce("ac", "a") != F.coalesce("bc", "b")
    rest = near.select("a", "b").join(named("a"), "a", "left").join(named("b"), "b", "left").filter(apart).select("a", "b")
    late = block_pairs(members, led, chosen, labels).unionByName(close(across(groups, chosen, labels), chosen).select("a", "b"))
    late = share(late.distinct().join(near, ["a", "b"], "left_anti"), "late")
    more = verified(rest.join(first, ["a", "b"], "left_anti"), picked).unionByName(verified(late, texts_of(texts, late, "late")))
    more = share(more, "links")
    same = copies.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    found = components(links.unionByName(more).unionByName(same))
    return (
        signed.select("doc_id", "n_shingles")
        .join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked documents, that of the smallest id; null ids all stay.

    Rows that share an id are one document, and one of them stays, whatever its other columns hold. Documents without
    words (null, empty or blank texts) link with nothing and stay. An empty table stays empty; long texts are compared
    whole, and columns may have any names.
    """
    found = share(jaccard_join(docs, text).select("doc_id", "component_id"), "classes")
    gone = share(found.filter("doc_id <> component_id").select("doc_id").distinct(), "gone")
    again = share(found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "again")
    stay = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = stay.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return stay.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(repeated)
