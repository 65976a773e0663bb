"""Log-probabilities of texts under a bigram model held in a log-frequency Bloom filter.

Counts of words and of the words that follow each are gathered from the training documents as packed arrays, one shard
per range of word hashes. A pair's count is quantised to a level on a logarithmic scale, and the pair is put into the shard's
Bloom filter once for each level up to its own: a reader probes level 1, 2, ... until one is missing. The filter
grows with the number of distinct pairs, at a fixed number of bits for each. With a table of word counts it is
broadcast, after a check of its size; beyond the bound the same quantised counts are joined instead.

Probabilities are smoothed as Witten and Bell do,

    P(w | h) = (q(h, w) + t(h) P1(w)) / (Q(h) + t(h)),    P1(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)),

where q is a pair's quantised count, Q(h) the sum of q over the words that follow h, and t(h) how many different ones
do. All pairs of h are in h's shard, so both are sums within it, and the probabilities after a word, with that of
all unknown words as one, add up to 1 but for the filter's false finds. Single words keep exact counts, in a table
beside the filter; the order is two. A document begins after an end token and closes with one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stowage.llm.shipping import let_go
from stowage.llm.words import chunks, mix, mix_int, word_hashes
from stowage.session import share

END = np.uint64(mix_int(0x0E4D))
BASE = 1.5  # of the quantisation
BITS = 14  # of the filter for each entry
PROBES = 10  # with these bits, one pair in 800 that was never put in is found
LEVELS = 60  # 1.5 ** 59 is beyond any count
SEVERAL = 4  # levels of a pair that a worker keeps once it has found it
KEPT = 1 << 18  # such pairs, of 9 bytes each
HELD = 1_000_000  # tokens a task gathers before it sums them
SHARD_BYTES = 8 << 20  # text bytes for each shard
CHUNK_BYTES = 8 << 20  # text bytes of the documents that ask the shards together
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_LEVEL = np.uint64(0x165667B19E3779F9)


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, the token before each, and where rows begin; every row closes with the end token."""
    words, bounds = word_hashes(column)
    tokens = np.insert(words, bounds[1:], END)
    starts = bounds + np.arange(len(bounds))
    before = np.concatenate([[END], tokens[:-1]]).astype(np.uint64)
    return tokens, before, starts


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * _PAIR + word)


def level_of(count: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(count) / np.log(BASE) + 1e-9).astype(np.int64)


# What a level stands for: the least count in it.
COUNT = np.ceil(BASE ** np.arange(LEVELS + 1, dtype=np.float64) / BASE - 1e-9)
COUNT[0] = 0


def places(keys: np.ndarray, level: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """The filter's bit places of (key, level), one probe after the other."""
    a = mix(keys + level.astype(np.uint64) * _LEVEL)
    b = mix(a ^ _PAIR) | np.uint64(1)
    for k in range(PROBES):
        yield (a + np.uint64(k) * b) % size


def gathered(docs: DataFrame, bits: int) -> DataFrame:
    """(shard, words, counts, pairs, after, times): sums over many training documents, packed.

    ``words`` are sorted, ``pairs`` says how many following words each has, ``after`` and ``times`` list them.
    """

    def flush(heads: list[np.ndarray], nexts: list[np.ndarray]) -> pa.RecordBatch:
        w, h = np.concatenate(heads), np.concatenate(nexts)
        order = np.lexsort((h, w))
        w, h = w[order], h[order]
        first = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (h[1:] != h[:-1])]))
        times = np.diff(np.append(first, len(w))).astype(np.uint32)
        w, h = w[first], h[first]
        word_at = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        words, pairs = w[word_at], np.diff(np.append(word_at, len(w))).astype(np.uint32)
        counts = np.add.reduceat(times.astype(np.uint64), word_at)
        shard = (words >> np.uint64(64 - bits)).astype(np.int64)
        found, at = np.unique(shard, return_index=True)
        stop = np.append(at[1:], len(words))
        ends = np.append(word_at, len(w))
        rows = {"shard": found, "words": [], "counts": [], "pairs": [], "after": [], "times": []}
        for i, j in zip(at, stop):
            rows["words"].append(words[i:j].tobytes())
            rows["counts"].append(counts[i:j].tobytes())
            rows["pairs"].append(pairs[i:j].tobytes())
            rows["after"].append(h[ends[i] : ends[j]].tobytes())
            rows["times"].append(times[ends[i] : ends[j]].tobytes())
        return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64() if k == "shard" else pa.binary()) for k, v in rows.items()})

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, nexts, held = [], [], 0
        for batch in batches:
            for part in chunks(batch, "_text"):
                words, before, starts = sequences(part.column(0))
                before[starts[:-1]] = END
                heads.append(before)
                nexts.append(words)
                held += len(words)
                if held >= HELD:
                    yield flush(heads, nexts)
                    heads, nexts, held = [], [], 0
        if held:
            yield flush(heads, nexts)
        let_go()

    return docs.mapInArrow(gather, "shard long, words binary, counts binary, pairs binary, after binary, times binary")


MODEL = "shard long, words binary, counts binary, left binary, mass binary, size long, filter binary, entries long"


def summed(group: pd.DataFrame) -> pd.DataFrame:
    """One shard of the model: its words with their counts, how many words follow each (``left``) and the sum of the
    quantised counts of these pairs (``mass``), and the filter of the pairs."""
    def read(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(group[name]), dtype=kind)

    raw = read("words", "u8")
    words, which = np.unique(raw, return_inverse=True)
    counts = np.zeros(len(words), dtype=np.uint64)
    np.add.at(counts, which, read("counts", "u8"))
    of = np.repeat(which, read("pairs", "u4"))
    after, times = read("after", "u8"), read("times", "u4")
    order = np.lexsort((after, of))
    of, after, times = of[order], after[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (after[1:] != after[:-1])]))
    times = np.add.reduceat(times.astype(np.uint64), first)
    of, after = of[first], after[first]
    left = np.bincount(of, minlength=len(words)).astype(np.uint64)
    keys, level = pair_key(words[of], after), level_of(times)
    mass = np.bincount(of, weights=COUNT[level], minlength=len(words)).astype(np.uint64)
    entries = int(level.sum())
    size = max(64, -(-entries * BITS // 8) * 8)
    bits = np.zeros(size, dtype=np.uint8)
    for k in range(1, int(level.max()) + 1):
        some = keys[level >= k]
        for at in places(some, np.full(len(some), k), np.uint64(size)):
            bits[at.astype(np.int64)] = 1
    row = (group["shard"].iloc[0], words.tobytes(), counts.tobytes(), left.tobytes(), mass.tobytes(), size, np.packbits(bits).tobytes(), entries)
    return pd.DataFrame([row], columns=["shard", "words", "counts", "left", "mass", "size", "filter", "entries"])


class Model:
    """The broadcast form of the shards: sorted words, their counts, and one filter behind the other.

    It travels as the shards' own pieces, so that the driver holds one copy; a worker joins them when it first looks.
    """

    def __init__(self, rows, bits: int):
        self.bits, self.pieces, self.n, self.v, self.open = bits, [], 0.0, 0, False
        for r in rows:
            counts, left, mass = (np.frombuffer(r[c], "u8") for c in ("counts", "left", "mass"))
            narrow = "u4" if not len(counts) or counts.max() < 1 << 32 else "u8"  # a mass is no more than its count
            self.pieces.append((r["shard"], r["size"], bytes(r["words"]), counts.astype(narrow), left.astype("u4"), mass.astype(narrow), bytes(r["filter"])))
            self.n += float(counts.sum())
            self.v += len(counts)
        self.pieces.sort(key=lambda x: x[0], reverse=True)

    def ready(self) -> Model:
        if self.open:
            return self
        self.seen, self.seen_level = np.empty(0, "u8"), np.empty(0, "i1")
        wide = max((x[3].dtype for x in self.pieces), default=np.dtype("u4"))
        self.words, self.counts, self.mass = np.empty(self.v, "u8"), np.empty(self.v, wide), np.empty(self.v, wide)
        self.left, self.filter = np.empty(self.v, "u4"), np.empty(sum(len(x[6]) for x in self.pieces), "u1")
        self.sizes, self.begins = np.ones(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.uint64)
        at = bit = 0
        while self.pieces:  # each piece goes as soon as it is copied
            shard, size, words, counts, left, mass, bits = self.pieces.pop()
            stop = at + len(counts)
            self.words[at:stop], self.counts[at:stop], self.left[at:stop] = np.frombuffer(words, "u8"), counts, left
            self.mass[at:stop] = mass
            self.filter[bit // 8 : (bit + size) // 8] = np.frombuffer(bits, "u1")
            self.sizes[shard], self.begins[shard] = size, bit
            at, bit = stop, bit + size
        self.open = True
        return self

    def find(self, words: np.ndarray) -> list[np.ndarray]:
        """Count, number of following words, and mass of each word."""
        if not self.v:
            return [np.zeros(len(words))] * 3
        at = np.minimum(np.searchsorted(self.words, words), self.v - 1)
        known = self.words[at] == words
        return [np.where(known, x[at], 0).astype(float) for x in (self.counts, self.left, self.mass)]

    def level(self, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The quantised count of each pair, by probing level after level until one is missing.

        A pair is probed once, however often it is asked for. Pairs of several levels take the most probes and come back
        in most texts, so their levels are kept for later calls, up to ``KEPT`` pairs.
        """
        keys, at, which = np.unique(pair_key(before, words), return_index=True, return_inverse=True)
        return self.levels(keys, (before[at] >> np.uint64(64 - self.bits)).astype(np.int64))[which]

    def levels(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """``level`` of different pairs, by their sorted keys and the shards they are in."""
        out = np.zeros(len(keys), np.int64)
        place = np.searchsorted(self.seen, keys)
        found = self.seen.take(place, mode="clip") == keys if len(self.seen) else np.zeros(len(keys), bool)
        out[found] = self.seen_level[place[found]]
        todo = asked = np.flatnonzero(~found)
        left = keys[todo]
        size, begin = self.sizes[shard[todo]], self.begins[shard[todo]]
        step = np.arange(LEVELS + 1, dtype=np.uint64) * _LEVEL
        for k in range(1, LEVELS + 1):
            a = mix(left + step[k])
            b = mix(a ^ _PAIR) | np.uint64(1)
            alive, s, first = np.arange(len(todo)), size, begin
            for j in range(PROBES):
                bit = (a + np.uint64(j) * b) % s + first
                byte = self.filter.take((bit >> np.uint64(3)).view(np.int64))
                hit = ((byte >> (~bit.astype(np.uint8) & np.uint8(7))) & np.uint8(1)).view(bool)
                if not hit.all():
                    alive, a, b, s, first = (x[hit] for x in (alive, a, b, s, first))
            if len(alive) < len(todo):
                todo, left, size, begin = (x[alive] for x in (todo, left, size, begin))
            if not len(todo):
                break
            out[todo] = k
        new = asked[out[asked] >= SEVERAL][: KEPT - len(self.seen)]
        if len(new):
            to = place[new]
            self.seen, self.seen_level = np.insert(self.seen, to, keys[new]), np.insert(self.seen_level, to, out[new].astype(np.int8))
        return out

    def score(self, column: pa.Array) -> list[np.ndarray]:
        """Tokens, known tokens, base score and model score of each row."""
        tokens, before, starts = sequences(column)
        unique, which = np.unique(tokens, return_inverse=True)
        count, left, mass = self.find(unique)
        own = np.log10((count + 0.1) / (self.n + 0.1 * (self.v + 1)))[which]
        count, left, mass = count[which], left[which], mass[which]
        head = np.searchsorted(unique, END)  # every row has an end token
        first_of = np.flatnonzero(which == head)
        ahead = lambda x: np.concatenate([x[first_of[:1]], x[:-1]])
        mass_before, t_before = ahead(mass), ahead(left)
        pair = np.zeros(len(tokens))
        some = np.flatnonzero((count > 0) & (mass_before > 0))
        pair[some] = COUNT[self.level(before[some], tokens[some])]
        return rated(starts, count, own, pair, mass_before, t_before)


def rated(starts: np.ndarray, count: np.ndarray, own: np.ndarray, pair: np.ndarray, mass_before: np.ndarray, t_before: np.ndarray) -> list[np.ndarray]:
    """Tokens, known tokens, base score and model score of each row, from its tokens' figures."""
    weight = np.maximum(t_before, 1.0)
    total = np.log10((pair + weight * 10.0**own) / (mass_before + weight))
    sums = lambda x: np.add.reduceat(x, starts[:-1])
    return [np.diff(starts), sums((count > 0).astype(np.int64)), sums(own), sums(total)]


SCORED_NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "entries"]
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, entries long"


def score_texts(
    docs: DataFrame, folds: int = 10, held_fold: int = 0, max_broadcast_mb: int = 256, text: str = "text"
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (the word
    counts alone), ``score`` (log10 probability of the whole text) and ``entries`` (in the filter).

    The model learns from all rows outside ``held_fold`` and grows with them. A null text counts as empty, which is
    one end token; a null id counts as an empty text when folds are dealt; repeated rows count and are scored as
    often as they come; without training rows every token is unknown. An empty table gives none. Other columns
    are not read.

    Every Python worker unpacks the broadcast model, so ``max_broadcast_mb`` is to be chosen so that this many fit
    beside the executor's heap. A larger model is not sent: its scores are joined (``_scored_by_join``).
    """
    spark = docs.sparkSession
    thin = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold_of(F.col("doc_id"), folds) == held_fold).alias("held_out"), docs[text].alias("_text"),
    )
    train = thin.filter(~F.col("held_out")).select("_text")
    size = train.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    bits = max(2, (int(size) // SHARD_BYTES).bit_length())
    model = share(gathered(train, bits).groupBy("shard").applyInPandas(summed, MODEL), "language-model")
    parts = ["words", "counts", "left", "mass", "filter"]
    need = model.agg(*[F.coalesce(F.sum(F.octet_length(p)), F.lit(0)).alias(p) for p in parts], F.coalesce(F.sum("entries"), F.lit(0)).alias("n")).first()
    if sum(need[p] for p in parts) > max_broadcast_mb << 20:
        return _scored_by_join(thin, model, bits, need["n"])
    shared = spark.sparkContext.broadcast(Model(model.toLocalIterator(), bits))
    entries = int(need["n"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm = shared.value.ready()
        for batch in batches:
            for part in chunks(batch, "_text"):
                n, known, base, total = lm.score(part.column(2))
                rows = len(n)
                columns = [part.column(0), part.column(1), n, known, np.full(rows, int(lm.n)), base, total, np.full(rows, entries)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=SCORED_NAMES)
        let_go()

    return thin.mapInArrow(score, SCORED)


ASKED = "chunk long, shard long, words binary, pairs binary"
TOLD = "chunk long, shard long, counts binary, left binary, mass binary, levels binary"


class Asked:
    """What the texts of a column ask for: their different words, and their different pairs by first and second word.

    Both are sorted, so that the words and pairs of a shard stand together, and the same texts in another order ask
    for the same. ``word_at`` and ``pair_at`` say which of them each token is.
    """

    def __init__(self, column: pa.Array, bits: int):
        self.tokens, before, self.starts = sequences(column)
        self.words, self.word_at = np.unique(self.tokens, return_inverse=True)
        order = np.lexsort((self.tokens, before))
        h, w = before[order], self.tokens[order]
        first = np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])])
        self.pair_at = np.empty(len(order), np.int64)
        self.pair_at[order] = np.cumsum(first) - 1
        self.pairs = pair_key(h[first], w[first])
        shift = np.uint64(64 - bits)
        self.shard_of_words, self.shard_of_pairs = ((x >> shift).astype(np.int64) for x in (self.words, h[first]))

    def of(self, shard: int) -> tuple[slice, slice]:
        """Where a shard's words and pairs stand."""
        return tuple(slice(*np.searchsorted(x, [shard, shard + 1])) for x in (self.shard_of_words, self.shard_of_pairs))


def _scored_by_join(thin: DataFrame, model: DataFrame, bits: int, entries: int) -> DataFrame:
    """The same scores from joins: for models beyond the broadcast bound.

    Documents are dealt into chunks by a hash of id and text. A chunk asks each shard once for its different words and
    pairs, as packed arrays; the shard answers with counts, sums and a byte for each pair; and the chunk meets its
    answers and scores its texts. So a text is shuffled twice and a pair once per chunk, however often it comes, and no
    row of a token is ever made.
    """
    stats = model.selectExpr("octet_length(words) / 8 as v", "counts")

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"n": [float(sum(np.frombuffer(c, "u8").sum() for c in b["counts"]))], "v": [int(b["v"].sum())]})

    n, v = stats.mapInPandas(totals, "n double, v long").agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    size = thin.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    dealt = thin.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "_text"), F.lit(1 + int(size) // CHUNK_BYTES)))

    def binary(rows: list[np.ndarray]) -> pa.Array:
        return pa.array([x.tobytes() for x in rows], pa.binary())

    def ask(docs: pa.Table) -> pa.Table:
        of = Asked(docs["_text"].combine_chunks(), bits)
        shards = np.union1d(of.shard_of_words, of.shard_of_pairs)
        words, pairs = zip(*map(of.of, shards))
        return pa.table({
            "chunk": pa.array([docs["chunk"][0].as_py()] * len(shards), pa.int64()), "shard": pa.array(shards, pa.int64()),
            "words": binary([of.words[x] for x in words]), "pairs": binary([of.pairs[x] for x in pairs]),
        })

    def tell(asked: pa.Table, shards: pa.Table) -> pa.Table:
        if not (asked.num_rows and shards.num_rows):
            return pa.table({c: pa.array([], pa.int64() if c in ("chunk", "shard") else pa.binary()) for c in ("chunk", "shard", "counts", "left", "mass", "levels")})
        lm = Model(shards.to_pylist(), bits).ready()
        words, pairs = ([np.frombuffer(x, "u8") for x in asked[c].to_pylist()] for c in ("words", "pairs"))
        count, left, mass = lm.find(np.concatenate(words))
        keys, which = np.unique(np.concatenate(pairs), return_inverse=True)
        level = lm.levels(keys, np.full(len(keys), shards["shard"][0].as_py()))[which]
        words_end, pairs_end = (np.cumsum([len(x) for x in some])[:-1] for some in (words, pairs))
        answers = {"counts": np.split(count.astype("u8"), words_end), "left": np.split(left.astype("u4"), words_end),
                   "mass": np.split(mass.astype("u8"), words_end), "levels": np.split(level.astype("i1"), pairs_end)}
        return pa.table({"chunk": asked["chunk"], "shard": asked["shard"]} | {c: binary(x) for c, x in answers.items()})

    def score(docs: pa.Table, told: pa.Table) -> pa.Table:
        of = Asked(docs["_text"].combine_chunks(), bits)
        count, left, mass = (np.zeros(len(of.words)) for _ in range(3))
        level = np.zeros(len(of.pairs), np.int64)
        for r in told.to_pylist():
            words, pairs = of.of(r["shard"])
            count[words], left[words], mass[words] = (np.frombuffer(r[c], k) for c, k in (("counts", "u8"), ("left", "u4"), ("mass", "u8")))
            level[pairs] = np.frombuffer(r["levels"], "i1")
        own = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))[of.word_at]
        before = np.concatenate([of.word_at[-1:], of.word_at[:-1]])  # every row closes with an end token, also the last
        mass_before, t_before, known = mass[before], left[before], count[of.word_at]
        pair = np.where((known > 0) & (mass_before > 0), COUNT[level[of.pair_at]], 0.0)
        rows = len(of.starts) - 1
        columns = [docs["doc_id"], docs["held_out"], *map(pa.array, rated(of.starts, known, own, pair, mass_before, t_before))]
        columns[4:4] = [pa.array(np.full(rows, int(n)))]
        return pa.table(dict(zip(SCORED_NAMES, [*columns, pa.array(np.full(rows, int(entries)))])))

    asked = dealt.groupBy("chunk").applyInArrow(ask, ASKED)
    told = share(asked.groupBy("shard").cogroup(model.groupBy("shard")).applyInArrow(tell, TOLD), "pair-counts")
    return dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(score, SCORED)
