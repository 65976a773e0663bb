"""Alignment of two tokenizers over the same bytes, by sparse incidence matrices.

Both tokenizers cut the bytes of a text into tokens. Three products of matrices in compressed sparse rows (CSR, built
here, multiplied row by row as Gustavson does) link them:

* token-byte incidence, A . B^T: the entry of two tokens is the number of bytes they share, an overlap link;
* group incidence: byte offsets at which tokens of both end cut a text into groups, and the product of (document and
  A id) by group with group by B id counts the pairs of occurrences that share a group, a shared-group link;
* documents are summed out of the latter by an aggregate: in how many documents a pair of ids is linked.

Texts of a batch lie behind one another in one byte space, so a batch is a single product of each kind.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.llm.shipping import let_go
from stowage.llm.words import chunks
from stowage.session import share

PROBE = "It's 12 o'clock,\n\n  über 中文 \U0001f600x<|endoftext|>  end "
MARK = "▁"  # fixed value: what the second library writes for a space
A_SHIFT = 32  # a pair of ids as one number: the A id above, the B id below
SPREAD = 4_000_000  # terms of a product made at once
HELD = 2_000_000  # pairs of ids a task holds before it hands on their counts
MOST = 4_000_000  # counted pairs that are broadcast, 13 bytes each

ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, "
    "n_pairs long, pairs binary, times binary"
)


class Csr:
    """A sparse matrix of whole numbers: row k has the columns ``indices[indptr[k]:indptr[k + 1]]``."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, data: np.ndarray, n_columns: int):
        self.indptr, self.indices, self.data, self.n_columns = indptr, indices, data, n_columns

    @classmethod
    def from_entries(cls, row: np.ndarray, column: np.ndarray, data: np.ndarray, shape: tuple[int, int]) -> Csr:
        """From entries in any order; equal places are summed."""
        key, data = summed(row.astype(np.int64) * shape[1] + column, data)
        row = key // max(shape[1], 1)
        return cls(np.searchsorted(row, np.arange(shape[0] + 1)), key - row * shape[1], data, shape[1])

    def products(self, other: Csr, most: int = SPREAD) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, column, value) of self . other, rows ascending, some rows at a time.

        Row by row: each entry (i, k) of self brings in row k of other; terms at the same place are added. A
        batch of rows has at most ``most`` terms, unless a single row has more.
        """
        width = np.diff(other.indptr)[self.indices]
        ends = np.concatenate([[0], np.cumsum(width)])
        upto = ends[self.indptr]  # terms before each row
        row, n = 0, len(self.indptr) - 1
        while row < n:
            stop = max(row + 1, int(np.searchsorted(upto, upto[row] + most, side="right")) - 1)
            part = slice(self.indptr[row], self.indptr[stop])
            terms = width[part]
            if terms.sum():
                owner = np.repeat(np.repeat(np.arange(row, stop), np.diff(self.indptr[row : stop + 1])), terms)
                at = np.arange(terms.sum()) + np.repeat(other.indptr[self.indices[part]] - (ends[:-1][part] - ends[part.start]), terms)
                value = np.repeat(self.data[part], terms) * other.data[at]
                key, value = summed(owner * other.n_columns + other.indices[at], value)
                yield key // other.n_columns, key % other.n_columns, value
            row = stop


def summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of each one's values."""
    if not len(key):
        return key, value
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(value, first)


class Tokens:
    """The ids of a text under both tokenizers and the bytes of every id.

    ``ranks_file`` may hold the vocabulary of ``byte_file`` as ranks, for a library that splits and merges alike
    several times as fast. It is used where a probe text comes out the same, and the tokenizer itself for texts that
    it refuses.
    """

    def __init__(self, byte_file: str, piece_file: str, ranks_file: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.fast = _by_ranks(ranks_file) if ranks_file else None
        if self.fast and self.fast.encode_ordinary(PROBE) != self.a.encode(PROBE, add_special_tokens=False).ids:
            self.fast = None
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        letters = _byte_letters()
        named = self.a.get_vocab(with_added_tokens=True)
        added = {k: t.content.encode() for k, t in self.a.get_added_tokens_decoder().items()}
        self.a_bytes = [b""] * (max(named.values()) + 1)
        for name, k in named.items():
            self.a_bytes[k] = added[k] if k in added else bytes(letters[c] for c in name)
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(k) else p.replace(MARK, " ").encode()
            for k, p in ((k, self.b.id_to_piece(k)) for k in range(self.b.get_piece_size()))
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.n_a, self.n_b = len(self.a_bytes), len(self.b_bytes)
        most = max(self.n_a, self.n_b)
        self.decimals = [f"{k}{sign}".encode() for sign in ",|;" for k in range(most)]
        self.most = most

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids per text; none where a text is empty or either side's bytes are not those of space and text."""
        a = [self.byte_ids(f" {t}") for t in texts]
        b = self.b.encode(texts, num_threads=1)
        out = []
        for text, x, y in zip(texts, a, b):
            whole = f" {text}".encode()
            same = text and b"".join(map(self.a_bytes.__getitem__, x)) == whole == b"".join(map(self.b_bytes.__getitem__, y))
            out.append((x, y) if same else ([], []))
        return out


    def byte_ids(self, text: str) -> list[int]:
        if self.fast:
            try:
                return self.fast.encode_ordinary(text)
            except ValueError:  # runs that are too long for the faster library's pattern engine
                pass
        return self.a.encode(text, add_special_tokens=False).ids


def _by_ranks(ranks_file: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


_LOADED: dict[tuple, Tokens] = {}


def loaded(*files: str | None) -> Tokens:
    if files not in _LOADED:
        _LOADED[files] = Tokens(*files)
    return _LOADED[files]


class Aligned:
    """Both tokenizations of some texts in one byte space, and what links them."""

    def __init__(self, tokens: Tokens, texts: list[str]):
        pairs = tokens.encode(texts)
        self.tokens, self.n = tokens, len(texts)
        self.a, self.a_at = _joined([x for x, _ in pairs])
        self.b, self.b_at = _joined([y for _, y in pairs])
        self.a_ends, self.b_ends = np.cumsum(tokens.a_sizes[self.a]), np.cumsum(tokens.b_sizes[self.b])
        self.cuts = np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(self.cuts, self.a_ends), np.searchsorted(self.cuts, self.b_ends)
        ends = np.concatenate([[0], self.a_ends])[self.a_at]  # where each text ends
        self.group_at = np.searchsorted(self.cuts, ends, side="right")

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, bytes shared): the token-byte incidence of A times that of B, transposed."""
        size = int(self.a_ends[-1]) if len(self.a_ends) else 0
        one = np.ones(size, np.int64)
        by_token = Csr(np.concatenate([[0], self.a_ends]), np.arange(size), one, size)
        owner = np.repeat(np.arange(len(self.b)), self.tokens.b_sizes[self.b])
        by_byte = Csr(np.arange(size + 1), owner, one, max(len(self.b), 1))
        return by_token.products(by_byte)

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, A id * 2**32 + B id, pairs of occurrences that share a group), ascending."""
        groups = len(self.cuts)
        text = np.repeat(np.arange(self.n), np.diff(self.a_at))
        named = text * self.tokens.n_a + self.a
        rows, row = np.unique(named, return_inverse=True)
        left = Csr.from_entries(row, self.a_group, np.ones(len(row), np.int64), (len(rows), groups))
        right = Csr.from_entries(self.b_group, self.b, np.ones(len(self.b), np.int64), (groups, self.tokens.n_b))
        for row, b, times in left.products(right):
            yield rows[row] // self.tokens.n_a, (rows[row] % self.tokens.n_a << A_SHIFT) + b, times

    def group_texts(self) -> list[bytes]:
        """Per text its groups as ``a1,a2|b1;a3|b2``, ids in decimals."""
        n, m = len(self.a), len(self.b)
        # A and B tokens in one order: by group, A before B; a token's place is its own plus those of the other side
        a_place = np.arange(n) + np.searchsorted(self.b_group, self.a_group)
        b_place = np.arange(m) + np.searchsorted(self.a_group, self.b_group, side="right")
        ids, group, side = (np.zeros(n + m, np.int64) for _ in range(3))
        ids[a_place], ids[b_place] = self.a, self.b
        group[a_place], group[b_place] = self.a_group, self.b_group
        side[b_place] = 1
        sign = np.zeros(n + m, np.int64)  # a comma, or a bar before the B tokens, or a semicolon before the next group
        sign[:-1] = np.where(group[1:] != group[:-1], 2, side[1:] - side[:-1])
        words = list(map(self.tokens.decimals.__getitem__, (ids + sign * self.tokens.most).tolist()))
        at = self.a_at + self.b_at
        return [b"".join(words[i:j])[:-1] for i, j in zip(at[:-1], at[1:])]


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    flat = np.fromiter((k for x in lists for k in x), np.int64, count=int(at[-1]))
    return flat, at


def _texts(batch: pa.RecordBatch, column: int) -> list[str]:
    return pc.fill_null(batch.column(column), "").to_pylist()


def overlap_links(docs: DataFrame, byte_file: str, piece_file: str, text: str = "text") -> DataFrame:
    """(doc_id, a_at, b_at, a_id, b_id, n_bytes): a row per pair of token occurrences that share bytes, with their
    places in the text's tokens. Texts without tokens have no rows; see ``aligned`` for when that is."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = loaded(byte_file, piece_file)
        for batch in batches:
            for some in chunks(batch, "_text"):
                both = Aligned(tokens, _texts(some, 1))
                for a, b, shared in both.overlaps():
                    doc = np.searchsorted(both.a_at, a, side="right") - 1
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": some.column(0).take(pa.array(doc)), "a_at": a - both.a_at[doc], "b_at": b - both.b_at[doc],
                        "a_id": both.a[a], "b_id": both.b[b], "n_bytes": shared,
                    })

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs[text].alias("_text"))
    return thin.mapInArrow(link, "doc_id long, a_at long, b_at long, a_id long, b_id long, n_bytes long")


def aligned(docs: DataFrame, byte_file: str, piece_file: str, text: str = "text", ranks_file: str | None = None) -> DataFrame:
    """Per row the counts of tokens, groups and links, the hash of its groups, and its linked pairs of ids, packed:
    ``pairs`` are A id * 2**32 + B id and ``times`` the occurrences linked, eight bytes each, ascending by pair.

    A text that is null, empty, or whose tokens don't give back its bytes has no tokens. A text's work depends on it
    alone, but all pairs within a group are links: a long stretch in which the two tokenizers never meet has as many
    as the product of its tokens, counted by distinct ids and never written out by occurrence.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = loaded(byte_file, piece_file, ranks_file)
        for batch in batches:
            for some in chunks(batch, "_text"):
                both = Aligned(tokens, _texts(some, 2))
                n = both.n
                n_overlaps, n_links = np.zeros(n, np.int64), np.zeros(n, np.int64)
                for a, _, _ in both.overlaps():
                    n_overlaps += np.bincount(np.searchsorted(both.a_at, a, side="right") - 1, minlength=n)
                packed: list[list[bytes]] = [[] for _ in range(n)]
                counts: list[list[bytes]] = [[] for _ in range(n)]
                for doc, pair, times in both.group_links():
                    at = np.searchsorted(doc, np.arange(n + 1))
                    for k in np.unique(doc):
                        part = slice(at[k], at[k + 1])
                        n_links[k] += times[part].sum()
                        packed[k].append(pair[part].astype("<i8").tobytes())
                        counts[k].append(times[part].astype("<i8").tobytes())
                texts = both.group_texts()
                pairs = [b"".join(x) for x in packed]
                yield pa.RecordBatch.from_pydict({
                    "row": some.column(0), "doc_id": some.column(1), "n_a": np.diff(both.a_at), "n_b": np.diff(both.b_at),
                    "n_groups": np.diff(both.group_at), "n_links": n_links, "n_overlaps": n_overlaps,
                    "groups_sha256": pa.array([hashlib.sha256(t).hexdigest() if t else "" for t in texts], pa.string()),
                    "n_pairs": pa.array([len(x) // 8 for x in pairs], pa.int64()),
                    "pairs": pa.array(pairs, pa.binary()), "times": pa.array([b"".join(x) for x in counts], pa.binary()),
                })
        let_go()

    thin = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), docs[text].alias("_text"))
    return thin.mapInArrow(align, ALIGNED)


def _longs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The eight-byte numbers of a binary column, and where each row's start, with the end of the last."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, "<i8") if data is not None and at[-1] > at[0] else np.zeros(0, np.int64)
    return raw[at[0] // 8 : at[-1] // 8], (at - at[0]) // 8


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n): in how many rows of ``aligned`` a pair of ids is linked. Tasks count before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, waiting, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
        out = lambda: pa.RecordBatch.from_pydict({"pair": pair, "n": n})
        for batch in batches:
            waiting.append(_longs(batch.column(0))[0].copy())
            size += len(waiting[-1])
            if size > HELD:
                pair, n = _recounted(pair, n, waiting)
                waiting, size = [], 0
                if len(pair) > HELD:
                    yield out()
                    pair, n = pair[:0], n[:0]
        pair, n = _recounted(pair, n, waiting)
        yield out()

    return links.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _recounted(pair: np.ndarray, n: np.ndarray, waiting: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([pair, *waiting])
    return summed(keys, np.concatenate([n, np.ones(len(keys) - len(pair), np.int64)]))


def alignment(
    docs: DataFrame, byte_file: str, piece_file: str, text: str = "text", most: int = MOST, ranks_file: str | None = None
) -> DataFrame:
    """Per row ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256`` and
    ``n_overlaps`` (pairs of token occurrences that share bytes).

    A link is a pair of token occurrences in one group, and its count the number of rows that hold its pair of ids
    linked. ``count_sum`` adds these up; ``n_best`` counts the links whose count is the highest of their A id, ties
    included. A null or empty text, or one whose tokens don't give back its bytes, has zeros and an empty hash.
    Repeated rows are rows of their own and each counts; an empty table gives none; other columns are not read.

    Texts are tokenized once. Of the counted pairs, those linked in the most documents, ``most`` of them or fewer,
    are broadcast; what a row holds of the rarer ones is joined with them. Which way a pair takes changes no result.
    """
    links = share(aligned(docs, byte_file, piece_file, text, ranks_file), "aligned")
    counts = share(pair_counts(links), "pair-counts").withColumn("a", F.shiftright("pair", A_SHIFT))
    tops = counts.groupBy("a").agg(F.max("n").alias("top"))
    table = share(counts.join(tops, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pair-table")
    least = _least_count(table, most)
    found = table.filter(F.col("n") >= least).orderBy("pair").toArrow()
    context = docs.sparkSession.sparkContext
    held = context.broadcast([found.column(k).to_numpy() for k in range(3)])

    def look_up(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Row of the batch, pair, times, whether broadcast, its count and whether it is its A id's highest."""
        known, n, best = held.value
        pair, at = _longs(batch.column("pairs"))
        times, _ = _longs(batch.column("times"))
        where = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
        here = known[where] == pair if len(known) else np.zeros(len(pair), bool)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(at))
        return owner, pair, times, here, np.where(here, n[where] if len(known) else 0, 0), (best[where] if len(known) else here) & here

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, _, times, _, n, best = look_up(batch)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], owner[best], times[best])
            np.add.at(sums[1], owner, times * n)
            kept = batch.select(["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_overlaps"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *map(pa.array, sums)], names=[*kept.schema.names, "n_best", "count_sum"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, pair, times, here, _, _ = look_up(batch)
            away = np.flatnonzero(~here)
            rows = batch.column("row").to_numpy()[owner[away]]
            yield pa.RecordBatch.from_pydict({"row": rows, "pair": pair[away], "times": times[away]})

    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_overlaps", "n_best", "count_sum"]
    kinds = {"groups_sha256": "string"}
    result = links.mapInArrow(score, ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names))
    if least > 1:
        rarely = table.filter(F.col("n") < least)
        away = links.select("row", "pairs", "times").mapInArrow(rare, "row long, pair long, times long").join(rarely, "pair")
        more = away.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
        )
        result = result.join(more, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
        })
    result = share(
        result.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"), "alignment"
    )
    held.destroy()
    return result


def _least_count(table: DataFrame, most: int) -> int:
    """The smallest power of two so that at most ``most`` pairs have that count or more."""
    powers = table.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count("*").alias("k")).collect()
    total = 0
    for r in sorted(powers, key=lambda r: -r["power"]):
        total += r["k"]
        if total > most:
            return 2 ** (r["power"] + 1)
    return 1
