"""Packing of documents into training sequences: first-fit decreasing over a tournament tree.

Each document's ids, with an end id behind them, are cut into pieces of the sequence length; the last piece is
what remains. Full pieces are sequences of their own. The rest is dealt into randomised groups of bounded size,
and each group is packed on its own: pieces by falling length, each into the first sequence with room. The tree
holds the free room of the group's sequences, with the larger room of two children in each inner node, so the
first sequence with room is found by walking down from the root.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stowage.llm.shipping import let_go
from stowage.llm.words import mix
from stowage.session import share

FULL = 1 << 62  # ids of sequences that one full piece fills start here
SPAN = 1 << 32  # sequence ids kept for a group

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ticket long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_LOADED: dict[tuple[str, str], object] = {}


def encoder(ranks_file: str, tokenizer_file: str):
    """Text to ids as the tokenizer of ``tokenizer_file`` gives them, special strings as its default.

    ``ranks_file`` holds the same vocabulary as ranks; its library splits and merges alike on every code point
    (checked once for all of them, and on each load for a probe text; a test compares both on random hostile texts),
    in a quarter of the time. The tokenizer itself is kept only where the probe differs, and is otherwise loaded
    again for a text that the faster library refuses.
    """
    key = (ranks_file, tokenizer_file)
    if key in _LOADED:
        return _LOADED[key]
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer_file)
    kept: list[Tokenizer] = []
    special = {str(a.content): k for k, a in slow.get_added_tokens_decoder().items()}
    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    probe = "It's 12 o'clock,\n\n  über 中文 \U0001f600x" + "".join(special) + "  end "
    same = slow.encode(probe, add_special_tokens=False).ids == fast.encode(probe, allowed_special="all")
    if not same:
        kept.append(slow)
    del slow

    def ids(text: str) -> np.ndarray:
        if same:
            try:
                return fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # runs that are too long for the faster library's pattern engine
                pass
        if not kept:
            kept.append(Tokenizer.from_file(tokenizer_file))
        return np.array(kept[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    _LOADED[key] = ids
    return ids


def token_pieces(
    docs: DataFrame, ranks_file: str, tokenizer_file: str, length: int = 2048, end_id: int = 1, text: str = "text"
) -> DataFrame:
    """Pieces of at most ``length`` ids of every row's whole text. One pass, no shuffle, no ids in the result."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(ranks_file, tokenizer_file)
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for doc_id, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(ids_of(words.as_py() or ""), end_id).astype("<u4")
                seen += 1
                ticket = int(mix(np.array([task << 40 | seen], dtype=np.uint64))[0] >> np.uint64(1))
                raw = ids.tobytes()
                for start in range(0, len(ids), length):
                    part = raw[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), len(ids), ticket))
            columns = list(zip(*rows)) or [()] * 6
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ticket"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
        let_go()

    thin = docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs[text].alias("_text"))
    return thin.mapInArrow(cut, PIECES)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item. The tree's leaves are bins; all begin empty, as many as there are items."""
    n = len(lengths)
    width = 1 << max(n - 1, 0).bit_length()
    room = [capacity] * (2 * width)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[item]), 1
        while node < width:
            node *= 2
            if room[node] < need:
                node += 1
        bins[item], offsets[item] = node - width, capacity - room[node]
        room[node] -= need
        node //= 2
        while node:
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
            node //= 2
    return bins, offsets


def pack_pieces(pieces: DataFrame, length: int = 2048, group_size: int = 20_000) -> DataFrame:
    """``pieces`` (a stored table) with the sequence and the offset of each piece; an empty table gives none.

    A piece's group follows from its random ticket, so groups have about ``group_size`` short pieces whatever
    the documents, also where rows repeat. Equal lengths are taken by ticket, so reruns on the same table agree.
    """
    full = pieces.filter(F.col("length") == length).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.monotonically_increasing_id() + F.lit(FULL)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    short = pieces.filter(F.col("length") < length)
    groups = max(1, -(-short.count() // group_size))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["ticket", "doc_id", "start"], ignore_index=True)
        bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), length)
        rows["sequence_id"] = rows["_group"] * SPAN + bins
        rows["offset"] = offsets
        return rows[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]].astype(
            {"doc_id": "Int64"}
        )

    packed = short.withColumn("_group", F.col("ticket") % groups).groupBy("_group").applyInPandas(pack, PACKED)
    return full.unionByName(packed)


def pack_documents(
    docs: DataFrame, ranks_file: str, tokenizer_file: str, length: int = 2048, end_id: int = 1,
    group_size: int = 20_000, text: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (the document's ids before it), ``length``, ``ids_crc32``,
    ``doc_tokens`` (with the end id), ``sequence_id`` and ``offset``.

    Texts are encoded once; the pieces, some forty bytes each, are stored in the shared folder, which also fixes
    the tickets should an executor be lost. A null or empty text is a document of the end id alone; repeated
    rows are packed as often as they come; a null ``doc_id`` is kept; an empty table gives no rows. Columns other
    than ``doc_id`` and ``text`` are not read.
    """
    pieces = share(token_pieces(docs, ranks_file, tokenizer_file, length, end_id, text), "pieces")
    return pack_pieces(pieces, length, group_size)
