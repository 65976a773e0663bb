"""Token counts against the library, packing against exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stowage.llm.packing import first_fit_decreasing, pack_documents
from stowage.llm.queries import BYTES, PIECES, RANKS, table
from stowage.llm.token_counts import loaded, token_counts
from tests.llm.conftest import SF


def library_counts(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return [len(model.encode(t or "")) for t in texts]


def test_counts_equal_the_library_on_odd_texts(make, odd_rows):
    found = token_counts(make(odd_rows), PIECES).collect()
    want = sorted(
        ((d is None, d or 0, len((t or "").encode()), n) for (d, t, _), n in zip(odd_rows, library_counts([r[1] for r in odd_rows]))),
    )
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in found) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in found)


def test_counts_equal_the_library_on_documents(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r.n_tokens for r in token_counts(docs, PIECES).collect()}
    assert found == dict(zip(rows, library_counts(rows.values())))


def test_counts_of_random_strings():
    rng, tokens = random.Random(1), loaded(PIECES)
    texts = ["".join(rng.choices("ab ▁\n\tthe ing é中<s>0.", k=rng.randint(0, 60))) for _ in range(3000)]
    assert [tokens.count(t) for t in texts] == library_counts(texts)


def test_no_documents(make):
    assert token_counts(make([]), PIECES).count() == 0
    assert pack_documents(make([]), RANKS, BYTES).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_first_fit_decreasing_against_a_plain_scan(seed):
    lengths = np.random.default_rng(seed).integers(1, 101, 300)
    bins, offsets = first_fit_decreasing(lengths, 100)
    room, want = [], {}
    for item in np.argsort(-lengths, kind="stable"):
        at = next((k for k, free in enumerate(room) if free >= lengths[item]), len(room))
        if at == len(room):
            room.append(100)
        want[item] = (at, 100 - room[at])
        room[at] -= lengths[item]
    assert [(b, o) for b, o in zip(bins, offsets)] == [want[k] for k in range(300)]


def check_packed(rows, texts_by_id):
    tokenizer = Tokenizer.from_file(BYTES)
    ids = defaultdict(list)
    for d, t in texts_by_id:
        ids[d].append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for d, own in pieces.items():
        want = sorted(
            (len(x), k, min(2048, len(x) - k), zlib.crc32(x[k : k + 2048].tobytes())) for x in ids[d] for k in range(0, len(x), 2048)
        )
        assert sorted((r.doc_tokens, r.start, r.length, r.ids_crc32) for r in own) == want
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), sum(r.length for r in rows)


def test_packing_round_trip_on_odd_texts(make, odd_rows):
    check_packed(pack_documents(make(odd_rows), RANKS, BYTES).collect(), [(r[0], r[1]) for r in odd_rows])


def test_packing_round_trip_and_fill_on_documents(spark):
    docs = table(spark, SF, "documents")
    n, total = check_packed(pack_documents(docs, RANKS, BYTES).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert total / (n * 2048) > 0.98


def test_small_groups_stay_apart(spark):
    docs = table(spark, SF, "documents")
    rows = pack_documents(docs, RANKS, BYTES, group_size=20).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()])


def test_long_runs_of_one_character():
    from stowage.llm.packing import encoder

    tokenizer = Tokenizer.from_file(BYTES)
    for text in (" " * 30_000 + "x", "\n" * 20_000, "ab" * 20_000):
        assert encoder(RANKS, BYTES)(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
