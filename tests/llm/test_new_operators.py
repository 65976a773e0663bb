"""Tokenizer alignment, conversation trie and exact top-k against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stowage.llm import conversation_trie as trie
from stowage.llm import top_k as search
from stowage.llm.alignment import Csr, alignment, overlap_links
from stowage.llm.queries import BYTES, PIECES, RANKS
from stowage.llm.top_k import top_k

# ---- alignment ----


def both_tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer, pre_tokenizers

    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    # the library's own table of letters: the letter of each byte is what it makes of that byte
    letters = {}
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    for k in [*range(0x800), *range(0x800, 0xD800, 64), *range(0xE000, 0x10FFFF, 4096)]:
        letters |= dict(zip(split.pre_tokenize_str(chr(k))[0][0], chr(k).encode()))
    return a, b, letters


def tokens_of(text, a, b, letters):
    """[(id, start, end)] on both sides."""
    if not text:
        return [], []
    whole = f" {text}".encode()
    sides = []
    named = [(k, bytes(letters[c] for c in a.id_to_token(k))) for k in a.encode(f" {text}", add_special_tokens=False).ids]
    pieces = []
    for k in b.encode(text):
        p = b.id_to_piece(k)
        pieces.append((k, bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()))
    for side in (named, pieces):
        at, out = 0, []
        for k, raw in side:
            out.append((k, at, at + len(raw)))
            at += len(raw)
        if b"".join(raw for _, raw in side) != whole:
            return [], []
        sides.append(out)
    return sides


def brute_alignment(rows):
    tools = both_tokenizers()
    found, docs_with = [], Counter()
    for doc_id, text in rows:
        a, b = tokens_of(text, *tools)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append(([k for k, s, e in a if low <= s and e <= cut], [k for k, s, e in b if low <= s and e <= cut]))
            low = cut
        links = [(x, y) for xs, ys in groups for x in xs for y in ys]
        docs_with.update(set(links))
        told = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        overlaps = sum(1 for _, s, e in a for _, t, f in b if max(s, t) < min(e, f))
        found.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(told.encode()).hexdigest() if told else "", overlaps))
    top = defaultdict(int)
    for (x, _), n in docs_with.items():
        top[x] = max(top[x], n)
    return Counter(
        (d, na, nb, ng, len(links), sum(docs_with[p] == top[p[0]] for p in links), sum(docs_with[p] for p in links), sha, overlaps)
        for d, na, nb, ng, links, sha, overlaps in found
    )


SHARP = [
    (20, "naïve café – “quoted” über 12 345,67 €"), (21, "日本語のテキスト 中文 한국어"), (22, "a▁b"), (23, "<|endoftext|> <s></s> <unk> [x]"),
    (24, "a" * 300 + " " * 40 + "\t\t\n\n\n  end  "), (25, "\x00\x01 ​ ﻿"), (26, " lead"), (27, "\U0001f600\U0001f601é ﬁn"),
]


@pytest.mark.parametrize(("most", "ranks"), [(4_000_000, None), (20, RANKS)])
def test_alignment(spark, make, odd_rows, most, ranks):
    rows = [r for r in odd_rows if r[0] not in (6, 7)] + [(d, t, "s") for d, t in SHARP]
    rows += [(40 + k, " ".join(random.Random(k).choices(["the", "tokenizer", "uncommonly", "12", "Straße", "é"], k=30)), "s") for k in range(6)]
    got = alignment(make(rows), BYTES, PIECES, most=most, ranks_file=ranks).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"
    )
    assert Counter(map(tuple, got.collect())) == brute_alignment([r[:2] for r in rows])


def test_ranks_give_the_tokenizers_ids():
    """Hostile texts: the faster library and the tokenizer itself must give the same ids."""
    from stowage.llm.alignment import Tokens
    from stowage.llm.packing import encoder

    tokens, packs, rng = Tokens(BYTES, PIECES, RANKS), encoder(RANKS, BYTES), random.Random(12)
    whole = tokens.a.__class__.from_file(BYTES)
    alphabet = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "\u2028", "\x00", "\x85", "'s", "'LL", "it's", "A", "é", "e\u0301", "ß", "中", "文", "\U0001f600", "\u200d",
                "٣", "Ⅷ", "½", "12", "999", "_", "-", "<|endoftext|>", "<s>", "▁", "the", "THE", "ing", "ـ", "नि", "ก็", "\ufeff", "\U000e0041"]
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 40)))
        assert tokens.fast.encode_ordinary(text) == tokens.a.encode(text, add_special_tokens=False).ids, text
        assert packs(text).tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_alignment_long_and_empty(spark, make, odd_rows):
    got = {r.doc_id: r for r in alignment(make([r for r in odd_rows if r[0] in (6, 7)]), BYTES, PIECES).collect()}
    assert got[6].n_a > 30_000 and got[6].n_links >= got[6].n_groups > 0 and got[7].n_a > 0
    assert alignment(make([]), BYTES, PIECES).count() == 0


def test_overlap_links(spark, make):
    rows = [(1, "uncommonly naïve 中文"), (2, None), (3, "x y")]
    got = Counter(map(tuple, overlap_links(make([(d, t, "s") for d, t in rows]), BYTES, PIECES).collect()))
    tools, want = both_tokenizers(), Counter()
    for doc, text in rows:
        a, b = tokens_of(text, *tools)
        for i, (x, s, e) in enumerate(a):
            for j, (y, t, f) in enumerate(b):
                if max(s, t) < min(e, f):
                    want[(doc, i, j, x, y, min(e, f) - max(s, t))] += 1
    assert got == want


@pytest.mark.parametrize("most", [1, 7, 10_000])
def test_products(most):
    rng = np.random.default_rng(3)
    for _ in range(20):
        n, m, k = rng.integers(1, 12, 3)
        a, b = rng.integers(0, 3, (n, m)) * (rng.random((n, m)) < 0.4), rng.integers(0, 3, (m, k)) * (rng.random((m, k)) < 0.4)
        csr = lambda x: Csr.from_entries(*np.nonzero(x), x[np.nonzero(x)], x.shape)
        out = np.zeros((n, k), int)
        for row, column, value in csr(a).products(csr(b), most):
            out[row, column] += value
        assert (out == a @ b).all()


# ---- trie ----


def brute_trie(rows):
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in turns.items()}
    full = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(own.get(c - c % 100, [])[:h] + mine[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, v in full.items():
        ends[v].append(c)
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


CONVERSATION = "conv_id long, turn long, role string, text string, depth int, n string, kids long, chars string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 5, "c") for r in rows], CONVERSATION)


def check_trie(spark, rows):
    got = trie.conversation_trie(conversations(spark, rows))
    assert Counter(map(tuple, got.collect())) == brute_trie(rows)


def test_trie(spark):
    rng = random.Random(8)
    rows = []
    for c in [*range(0, 40), 100, 101, 102, 205, 1_000_001]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t else "system", f"say {rng.randint(0, 1 + t // 2)} \U0001f600"))
    rows += [(7, None, None, None), (7, None, "user", ""), (8, 3, "user", "tie"), (8, 3, "user", "tie"), (8, 3, "a", "tie")]
    rows += [(None, 1, "user", "no conversation"), (300, 1, "user", "x" * 200_000)]
    rows += [(c, 1, "user", "only") for c in range(400, 420)]  # some of these stay without turns
    check_trie(spark, rows)


def test_trie_long_conversation_and_crowd(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 16)
    monkeypatch.setattr(trie, "PIECE", 64)
    rows = [(0, t, "user", f"t{t}") for t in range(150)]  # a chain, which a hundred others follow for a while
    rows += [(c, t, "user", f"t{t}") for c in range(1, 90) for t in range(c % 9)]
    check_trie(spark, rows)


def test_trie_empty(spark):
    assert trie.conversation_trie(conversations(spark, [])).count() == 0
    check_trie(spark, [(None, 1, "u", "t")])


# ---- top k ----


def brute_top(rows, k):
    good = [(n, i, [int(np.floor(64.0 * x)) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for n, i, q in good:
        if i % 20:
            continue
        found = sorted((-sum(a * b for a, b in zip(q, c)), j) for m, j, c in good if m != n and len(c) == len(q))
        out.update((i, rank + 1, j, -s) for rank, (s, j) in enumerate(found[:k]))
    return out


def check_top(spark, rows, k=20, per_part=None, kind="float"):
    df = spark.createDataFrame([(i, v, 1, "r", 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, rank int, block string, score int")
    got = top_k(df, F.col("vec_id") % 20 == 0, k, per_part=per_part)
    assert Counter(map(tuple, got.collect())) == brute_top([(r.vec_id, r.embedding) for r in df.collect()], k)


@pytest.mark.parametrize("per_part", [None, 64])
def test_top_k(spark, monkeypatch, per_part):
    monkeypatch.setattr(search, "BLOCK", 100 if per_part is None else 40)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 40))
    rows = [(int(i), (centres[i % 12] + 0.2 * rng.normal(size=40)).tolist()) for i in rng.permutation(600)]
    rows += [(700 + i, rows[0][1]) for i in range(150)]  # a crowd of copies, all ties
    rows += [(0, rows[3][1]), (0, rows[3][1]), (40, None), (60, []), (80, [float("nan")] * 40), (100, [None] * 40), (120, [float("inf")] * 40)]
    rows += [(None, rows[0][1]), (140, [0.0] * 40), (160, [1.0] * 3), (-20, [2.0, -1.0, 0.5]), (161, [0.5] * 3)]
    check_top(spark, rows, per_part=per_part)


def test_top_k_large_numbers_and_few_rows(spark):
    check_top(spark, [(0, [3e6, -2e6]), (1, [1e6, 1e6]), (2, [2.5e6, 1.0])], k=2, kind="double")
    check_top(spark, [(0, [4e6] * 3 + [0.1]), (1, [3e6, 2e6, -1e6, 7.7]), (20, [1e6 + 0.3] * 4), (3, [5.0] * 4)], k=3, kind="double")
    check_top(spark, [(20, [0.5, 0.25])])
    check_top(spark, [])
