"""The mix against its targets, and its parts against brute force."""

import re
from collections import defaultdict

import numpy as np
import pytest

from stowage.llm import mixing
from stowage.llm.mixing import mix_sources, mixed_documents, permute, recipe, taken_words, word_slice
from stowage.llm.queries import table
from tests.llm.conftest import SF

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def water_filling(sizes, total):
    """Targets by lowering a common level until all words are placed."""
    weights = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(2 * s, mid * w) for s, w in zip(sizes, weights)) < total else (low, mid)
    return [min(2 * s, high * w) for s, w in zip(sizes, weights)]


def recipe_of(spark, sizes):
    sums = spark.createDataFrame([(f"{source}", source, size) for source, size in sizes], "stream string, source string, size long")
    return recipe(sums).orderBy("source_id").collect()


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 1000, 5, 700, 0, 3], [1], [5000, 1, 1, 1, 1, 1, 9000]])
def test_targets(spark, sizes):
    found = recipe_of(spark, [(chr(97 + k), size) for k, size in enumerate(sizes)])
    assert [r.source_size for r in found] == sizes
    assert np.allclose([r.target for r in found], water_filling(sizes, 1.5 * sum(sizes)), rtol=1e-9, atol=1e-6)
    for r in found:
        assert r.passes * r.source_size + r.extra == min(round(r.target), 2 * r.source_size)
        assert r.quota == r.passes * r.n_blocks + -(-r.extra // r.block_words)


def test_targets_of_many_sources(spark):
    sizes = [int(x) for x in np.random.default_rng(5).pareto(1.1, 5000) * 20]
    found = recipe_of(spark, [(f"{k:06d}", size) for k, size in enumerate(sizes)])
    assert [r.source_id for r in found] == list(range(5000)) and [r.source_size for r in found] == sizes
    assert np.allclose([r.target for r in found], water_filling(sizes, 1.5 * sum(sizes)), rtol=1e-9, atol=1e-6)


def test_sources_go_by_code_point_and_null_is_last(spark):
    found = recipe_of(spark, [(None, 10), ("", 10), ("\U0001f600", 10), ("B", 10), ("a", 10), ("\ue000", 0)])
    assert [r.stream for r in found] == ["", "B", "a", "\ue000", "\U0001f600", "None"]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permute_is_a_permutation(n):
    found = permute(np.arange(n), n, 12345)
    assert sorted(found) == list(range(n))


def test_quotas_reach_the_leaves():
    quota = np.array([500, 20, 0, 3000])
    leaves = list(mixing.descend(1, 13, 0, quota, np.zeros(4, np.int64), 3, 1))
    assert sorted(x[2] for x in leaves) == list(range(13))
    assert (sum(x[3] for x in leaves) == quota).all()
    sizes = [x[3].sum() for x in leaves]
    assert max(sizes) - min(sizes) <= 4
    at = np.zeros(4, np.int64)
    for leaf in sorted(leaves, key=lambda x: x[2]):
        assert (leaf[4] == at).all()
        at = at + leaf[3]


def test_decks_deal_the_whole_quota(monkeypatch):
    monkeypatch.setattr(mixing, "DECK", 50)
    quota = np.array([500, 20, 0, 3000, 1])
    for count in (0, 1, 1500, 1760, 3521):
        got = mixing.deal(np.random.default_rng(count), quota, count)
        assert got.sum() == count and (got <= quota).all() and (got >= 0).all()


def check(spark, docs, monkeypatch=None):
    rows, mixture = mix_sources(docs)
    taken = taken_words(rows, mixture).collect()
    texts = docs.collect()
    assert len(taken) == len(texts)
    sizes = defaultdict(int)
    for r in texts:
        sizes[r.source] += len(SPLIT.findall(r.text or ""))
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    targets = dict(zip(order, water_filling([sizes[s] for s in order], 1.5 * sum(sizes.values()))))
    by_size = defaultdict(int)
    for r in taken:
        assert 0 <= r.taken <= 2 * r.size
        by_size[r.source_size, round(r.target, 3)] += r.taken
    for source in order:
        assert any(abs(k[1] - targets[source]) < 0.01 for k in by_size)
    for (size, target), got in by_size.items():
        same = sum(1 for s in order if sizes[s] == size and abs(targets[s] - target) < 0.01)
        assert abs(got - same * target) <= same * 1.0 + 1e-6
    again = taken_words(*mix_sources(docs)).collect()
    assert sorted(map(str, again)) == sorted(map(str, taken))
    return mixture


def test_mix_meets_targets_on_documents(spark):
    check(spark, table(spark, SF, "documents"))


def test_mix_of_odd_rows(spark, make, odd_rows):
    check(spark, make(odd_rows))


def test_no_rows(make):
    rows, mixture = mix_sources(make([]))
    assert taken_words(rows, mixture).count() == 0 and mixed_documents(make([])).count() == 0


def test_many_shards_place_every_block_once(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 5)
    monkeypatch.setattr(mixing, "SUBTREE", 4)
    mixture = check(spark, table(spark, SF, "documents"))
    places = mixture.select("shard", "place").distinct()
    assert places.count() >= places.select("shard").distinct().count() > 100


def test_groups_of_sources_share_the_shards(spark, make, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_BLOCKS", 20)
    monkeypatch.setattr(mixing, "GROUP", 3)
    words = np.random.default_rng(9).integers(0, 60, 400)
    mixture = check(spark, make([(k, "w " * int(n), f"source {k % 10}") for k, n in enumerate(words)]))
    sizes = [r["count"] for r in mixture.select("shard", "place").distinct().groupBy("shard").count().collect()]
    assert len(sizes) > 10 and max(sizes) <= 20 + 8


def test_mixed_documents_hold_the_taken_words(spark, make, odd_rows):
    docs = make(odd_rows)
    rows, mixture = mix_sources(docs)
    want = defaultdict(int)
    for r in taken_words(rows, mixture).collect():
        want[r.doc_id] += r.taken
    mixed = mixed_documents(docs)
    assert mixed.schema == docs.schema
    found = defaultdict(int)
    whole = {(d, t) for d, t, _ in odd_rows}
    for r in mixed.collect():
        found[r.doc_id] += len(SPLIT.findall(r.text))
        assert r.n_chars == len(r.text)
        assert any(d == r.doc_id and r.text in (t or "") for d, t in whole)
    assert {k: v for k, v in found.items() if v} == {k: v for k, v in want.items() if v}


def test_word_slice():
    text = "  a b\n\nc  d "
    assert word_slice(text, 1, 2) == "b\n\nc" and word_slice(text, 0, 4) == "a b\n\nc  d"
