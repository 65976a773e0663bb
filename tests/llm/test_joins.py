"""Jaccard join and vectors against all pairs."""

import random
import re

import duckdb
import numpy as np
import pytest

from stowage.llm import embedding_dedup, jaccard_join as jj
from stowage.llm.components import components
from stowage.llm.embedding_dedup import near_vectors
from stowage.llm.queries import JACCARD_SQL, VECTORS_SQL, table
from tests.llm.conftest import SF, WORDS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def classes(nodes, links):
    parent = {n: n for n in nodes}
    for a, b in links:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {n: find(parent, n) for n in nodes}


def sets(rows):
    out = {}
    for d, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out[d] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    return out


def brute(rows):
    s = sets([r for r in rows if r[0] is not None])
    ids = sorted(s)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])
    ]
    found = classes(ids, links)
    return {d: (len(s[d]), found[d]) for d in ids}


def by_spark(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_join(docs).collect() if r.doc_id is not None}


def near_rows(seed, groups=25, size=6, hot_group=0):
    """Groups of copies with edits around the threshold, passages that many share, and exact copies."""
    rng, rows, d = random.Random(seed), [], 0
    passage = rng.choices(WORDS, k=40)
    for g in range(groups):
        base = rng.choices(WORDS, k=rng.choice([4, 5, 8, 12, 30, 60, 150, 400]))
        if g % 3 == 0:
            base = base + passage
        for _ in range(hot_group if g == 1 else size):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            if rng.random() < 0.3:
                words = words[: rng.randint(max(1, int(len(words) * 0.75)), len(words))]
            text = rng.choice([" ", "\n", "  "]).join(words)
            rows.append((d, text.upper() if rng.random() < 0.2 else text, "s"))
            d += 1
    rng.shuffle(rows)
    return rows


def test_jaccard_on_near_copies(make):
    rows = near_rows(1)
    assert by_spark(make(rows)) == brute(rows)


@pytest.mark.parametrize("hot", [2, 4])
def test_jaccard_with_hot_keys(make, monkeypatch, hot):
    monkeypatch.setattr(jj, "HOT", hot)
    monkeypatch.setattr(jj, "BLOCK", 7)
    rows = near_rows(2, groups=9, hot_group=60)
    assert by_spark(make(rows)) == brute(rows)


def test_jaccard_on_documents_and_its_sql(spark):
    docs = table(spark, SF, "documents")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    cursor = con.execute(JACCARD_SQL)
    names = [c[0] for c in cursor.description]
    theirs = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in (dict(zip(names, x)) for x in cursor.fetchall())}
    assert by_spark(docs) == theirs


def test_jaccard_of_odd_rows(make, odd_rows):
    found = jj.jaccard_join(make(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == brute(odd_rows)
    assert all(r.component_id is None for r in found if r.doc_id is None)
    assert jj.jaccard_join(make([])).count() == 0


def test_one_of_each_keeps_one_row_of_a_group(make, odd_rows):
    kept = jj.one_of_each(make(odd_rows))
    assert kept.columns == make([]).columns
    want = sorted(d for d, (_, c) in brute(odd_rows).items() if c == d)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in kept.collect()) == 2


def test_levels_leave_enough_parts_for_every_pair():
    for a in range(1, 400):
        for b in range(a, min(2 * a, a * 5 // 4) + 1):
            if (a + b) // 9 == 0:
                continue
            shared = {k for k, _ in jj.levels_of(a)} & {k for k, _ in jj.levels_of(b)}
            level = int(np.searchsorted(jj.REACH, (a + b) // 9))
            assert level in shared
            for n in (a, b):
                sure = dict(jj.levels_of(n))[level]
                assert 0 < sure <= jj.PARTS[level] - (a + b) // 9


def test_parity_distance_is_a_lower_bound():
    rng = np.random.default_rng(0)
    for n in (5, 60, 700):
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: n * 9 // 10], rng.integers(0, 2**63, n // 5, dtype=np.uint64)]))
        p, q = jj.parity(x), jj.parity(y)
        size = min(len(p), len(q))
        assert (jj.folded(p, size) ^ jj.folded(q, size)).sum() <= len(np.setxor1d(x, y))


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = classes({x for e in edges for x in e}, edges)
    assert found == {k: v for k, v in want.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vector_rows(seed, n=60):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for g in range(n):
        base = rng.standard_normal(24)
        for _ in range(1 + g % 4):
            x = base + rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.2, 0.35])
            rows.append((k, [float(v) for v in x]))
            k += 1
    return rows


def brute_vectors(rows):
    good = {k: np.array(v) for k, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = [
        (a, b) for a in good for b in good
        if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.95
    ]
    found = classes([k for k, _ in rows], links)
    return {k: (sum(k in e for e in links), found[k], found[k] == k) for k, _ in rows}


def check_vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = near_vectors(df).collect()
    assert len(found) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == brute_vectors(rows)


def test_vectors_against_all_pairs(spark):
    check_vectors(spark, vector_rows(1))


def test_crowded_cells_and_copies(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "MOST_ROWS", 20)
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    crowd = [(1000 + k, [float(v) for v in base + rng.standard_normal(16) * 0.01]) for k in range(70)]
    copies = [(2000 + k, [1.0, *[0.5] * 15]) for k in range(50)]
    check_vectors(spark, crowd + copies)


def test_odd_vectors(spark):
    rows = [
        (1, None), (2, []), (3, [0.0] * 4), (4, [1.0, None, 0.0, 0.0]), (5, [float("nan"), 1.0, 0.0, 0.0]),
        (6, [float("inf"), 1.0, 0.0, 0.0]), (7, [1.0, 2.0, 0.0, 0.0]), (8, [2.0, 4.0, 0.0, 0.0]), (9, [1.0, 2.0]), (10, [1.0, 2.0, 0.0, 0.0]),
    ]
    check_vectors(spark, rows)
    df = spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert sorted(map(str, near_vectors(df).collect())) == sorted(["Row(vec_id=None, n_links=0, component_id=None, kept=None)", "Row(vec_id=1, n_links=0, component_id=1, kept=True)"])
    assert near_vectors(df.limit(0)).count() == 0


def test_vectors_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    theirs = sorted(con.execute(VECTORS_SQL).fetchall())
    assert sorted(tuple(r) for r in near_vectors(table(spark, SF, "embeddings")).collect()) == theirs


def test_recall_at_the_threshold_holds_at_any_size():
    for n in (10**4, 10**5, 10**6, 5 * 10**6, 10**8):
        cells = round(np.log(n) / -np.log(embedding_dedup.APART))
        tables, count = embedding_dedup.tables_for(cells, 96)
        assert tables >= 96 and count >= 2 and embedding_dedup.recall(tables, cells, count) >= 0.999
    rng = np.random.default_rng(0)
    apart, shift = np.abs(rng.standard_normal((200_000, 3))), rng.random((200_000, 2))
    met = (np.floor(apart[:, :2] / embedding_dedup.CELL + shift) == 0).all(axis=1) & (apart[:, 2] <= embedding_dedup.WINDOW)
    assert abs(met.mean() - embedding_dedup.chance(2)) < 0.005


def test_links_at_the_threshold_survive_many_cells(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "APART", 0.7)  # as many cells as millions of vectors have
    rng = np.random.default_rng(6)
    rows = []
    for k in range(300):
        x, y = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
        rows += [(2 * k, x.tolist()), (2 * k + 1, (0.9501 * x + np.sqrt(1 - 0.9501**2) * y).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sum(r.n_links for r in near_vectors(df).collect()) >= 598
