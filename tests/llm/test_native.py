"""Line dedup against SQL, quality rules against brute force."""

import re
from collections import Counter

import duckdb
import pandas as pd

from stowage.llm.line_dedup import LINE_DEDUP_SQL, line_dedup
from stowage.llm.quality import quality
from stowage.llm.queries import table
from tests.llm.conftest import SF, WORDS

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def by_sql(docs):
    documents = pd.DataFrame([r.asDict() for r in docs.collect()], columns=docs.columns)
    con = duckdb.connect()
    con.register("raw", documents)
    con.execute("create view documents as select cast(doc_id as bigint) as doc_id, text, source from raw")
    return sorted(con.execute(LINE_DEDUP_SQL).fetchall(), key=str)


def by_spark(docs):
    rows = line_dedup(docs).select("doc_id", "n_lines", "n_removed", "text").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_line_dedup_on_documents(spark):
    docs = table(spark, SF, "documents")
    assert by_spark(docs) == by_sql(docs)


def test_line_dedup_rules(make):
    shared, rare = "All rights are reserved here", "only on nine sites it is"
    rows = [(k, f"own line number {k}\n {shared}\t\nshort one\n{rare if k < 9 else 'end of it all'}", f"s{k}") for k in range(12)]
    rows += [(50, shared, None), (51, None, "s1"), (52, "", "s1"), (53, "\n\n", None)]
    docs = make(rows)
    assert by_spark(docs) == by_sql(docs)
    found = {r[0]: r for r in by_spark(docs)}
    assert found[0][2] == 0 and shared in found[0][3]
    assert all(found[k][2] >= 2 and shared not in found[k][3] and "short one" not in found[k][3] for k in range(1, 12))
    assert "short one" in found[0][3] and all(rare in found[k][3] for k in range(9))
    assert rare in found[5][3]
    assert found[50] == (50, 1, 1, "") and found[51] == (51, 0, 0, None) and found[53] == (53, 3, 0, "\n\n")


def test_line_dedup_with_repeats_null_ids_and_clashes(make):
    line = "the very same words on each site"
    rows = [(k, line, f"s{k}") for k in range(15)] + [(3, line, "s3"), (None, line, "s1"), (None, "x", None)]
    docs = make(rows).withColumnRenamed("row", "n_lines").withColumnRenamed("key", "places")
    out = line_dedup(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "line", "a", "places", "n_lines", "n_removed"]
    found = Counter((r.doc_id, r.text) for r in out.collect())
    assert found == Counter({(0, line): 1, (None, ""): 1, (None, "x"): 1, (3, ""): 2, **{(k, ""): 1 for k in range(1, 15) if k != 3}})


def test_line_dedup_of_nothing(make):
    assert line_dedup(make([])).count() == 0


def brute(text):
    text = text or ""
    words = SPLIT.findall(text)
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    covered = {j for k, g in enumerate(grams) if g in often for j in range(k, k + 3)}
    lines = [x for x in text.split("\n") if SPLIT.search(x)]
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def check_quality(docs):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = quality(docs).collect()
    found = sorted(((r.doc_id is None, r.doc_id or 0, *[r[n] for n in names]) for r in rows))
    assert found == sorted(((r.doc_id is None, r.doc_id or 0, *brute(r.text)) for r in docs.collect()))
    assert not any(r.kept and r.base_failed for r in rows)
    return rows


def test_quality_counts_on_documents(spark):
    check_quality(table(spark, SF, "documents"))


def test_quality_counts_on_odd_rows(make, odd_rows):
    more = [(20, "a b c a b c a b c d e", "s"), (21, "x y x y x y", "s"), (22, "l1\nl1\n \nl1\n<b>|", "s"), (23, "a a a", "s"), (24, "a a a a", "s")]
    check_quality(make(odd_rows + more))
    assert quality(make([])).count() == 0


def prose(k, n=120):
    return " ".join(WORDS[(k * 37 + j * 101 + j * j) % 3000] for j in range(n))


def test_thresholds_follow_the_group(make):
    plain = [(k, prose(k), "s") for k in range(80)]
    marked = [(1000 + k, " ".join(w + "#" * (j % 3) for j, w in enumerate(prose(k).split())), "m") for k in range(80)]
    odd = [(5000, " ".join(w + "$$$" for w in prose(3).split()), "s"), (5001, " ".join("x" * 40 + str(j) for j in range(90)), "s")]
    found = {r.doc_id: r.kept for r in quality(make(plain + marked + odd), min_docs=20).collect()}
    assert all(found[k] for k in range(80)) and all(found[1000 + k] for k in range(80))
    assert not found[5000] and not found[5001]


def test_salted_join_gives_the_same(make):
    docs = make([(k, prose(k), None if k % 2 else "s") for k in range(60)])
    one, two = (sorted(map(str, quality(docs, min_docs=5, broadcast_rows=n).collect())) for n in (100_000, 0))
    assert one == two


def test_fences_follow_the_sketches_and_not_a_constant(make):
    """One line of three is a repeat, which is below any fixed quarter once blank lines count."""
    lines = [f"{prose(k, 40)}\n\n\n{prose(k + 1, 40)}\n\n\n{prose(k + 2, 40)}" for k in range(200)]
    docs = [(k, t, "s") for k, t in enumerate(lines)] + [(900, f"{prose(3, 80)}\n\n\nsee below\n\n\nsee below", "s")]
    found = {r.doc_id: r for r in quality(make(docs), min_docs=20).collect()}
    assert found[900].dup_line_share == 1 / 3 and not found[900].kept
    assert all(found[k].kept for k in range(200))


def test_small_groups_are_drawn_towards_the_wider_one(make):
    signs = lambda k, step: " ".join(w + "#" * (j % step == 0) for j, w in enumerate(prose(k).split()))
    docs = [(k, prose(k), "s") for k in range(300)] + [(1000 + k, signs(k, 4), "m") for k in range(30)]
    few, own = ({r.doc_id: r.kept for r in quality(make(docs), min_docs=n).collect()} for n in (3000, 30))
    assert all(own.values())
    assert all(few[k] for k in range(300)) and not any(few[1000 + k] for k in range(30))


def test_single_occurrences_are_no_evidence(make):
    """Groups in which hardly a document has any of a trait: its quantiles and its spread are zero."""
    import random

    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(10**9)}x" for _ in range(n))
    rows = [(k, text(200) + (" &" if k < 50 else ""), "s") for k in range(1000)]
    rows += [(2000 + k, "\n".join([*(text(8) for _ in range(59)), "w1 w2 w3 w4"] if k >= 25 else [*["once more this line"] * 2, *(text(8) for _ in range(58))]), "t") for k in range(300)]
    rows += [(9000, text(100) + " & | $ #" * 30, "s"), (9001, "\n".join([*["one line again and again"] * 20, *(text(8) for _ in range(40))]), "t")]
    kept = {r.doc_id: r.kept for r in quality(make(rows)).collect()}
    assert not kept.pop(9000) and not kept.pop(9001)
    assert all(kept.values())
