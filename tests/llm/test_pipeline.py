"""The pipeline, stage by stage, each on what the one before kept."""

import corpus_pipeline
from stowage.llm.jaccard_join import jaccard_join
from stowage.llm.line_dedup import line_dedup
from stowage.llm.queries import table
from stowage.llm.toxicity import toxicity
from stowage.session import share
from tests.llm.conftest import SF
from tests.llm.test_tokens import check_packed


def test_stages_take_effect(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = table(spark, SF, "documents")
    columns = docs.columns
    stages = [f for _, f in corpus_pipeline.STAGES]

    clean = share(stages[0](spark, docs, SF), "clean")
    bad = {r.doc_id for r in toxicity(docs, table(spark, SF, "labels")).collect() if r.predicted}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad

    lines = share(stages[1](spark, clean, SF), "lines")
    want = {r.doc_id: r.text for r in line_dedup(clean).collect()}
    assert lines.columns == columns and {r.doc_id: r.text for r in lines.collect()} == want
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    single = share(stages[2](spark, lines, SF), "single")
    assert single.columns == columns
    assert {r.doc_id for r in single.collect()} == {r.doc_id for r in jaccard_join(lines).collect() if r.doc_id == r.component_id}

    mixed = share(stages[3](spark, single, SF), "mixed")
    words = lambda df: sum(len(r.text.split()) for r in df.collect())
    assert mixed.columns == columns and abs(words(mixed) - 1.5 * words(single)) <= 30

    packed = stages[4](spark, mixed, SF).collect()
    check_packed(packed, [(r.doc_id, r.text) for r in mixed.collect()])


def test_run_gives_packed_pieces(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def test_stages_on_odd_rows_and_on_none(spark, make, odd_rows):
    """Nulls in any column, empty, blank and very long texts, repeated rows, ties, clashing extra columns, no rows."""
    for rows in (odd_rows, []):
        docs = make(rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = share(stage(spark, docs, SF), "odd")
            assert kept.columns == docs.columns and dict(kept.dtypes) == dict(docs.dtypes), name
            docs = kept
        whole = [(r.doc_id, r.text) for r in docs.collect()]
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        if rows:
            check_packed(packed, whole)
        assert bool(packed) == bool(whole) == bool(rows)
