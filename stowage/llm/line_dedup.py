"""Boilerplate lines, found by how many sites they are spread over.

Each line hash carries a HyperLogLog sketch of the sites it stands on; sketches are built in the tasks and merged
by the aggregate, so a line that half the corpus shares is a few bytes per task. Lines whose estimate is clear of
the threshold are decided by it; those near it get an exact count of their sites. A boilerplate line stays in the
document with the smallest id that has it and goes from all others. Texts are split and hashed once, into a narrow
stored table that all steps read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stowage.llm.native import let, trimmed
from stowage.llm.words import WORD
from stowage.session import share

LG_K = 12
ERROR = 1.04 / 2 ** (LG_K / 2)  # relative standard error of a sketch


def lines_of(docs: DataFrame, text: str, site: str, min_words: int) -> DataFrame:
    """(doc_id, body, site, place, line): a row per line that counts; body is a hash of the whole text."""
    parts = docs.select(
        F.col("doc_id"), F.xxhash64(docs[text]).alias("body"), F.xxhash64(docs[site]).alias("site"),
        F.posexplode(F.split(docs[text], "\n", -1)).alias("place", "_line"),
    )
    some = trimmed("_line") != "" if min_words <= 1 else F.regexp_count("_line", F.lit(WORD)) >= min_words
    counted = parts.filter(some)
    return counted.select("doc_id", "body", "site", "place", F.xxhash64(trimmed("_line")).alias("line"))


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(line, keeper): lines on at least ``min_sites`` sites and the smallest id of their documents."""
    sketched = share(
        lines.groupBy("line")
        .agg(F.hll_sketch_agg("site", LG_K).alias("_sketch"), F.min("doc_id").alias("keeper"), F.count("*").alias("_n"))
        .filter(F.col("_n") >= min_sites)
        .select("line", "keeper", F.hll_sketch_estimate("_sketch").alias("sites"))
        .filter(F.col("sites") >= min_sites * (1 - 4 * ERROR) - 1),
        "line-sites",
    )
    near = F.col("sites") <= min_sites * (1 + 4 * ERROR) + 1
    exact = (
        lines.select("line", "site")
        .join(sketched.filter(near).select("line"), "line", "left_semi")
        .distinct()
        .groupBy("line")
        .agg(F.count("*").alias("_sites"))
        .filter(F.col("_sites") >= min_sites)
        .select("line")
    )
    sure = sketched.filter(~near).select("line", "keeper")
    return sure.unionByName(sketched.filter(near).join(exact, "line", "left_semi").select("line", "keeper"))


def without(text: Column, places: Column) -> Column:
    """``text`` without the lines at ``places``, in time linear in the number of lines."""
    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
        return F.array_join(F.transform(kept, lambda k: lines[k]), "\n")

    return let(F.split(text, "\n", -1), rest)


def line_dedup(
    docs: DataFrame, min_sites: int = 10, min_words: int = 1, text: str = "text", site: str = "source"
) -> DataFrame:
    """``docs`` with the boilerplate lines cut from ``text``, and ``n_lines`` and ``n_removed`` (long) added.

    Lines are compared without blanks at their ends; every line with ``min_words`` words counts, which is
    every line with a word unless more are asked for. Every
    row stays: a text of boilerplate alone becomes empty, a null text stays null with 0 lines, and rows with a
    null ``doc_id`` never keep a line. A null site counts as one site of its own. Repeated rows are treated alike.
    Columns named like the added ones are replaced; other columns pass through whatever their names.
    """
    lines = share(lines_of(docs, text, site, min_words), "line-hashes")
    spread = share(spread_lines(lines, min_sites), "boilerplate")
    cuts = (
        lines.join(spread, "line")
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "body")
        .agg(F.collect_set("place").alias("places"))
        .select(F.col("doc_id").alias("_doc"), F.col("body").alias("_body"), "places")
    )
    whole = docs.select(F.struct("*").alias("d"), F.xxhash64(docs[text]).alias("body"))
    joined = whole.join(cuts, F.col("d.doc_id").eqNullSafe(F.col("_doc")) & (F.col("body") == F.col("_body")), "left")
    old = F.col("d").getField(text)
    new = F.when(F.col("places").isNull(), old).otherwise(without(old, F.col("places")))
    n_lines = F.when(old.isNull(), 0).otherwise(F.size(F.split(old, "\n", -1))).cast("long")
    n_removed = F.coalesce(F.size("places"), F.lit(0)).cast("long")
    added = {text: new, "n_lines": n_lines, "n_removed": n_removed}
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    kept = [added[text].alias(c) if c == text else F.col("d").getField(c).alias(c) for c in names]
    return joined.select(*kept, n_lines.alias("n_lines"), n_removed.alias("n_removed"))


LINE_DEDUP_SQL = r"""
with lines as (
    select doc_id, source, text, unnest(string_split(text, chr(10))) as line,
           generate_subscripts(string_split(text, chr(10)), 1) as place
    from documents
), counted as (
    select *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body
    from lines
    where len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 1
), spread as (
    select body, min(doc_id) as keeper
    from counted
    group by body
    having count(distinct source) + max(case when source is null then 1 else 0 end) >= 10
), marked as (
    select l.doc_id, l.place, l.line, s.body is not null and l.doc_id is distinct from s.keeper as cut
    from lines l
    left join counted c on l.doc_id = c.doc_id and l.place = c.place
    left join spread s on c.body = s.body
)
select d.doc_id, coalesce(m.n_lines, 0) as n_lines, coalesce(m.n_removed, 0) as n_removed,
       case when d.text is null then null else coalesce(m.kept, '') end as text
from documents d
left join (
    select doc_id, count(*) as n_lines, cast(sum(cast(cut as bigint)) as bigint) as n_removed,
           string_agg(line, chr(10) order by place) filter (where not cut) as kept
    from marked group by doc_id
) m on d.doc_id = m.doc_id
"""
