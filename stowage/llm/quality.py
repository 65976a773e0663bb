"""Quality rules whose thresholds come from the data: quantile sketches per language and source.

Every document gets its counts in one pass over the text. KLL sketches of its ratios are built per language and
source; as they can be merged, those of a language and of the whole corpus are made from them without reading a
document again. A fence is an upper quantile of a group and a multiple of the group's own spread beyond it, so it
is never a constant. A document is kept when each ratio lies inside the fences of its group, which are drawn towards
those of its language, and these towards the corpus, the fewer documents there are to tell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stowage.llm.native import let, trimmed, words_of
from stowage.session import share

SYMBOLS = "[#*$%&|<>]"  # fixed value
SKETCH_K = 800
# Per ratio: the quantile a fence starts from. Text full of signs can be a twelfth of a corpus, so those start lower.
FENCES = {"symbol_share": 0.9, "dup_line_share": 0.99, "repeat_share": 0.99, "word_length": 0.9}
# How many times the way from the median to the 0.9 quantile a fence stands beyond it: in a normal distribution, where
# that way is 1.28 standard deviations, 3.8 of them beyond the quantile.
SPREADS = 3.0
TWO_SIDED = ["word_length"]
# Per share: its count, what it is a share of, and the words or lines that one occurrence counts for at least (a
# repeated window of three words stands in two places).
SHARES = {
    "symbol_share": ("n_symbols", "word_chars", 1), "dup_line_share": ("n_dup_lines", "n_lines", 1),
    "repeat_share": ("n_repeat_words", "n_words", 6),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SALTS = 32
WORD_LINE = r"[^\x20\x09-\x0D][^\n]*"  # matches once in each line that holds a word


def repeat_words(hashes: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, from the hashes of a text's words in order.

    Windows are sorted with their places; equal neighbours are repeats. Each repeated window adds the words up
    to the next one, three at most.
    """
    none = F.lit(0).cast("long")

    def covered(places: Column) -> Column:
        n = F.size(places)
        gaps = F.zip_with(F.slice(places, 1, n - 1), F.slice(places, 2, n - 1), lambda a, b: F.least(b - a, F.lit(3)))
        return F.aggregate(gaps, F.lit(3), lambda total, gap: total + gap).cast("long")

    def repeated(pairs: Column) -> Column:
        n = F.size(pairs)
        twins = F.zip_with(
            F.slice(pairs, 1, n - 1), F.slice(pairs, 2, n - 1),
            lambda a, b: F.when(a["w"] == b["w"], F.array(a["k"], b["k"])).otherwise(F.array().cast("array<int>")),
        )
        return let(F.sort_array(F.array_distinct(F.flatten(twins))), covered)

    def from_windows(found: Column) -> Column:
        pairs = F.transform(found, lambda w, k: F.struct(w.alias("w"), k.alias("k")))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), none).otherwise(let(F.sort_array(pairs), repeated))

    starts = F.sequence(F.lit(0), F.size(hashes) - 3)
    found = F.transform(starts, lambda k: F.xxhash64(hashes[k], hashes[k + 1], hashes[k + 2]))
    return F.when(F.size(hashes) < 4, none).otherwise(let(found, from_windows))


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    return let(
        F.filter(F.split(text, "\n", -1), lambda line: trimmed(line) != ""),
        lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    )


def features(text: Column) -> Column:
    """Struct of the counts of a whole text; null counts as empty."""
    def of(filled: Column) -> Column:
        return let(
            words_of(filled),
            lambda words: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.aggregate(words, F.lit(0).cast("long"), lambda total, w: total + F.length(w)).alias("word_chars"),
                F.regexp_count(filled, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                dup_lines(filled).alias("n_dup_lines"),
                let(F.transform(words, lambda w: F.xxhash64(w)), repeat_words).alias("n_repeat_words"),
                F.regexp_count(filled, F.lit(WORD_LINE)).cast("long").alias("n_lines"),
            ),
        )

    return let(F.coalesce(text, F.lit("")), of)


def ratios() -> dict[str, Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return {
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "word_length": F.col("word_chars") / words,
    }


def evident(name: str) -> Column:
    """A ratio as far as its count is evidence: a share less one standard error of the count; others as they are."""
    if name not in SHARES:
        return F.col(name)
    count, whole, unit = SHARES[name]
    return (F.col(count) - F.sqrt(F.col(count) * unit)) / F.greatest(whole, F.lit(1))


def fences(sketches: list[str], prefix: str) -> list[Column]:
    """The outer bounds of each ratio from its sketch, and from that of the sizes it is a share of."""
    out = []
    for name in sketches:
        p = FENCES[name]
        q = F.kll_sketch_get_quantile_double(F.col(name), F.array(*map(F.lit, (1 - p, 0.1, 0.5, 0.9, p))))
        high = q[4] + (q[3] - q[2]) * SPREADS
        if name in SHARES:
            _, whole, unit = SHARES[name]
            high = high + unit / F.greatest(F.kll_sketch_get_quantile_double(F.col(f"of_{whole}"), F.lit(0.5)), F.lit(1.0))
        out.append(high.alias(f"{prefix}{name}_high"))
        if name in TWO_SIDED:
            out.append((q[0] - (q[2] - q[1]) * SPREADS).alias(f"{prefix}{name}_low"))
    return out


def thresholds(measured: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, a ``_high`` and perhaps ``_low`` per ratio), from the merged sketches.

    A group of ``min_docs`` documents or more has its own fences; a smaller one counts as n / ``min_docs`` beside its
    language, and so does the language beside the corpus.
    """
    names = list(FENCES)
    sizes = [whole for _, whole, _ in SHARES.values()]
    sketched = [*names, *[f"of_{w}" for w in sizes]]
    groups = share(
        measured.groupBy("lang", "source").agg(
            F.count("*").alias("n"), *[F.kll_sketch_agg_double(r, SKETCH_K).alias(r) for r in names],
            *[F.kll_sketch_agg_double(F.col(w).cast("double"), SKETCH_K).alias(f"of_{w}") for w in sizes],
        ),
        "quality-sketches",
    )

    def merged(by: list[str], prefix: str) -> DataFrame:
        sums = groups.groupBy(*by).agg(F.sum("n").alias(f"{prefix}n"), *[F.kll_merge_agg_double(r).alias(r) for r in sketched])
        return sums.filter(F.col(f"{prefix}n") > 0).select(*by, f"{prefix}n", *fences(names, prefix)).withColumnRenamed("lang", f"{prefix}lang")

    own = groups.select("lang", "source", "n", *fences(names, ""))
    levels = own.join(merged(["lang"], "l_"), F.col("lang").eqNullSafe(F.col("l_lang")), "left").join(
        merged([], "c_"), F.lit(True), "left"
    )
    bounds = [f"{r}_high" for r in names] + [f"{r}_low" for r in TWO_SIDED]

    def shrunk(n: str, own: Column, wider: Column) -> Column:
        w = F.least(F.lit(1.0), F.col(n) / max(1, min_docs))
        return F.when(w >= 1, own).otherwise(own * w + wider * (1 - w))

    return levels.select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"),
        *[shrunk("n", F.col(b), shrunk("l_n", F.col(f"l_{b}"), F.col(f"c_{b}"))).alias(b) for b in bounds],
    )


def quality(
    docs: DataFrame, min_docs: int = 500, broadcast_rows: int = 100_000, text: str = "text"
) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, the counts, the ratios, ``base_failed`` and ``kept`` of every row.

    Thresholds come from the documents that pass the base rules. Their table has a row per language and source; it
    is broadcast up to ``broadcast_rows`` rows, and joined on a salted key beyond, so that no task holds a hot
    group. A null text counts as empty and fails the base rules; null languages and sources are groups of their
    own; repeated rows stay; an empty table gives none. Other columns are not read. A sketch's rank error is about
    0.3 per cent, so a document that stands right on a fence can change sides between runs.
    """
    counted = docs.select("doc_id", "lang", "source", features(docs[text]).alias("_f")).select(
        "doc_id", "lang", "source", "_f.*"
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    measured = share(
        counted.withColumn("base_failed", failed).select("*", *[c.alias(n) for n, c in ratios().items()]), "quality"
    )
    limits = share(thresholds(measured.filter(~F.col("base_failed")), min_docs), "quality-fences")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    if limits.count() <= broadcast_rows:
        joined = measured.join(F.broadcast(limits), same, "left")
    else:
        salted = limits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = measured.withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        joined = spread.join(salted, same & (F.col("_part") == F.col("_salt")), "left")
    inside = F.lit(True)
    for name in FENCES:
        inside = inside & (evident(name) <= F.col(f"{name}_high"))
        if name in TWO_SIDED:
            inside = inside & (F.col(name) >= F.col(f"{name}_low"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return joined.select("doc_id", "lang", "source", *COUNTS, *FENCES, "base_failed", kept.alias("kept"))
