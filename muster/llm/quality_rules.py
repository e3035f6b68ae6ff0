"""Weak supervision of document quality: rules vote or abstain, and EM weighs their votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.tables import stored, table

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
ITERATIONS = 30
THRESHOLD = 0.5

# Each rule: when it votes for a document, and when against it; else it abstains.
RULES = {
    "length": ("n_words >= 50", f"n_words < {MIN_WORDS}"),
    "word_length": ("word_chars between 4 * n_words and 7 * n_words", "word_chars < 3 * n_words or word_chars > 10 * n_words"),
    "symbols": ("100 * n_symbols <= word_chars", "100 * n_symbols > 4 * word_chars"),
    "letters": ("100 * n_letters >= 90 * word_chars", "100 * n_letters < 80 * word_chars"),
    "lines": ("10 * n_dup_lines <= n_lines", "10 * n_dup_lines > 3 * n_lines"),
    "repeats": ("20 * n_repeat_words <= n_words", "4 * n_repeat_words > n_words"),
    "distinct": ("n_words <= 2000 and 100 * n_distinct >= 45 * n_words", "n_words between 100 and 2000 and 100 * n_distinct < 25 * n_words"),
}


def votes() -> Column:
    """One vote a rule: 1, -1, or 0 for an abstention."""
    return F.array(
        *(
            F.expr(f"case when {good} then 1 when {bad} then -1 else 0 end").cast("tinyint")
            for good, bad in RULES.values()
        )
    )


def with_statistics(rows: DataFrame, text: str) -> DataFrame:
    """Adds the text statistics to ``rows``. A null text counts as empty.

    Everything is computed inside a row, so nothing is shuffled. Windows are compared by 64-bit hash
    within one document. Arrays that a lambda captures are columns of a step before, so that they are
    made once a row.
    """
    given = F.coalesce(F.col(text), F.lit(""))
    split = rows.select(
        "*",
        F.filter(F.split(given, r"\s+"), lambda w: w != "").alias("_words"),
        F.filter(F.split(given, "\n"), lambda line: line.rlike(r"\S")).alias("_lines"),
        F.length(F.regexp_replace(given, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(given, r"\P{L}+", "")).cast("long").alias("n_letters"),
    )
    counted = split.select(
        *(c for c in split.columns if c not in ("_words", "_lines")),
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    item = ", ".join(f"get(_hashes, i + {k})" for k in range(WINDOW))
    windows = counted.select(
        "*",
        F.size(F.array_distinct("_hashes")).cast("long").alias("n_distinct"),
        F.expr(
            f"if(n_words < {WINDOW}, cast(array() as array<bigint>), "
            f"transform(sequence(0, cast(n_words as int) - {WINDOW}), i -> xxhash64({item})))"
        ).alias("_windows"),
    )
    # Most documents repeat no window: only the others are sorted.
    ordered = windows.select(
        *(c for c in windows.columns if c not in ("_hashes", "_windows")),
        F.expr(
            "if(size(array_distinct(_windows)) = size(_windows), null, "
            "sort_array(transform(_windows, (h, i) -> struct(h, i))))"
        ).alias("_ordered"),
    )
    starts = ordered.select(
        *(c for c in ordered.columns if c != "_ordered"),
        F.expr(
            "sort_array(transform(filter(transform(_ordered, (x, k) -> struct(x.i as i, "
            "x.h <=> get(_ordered, k - 1).h or x.h <=> get(_ordered, k + 1).h as twice)), "
            "x -> x.twice), x -> x.i))"
        ).alias("_starts"),
    )
    covered = F.expr(
        f"aggregate(_starts, struct(0L as n, -{WINDOW} as last), "
        f"(a, s) -> struct(a.n + least({WINDOW}, s - a.last) as n, s as last), a -> a.n)"
    )
    return starts.select(
        *(c for c in starts.columns if c != "_starts"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def posteriors(cast: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """(votes, quality): the posterior probability of good quality for each pattern of votes.

    ``cast`` has (votes, base_failed); rows that fail are not counted.

    Two-coin model: a rule that votes is right with probability ``s`` on good documents and ``t`` on
    bad ones; an abstention says nothing. EM runs on the counted patterns, of which there are at most
    3 ** rules whatever the number of documents, in one aggregate expression over the iterations.
    Counts are smoothed by half a vote, ``s`` is held at 0.6 and above, and ``t`` above the share of
    wrong votes on good documents, so that the classes can't trade places.
    """
    rules = len(RULES)
    counted = cast.groupBy("votes").agg(F.sum(1 - F.col("base_failed").cast("int")).cast("double").alias("n"))
    one = counted.filter("n > 0").agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
    # ln P(bad) - ln P(good) of a pattern under the state
    odds = (
        "aggregate(sequence(0, {last}), ln(1 - state.prior) - ln(state.prior), (z, j) -> z + case get(p.votes, j) "
        "when 1 then ln(1 - get(state.t, j)) - ln(get(state.s, j)) "
        "when -1 then ln(get(state.t, j)) - ln(1 - get(state.s, j)) else 0D end)"
    ).format(last=rules - 1)
    weighed = f"transform(patterns, p -> struct(p.votes as votes, p.n as n, 1 / (1 + exp({odds})) as g))"

    def total(value: str, over: str = "w") -> str:
        return f"aggregate({over}, 0D, (z, p) -> z + {value})"

    s = (
        f"greatest(0.6D, ({total('if(get(p.votes, j) = 1, p.n * p.g, 0D)')} + 0.5D) / "
        f"({total('if(get(p.votes, j) != 0, p.n * p.g, 0D)')} + 1D))"
    )
    t = (
        f"({total('if(get(p.votes, j) = -1, p.n * (1 - p.g), 0D)')} + 0.5D) / "
        f"({total('if(get(p.votes, j) != 0, p.n * (1 - p.g), 0D)')} + 1D)"
    )
    # The inner transform over one element names the weighed patterns, which each sum then reads.
    step = (
        f"get(transform(array({weighed}), w -> struct("
        f"greatest(0.05D, least(0.95D, ({total('p.n * p.g')} + 0.5D) / ({total('p.n')} + 1D))) as prior, "
        f"transform(sequence(0, {rules - 1}), j -> {s}) as s, "
        f"transform(transform(sequence(0, {rules - 1}), j -> struct({s} as s, {t} as t)), "
        f"x -> greatest(x.t, least(0.99D, 2 * (1 - x.s)))) as t)), 0)"
    )
    first = f"struct(0.85D as prior, array_repeat(0.95D, {rules}) as s, array_repeat(0.5D, {rules}) as t)"
    fitted = one.select(
        "patterns",
        F.expr(f"aggregate(sequence(1, {iterations}), {first}, (state, k) -> {step})").alias("state"),
    )
    return fitted.select(F.expr(f"inline({weighed})")).select("votes", F.col("g").alias("quality"))


def with_quality(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` as a struct column ``document``, its statistics, votes, ``quality`` and ``kept``.

    EM runs over all documents that pass the base rules; the others are never kept, and their quality
    is null if no passing document votes alike. The posteriors, one row per pattern of votes
    (3 ** rules at most), are broadcast; documents are read twice and never shuffled.

    Null or empty text: no words, base failed. Very long texts are judged whole. Empty table: no rows. Repeated rows: each is judged
    alike. Extra columns stay inside ``document``, whatever their names.
    """
    rows = documents.select(F.struct("*").alias("document"), F.col(text).alias("_text"))
    judged = with_statistics(rows, "_text").drop("_text").withColumn("votes", votes())
    return _verdicts(judged)


def _verdicts(judged: DataFrame) -> DataFrame:
    checked = judged.withColumn("base_failed", base_failed())
    quality = F.broadcast(posteriors(checked.select("votes", "base_failed")))
    known = checked.join(quality, "votes", "left")
    # One product of both sides: a filter on it stays above the statistics, which would else be
    # written out anew inside the pushed-down condition.
    passes = F.when(F.col("base_failed"), 0.0).otherwise(1.0)
    return known.withColumn("kept", F.coalesce(F.col("quality") * passes, F.lit(0.0)) >= THRESHOLD)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics, base verdict and verdict of every document."""
    rows = table(spark, folder, "documents").select("doc_id", F.col("text").alias("_text"))
    judged = with_statistics(rows, "_text").drop("_text").withColumn("votes", votes())
    return _verdicts(stored(judged, "quality-statistics")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: the documents that are kept, unchanged.

    Documents and their statistics are stored, so that these are computed once for the fit and the verdict.
    Null, empty and short texts fail the base rules and go. Repeated rows are judged alike; very long texts
    are judged whole. Empty table: no rows. Extra columns stay as they are, whatever their names.
    """
    rows = docs.select(F.struct("*").alias("document"), F.col("text").alias("_text"))
    judged = with_statistics(rows, "_text").drop("_text").withColumn("votes", votes())
    return _verdicts(stored(judged, "quality-documents")).filter("kept").select("document.*")
