"""Quality rules (operator 1): weak supervision, native DataFrame functions only.

Cheap rules read counts of a text and vote good (1), bad (-1) or abstain (0).
No rule is trusted alone: expectation-maximisation over the vote patterns of
the whole corpus estimates each rule's accuracy (the chance of each vote given
the hidden label) and the share of good texts; a document's verdict is its
posterior probability of being good. The pattern table has at most 3^rules
rows whatever the corpus; EM is one SQL expression, a fold over its rounds.

The texts are read once: counts and votes (no text) are checkpointed to the
shared folder. Words in repeated 5-word windows are counted inside the row by
64-bit window hashes, so nothing is shuffled but the pattern counts.

Defined cases: NULL and empty texts have no words and fail the base rules; an
empty table gives an empty result; repeated rows get equal verdicts; columns
other than the id and the text never matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SPACE, cut, id_text

WINDOW = 5
START_GOOD, START_BAD = [0.02, 0.18, 0.8], [0.3, 0.1, 0.6]  # chances of a bad vote, none, a good vote
FLOOR = 0.01  # no vote is taken as surer than 1 in 100, so one rule alone seldom condemns


def share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("tinyint")


def rules() -> dict[str, Column]:
    """name -> vote, over the columns of ``counts``."""
    c = F.col
    symbols, runs = share(c("n_symbols"), c("word_chars")), share(c("n_symbol_runs"), c("n_words"))
    letters, upper = share(c("n_letters"), c("word_chars")), share(c("n_upper"), c("word_chars"))
    shouts, types = share(c("n_bangs"), c("n_words")), share(c("n_types"), c("n_words"))
    repeats, dup = share(c("n_repeat_words"), c("n_words")), share(c("n_dup_lines"), c("n_lines"))
    ended, long = share(c("n_ended_lines"), c("n_lines")), c("n_words") >= 30
    return {
        "few_symbols": vote(symbols < 0.005, symbols > 0.02),
        "few_symbol_runs": vote(runs < 0.02, runs > 0.1),
        "letters": vote(letters > 0.88, letters < 0.78),
        "lower_case": vote(upper < 0.12, upper > 0.3),
        "calm": vote(shouts < 0.02, shouts > 0.1),
        "varied_words": vote(long & (types > 0.35), long & (types < 0.15)),
        "few_repeats": vote(long & (repeats < 0.02), repeats > 0.2),
        "unique_lines": vote((c("n_lines") >= 3) & (dup == 0), (c("n_lines") >= 3) & (dup > 0.3)),
        "sentences": vote(ended > 0.8, ended < 0.4),
    }


def counts(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): the counts that the base rules and the votes read."""
    words = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).select(
        "doc_id", "t", F.array_remove(F.split("t", SPACE), "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    # hashes of the 5-word windows, in text order
    hashed = words.withColumn("h", F.when(F.size("w") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("w") - WINDOW),
        lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>")))
    # only texts with a repeated window sort (hash, place): neighbours show the repeats
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    placed = hashed.withColumn("s", F.when(repeats, F.array_sort(F.transform(
        "h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    places = placed.withColumn("p", F.when(F.col("s").isNotNull(), F.array_sort(F.transform(F.filter(
        "s", lambda x, i: F.coalesce(x["h"] == F.get("s", i - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get("s", i + 1)["h"], F.lit(False))), lambda x: x["i"]))))
    covered = F.when(F.col("p").isNull(), F.lit(0).cast("long")).otherwise(F.aggregate(
        F.transform("p", lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get("p", j + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda s, x: s + x))
    upper = F.length("t") - F.length(F.regexp_replace("t", "[A-Z]+", ""))
    return places.select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("t", F.lit("[#*$%&|<>]+")).cast("long").alias("n_symbol_runs"),
        (F.length("t") - F.length(F.regexp_replace("t", r"\p{L}+", ""))).cast("long").alias("n_letters"),
        covered.alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("w")).cast("long").alias("n_types"), upper.cast("long").alias("n_upper"),
        F.regexp_count("t", F.lit("!")).cast("long").alias("n_bangs"),
        F.size(F.filter("lines", lambda x: x.rlike(r"[.?!:;\"'\x29][\x20\x09-\x0D]*\z"))).cast("long")
        .alias("n_ended_lines"))


def voted(docs: DataFrame) -> DataFrame:
    return counts(docs).withColumns({f"v_{k}": v for k, v in rules().items()})


def log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def total(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + of(x))


def posterior(votes: Column, prior: Column, good: Column, bad: Column) -> Column:
    """P(good) of a vote array. ``good`` and ``bad`` hold, by rule, the chances of
    a bad vote, none, a good vote in a good or bad text; rules are taken as
    independent given the label."""
    ratio = F.transform(votes, lambda v, j: F.log(F.get(F.get(good, j), v + 1) / F.get(F.get(bad, j), v + 1)))
    return 1 / (1 + F.exp(-(log_odds(prior) + total(ratio, lambda x: x))))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def em_round(patterns: Column, state: Column, k: int) -> Column:
    """One round over patterns (n, v): posteriors, then the prior and vote chances
    they imply (with one pseudo-count, none below FLOOR)."""
    def chances(scored: Column, weight: str) -> Column:
        whole = total(scored, lambda x: x[weight]) + 3
        return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.transform(
            F.sequence(F.lit(-1), F.lit(1)), lambda v: F.greatest(F.lit(FLOOR), (
                total(scored, lambda x: F.when(F.get(x["v"], j) == v, x[weight]).otherwise(0.0)) + 1) / whole)))

    def maximise(scored: Column) -> Column:
        prior = total(scored, lambda x: x["g"]) / total(scored, lambda x: x["g"] + x["b"])
        return F.struct(F.least(F.lit(0.95), F.greatest(F.lit(0.05), prior)).alias("prior"),
                        chances(scored, "g").alias("good"), chances(scored, "b").alias("bad"))

    def weighed(x: Column) -> Column:
        return let(posterior(x["v"], state["prior"], state["good"], state["bad"]), lambda p: F.struct(
            x["v"].alias("v"), (x["n"] * p).alias("g"), (x["n"] * (1 - p)).alias("b")))

    return let(F.transform(patterns, weighed), maximise)


def estimate(votes: DataFrame, names: list[str], rounds: int = 15) -> tuple[float, list, list]:
    """(share of good, chances in good texts, in bad texts) by EM over the pattern counts of all rows.

    It starts from rules that are better than chance: a bad vote is rare in good
    texts and common in bad ones, a good vote says little."""
    k = len(names)
    patterns = votes.groupBy(*[f"v_{x}" for x in names]).agg(F.count("*").cast("double").alias("n"))
    one = patterns.agg(F.array_sort(F.collect_list(F.struct(
        "n", F.array(*[F.col(f"v_{x}").cast("int") for x in names]).alias("v")))).alias("p"))
    every = lambda x: F.array(*[F.array(*map(F.lit, x))] * k)
    start = F.struct(F.lit(0.8).alias("prior"), every(START_GOOD).alias("good"), every(START_BAD).alias("bad"))
    fit = one.where(F.size("p") > 0).select(F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), start, lambda s, _: em_round(F.col("p"), s, k)).alias("fit")).first()
    return tuple(fit["fit"]) if fit else (0.8, [START_GOOD] * k, [START_BAD] * k)


def quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: its counts, votes, ``base_failed``, posterior
    ``p_good`` and ``kept`` (not base_failed, and p_good >= threshold)."""
    names = list(rules())
    votes = cut(voted(id_text(docs, id_col, text_col)))
    prior, good, bad = estimate(votes, names)
    known = lambda x: F.array(*[F.array(*map(F.lit, y)) for y in x])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    p_good = posterior(F.array(*[F.col(f"v_{k}").cast("int") for k in names]), F.lit(prior), known(good), known(bad))
    return (votes.withColumn("base_failed", failed).withColumn("p_good", p_good)
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)))
