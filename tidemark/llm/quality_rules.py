"""Quality rules whose cutoffs are chosen under a bound on false rejections.

Each rule is a score (higher is worse) and a fixed ladder of cutoffs. Labelled
documents give, per stratum, set of rules and place on the ladders, how many good
ones the set together would reject. A set may be used at a place only if the exact
binomial test rejects "it refuses at least ``risk`` of the good documents". A set's
rejections are nested from the safest place on, so its tests are a fixed sequence
and share one level, ``error`` / (strata x sets). So with probability 1 - ``error``
the rules used refuse at most ``risk`` of the good documents of each stratum; strata
with too few labels for any test to pass are one, and bounded as one.

Everything is DataFrame expressions. Values that several later expressions need
are generated (one-row ``explode``), so that they are worked out once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import spare
from tidemark.operators.skew import fact_dim_join
from tidemark.session import written

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Rules and their ladders: reject when the score is above the cutoff.
LADDERS: dict[str, list[float]] = {
    "symbols": [0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3],
    "duplicate_lines": [0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7],
    "repeated_words": [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5],
    "same_words": [0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95],
    "word_length": [8.0, 9.0, 10.0, 12.0, 14.0, 17.0, 20.0, 30.0],
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _once(df: DataFrame, **values: Column) -> DataFrame:
    """Adds columns that are worked out once however often they are used."""
    held = spare("held", df.columns)
    row = F.struct(*[v.alias(k) for k, v in values.items()])
    with_row = df.select(*[f"`{c}`" for c in df.columns], F.explode(F.array(row)).alias(held))
    return with_row.select(*[f"`{c}`" for c in df.columns], *[F.col(held)[k].alias(k) for k in values])


def _without_blanks(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def text_statistics(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the five base counts and ``n_lines``, ``n_distinct``, each named with ``prefix``.

    Words are cut at space and 0x09-0x0D; a null text has none.
    """
    tmp = {k: spare(f"_{k}", docs.columns) for k in ("t", "w", "h", "s", "p", "l")}
    t, w, h, s, p = (F.col(tmp[k]) for k in "twhsp")
    rows = _once(docs, **{tmp["t"]: F.coalesce(F.col(text).cast("string"), F.lit(""))})
    spaced = F.split(F.translate(t, BLANKS, " " * len(BLANKS)), " ")
    rows = _once(
        rows,
        **{
            tmp["w"]: F.filter(spaced, lambda x: x != ""),
            tmp["l"]: F.filter(F.split(t, "\n"), lambda x: F.length(_without_blanks(x)) > 0),
        },
    )
    n = F.size(w)
    windows = F.transform(
        F.slice(w, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
    )
    rows = _once(rows, **{tmp["h"]: windows})
    # Only texts with a repeated window are sorted.
    repeated = F.size(F.array_distinct(h)) < F.size(h)
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    rows = _once(rows, **{tmp["s"]: F.when(repeated, pairs)})
    doubled = F.filter(
        s,
        lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False)),
    )
    rows = _once(rows, **{tmp["p"]: F.sort_array(F.transform(doubled, lambda x: x["i"]))})
    # Each start covers three words, less those that the start before it covers.
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("sum"))
    covered = F.aggregate(
        p,
        start,
        lambda a, x: F.struct(x.alias("last"), (a["sum"] + F.least(F.lit(3), x - a["last"])).alias("sum")),
        lambda a: a["sum"],
    )
    lines = F.col(tmp["l"])
    values = {
        "n_words": n,
        "word_chars": F.length(_without_blanks(t)),
        "n_symbols": F.length(t) - F.length(F.translate(t, SYMBOLS, "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size(lines),
        "n_distinct": F.size(F.array_distinct(w)),
    }
    return rows.select(
        *[f"`{c}`" for c in docs.columns], *[v.cast("long").alias(prefix + k) for k, v in values.items()]
    )


def base_failed(prefix: str = "") -> Column:
    n, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * repeated > 50 * n)


def scores(prefix: str = "") -> dict[str, Column]:
    """Each rule's score; 0 where there is nothing to judge."""

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(prefix + a), F.col(prefix + b)), F.lit(0.0))

    return {
        "symbols": share("n_symbols", "word_chars"),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "same_words": F.when(F.col(f"{prefix}n_words") > 0, 1 - share("n_distinct", "n_words")).otherwise(0.0),
        "word_length": share("word_chars", "n_words"),
    }


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(at most ``k`` of ``n`` happen at ``rate``), exact, summed in logarithms."""
    odds = F.lit(rate / (1 - rate))
    first = n * F.log1p(F.lit(-rate))
    begin = F.struct(first.alias("term"), first.alias("sum"))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i) / (i + 1) * odds)
        high, low = F.greatest(term, a["sum"]), F.least(term, a["sum"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    steps = F.when(k > 0, F.sequence(F.lit(0).cast("long"), k - 1)).otherwise(F.array().cast("array<long>"))
    # A count beyond the mean can't be significant, and is not summed.
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(
        F.least(F.exp(F.aggregate(steps, begin, step, lambda a: a["sum"])), F.lit(1.0))
    )


def cutoffs(
    stats: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    risk: float = 0.02,
    error: float = 0.05,
    prefix: str = "",
) -> DataFrame:
    """One row per stratum: ``stratum`` and ``cutoff``, a map from rule to cutoff.

    ``labels`` (doc_id, quality): 1 is good, anything else but null is bad; a
    document with labels of both kinds is bad. Of the sets of rules and places that
    pass the test, a stratum takes what refuses most bad less good documents, of
    equals the fewest rules and the highest cutoffs, and none if it refuses no more
    bad ones than good ones. A null stratum is a stratum. Strata with fewer than
    ``labels_needed`` good labels take what they pass together. Without labels there
    are no rows.
    """
    judged = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min((F.col("quality") == 1).cast("int")).alias("good"))
    )
    score = scores(prefix)
    named = stats.where(~base_failed(prefix)).select(
        "doc_id", F.col(stratum).cast("string").alias("stratum"), *[c.alias(f"r_{r}") for r, c in score.items()]
    )
    held = named.join(judged.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"))
    # A rule's level is the number of its cutoffs that the score is above.
    levels = {r: sum((F.col(f"r_{r}") > c).cast("int") for c in ladder).alias(f"l_{r}") for r, ladder in LADDERS.items()}
    good = F.col("good") == 1
    counted = held.select("stratum", "good", *levels.values()).groupBy("stratum", *[f"l_{r}" for r in LADDERS])
    counted = written(counted.agg(F.count_if(good).alias("g"), F.count_if(~good).alias("b")), "quality-levels")
    sizes = written(counted.groupBy("stratum").agg(F.sum("g").alias("n")), "quality-strata")
    strata = sizes.count()
    small = F.col("n") < labels_needed(strata, risk, error)
    sizes = sizes.withColumn("rest", small).withColumn("group", F.when(~small, F.col("stratum")))
    # A set of rules is a number with a bit per rule; it rejects at a place below its rules' highest level.
    sets = [
        F.struct(
            F.lit(s).alias("rules"),
            F.array_max(F.array(*[F.col(f"l_{r}") for j, r in enumerate(LADDERS) if s >> j & 1])).alias("level"),
        )
        for s in range(1, 1 << len(LADDERS))
    ]
    named_sizes = sizes.select(F.col("stratum").alias("_stratum"), "rest", "group")
    each = counted.join(named_sizes, F.col("stratum").eqNullSafe(F.col("_stratum")))
    each = each.select("rest", "group", "g", "b", F.explode(F.array(*sets)).alias("s")).where("s.level > 0")
    each = each.select("rest", "group", "g", "b", "s.rules", F.explode(F.sequence(F.lit(0), F.col("s.level") - 1)).alias("place"))
    each = each.groupBy("rest", "group", "rules", "place").agg(F.sum("g").alias("k"), F.sum("b").alias("bad"))
    groups = sizes.groupBy(F.col("rest").alias("_rest"), F.col("group").alias("_group")).agg(F.sum("n").alias("n"))
    same = (F.col("rest") == F.col("_rest")) & F.col("group").eqNullSafe(F.col("_group"))
    tested = _once(each.join(groups, same), p=binomial_tail(F.col("k"), F.col("n"), risk))
    # A place's rejections hold those of all safer ones, so these have passed if it passes.
    passed = tested.where((F.col("p") <= _level(strata, error)) & (F.col("bad") > F.col("k")))
    gain = F.struct((F.col("bad") - F.col("k")).alias("gain"), (-F.bit_count("rules")).alias("few"), "place", (-F.col("rules")).alias("set"))
    best = passed.groupBy("_rest", "_group").agg(F.max(gain).alias("best")).select("_rest", "_group", "best.place", (-F.col("best.set")).alias("rules"))
    at = [
        x
        for j, (r, ladder) in enumerate(LADDERS.items())
        for x in (F.lit(r), F.when(F.col("rules").bitwiseAND(1 << j) > 0, F.get(F.array(*map(F.lit, ladder)), F.col("place"))))
    ]
    cutoff = F.map_filter(F.create_map(*at), lambda _, x: x.isNotNull())
    return sizes.join(best, same).select("stratum", cutoff.alias("cutoff"))


def _level(strata: int, error: float) -> float:
    return error / (max(1, strata) * ((1 << len(LADDERS)) - 1))


def labels_needed(strata: int, risk: float = 0.02, error: float = 0.05) -> int:
    """Good labels past the base that a stratum needs for a set without false rejections to pass."""
    return math.ceil(math.log(_level(strata, error)) / math.log1p(-risk))


def judge(stats: DataFrame, chosen: DataFrame, stratum: str = "lang", prefix: str = "", kept: str = "kept") -> DataFrame:
    """``stats`` with ``kept``: false if the base fails or a rule's score is above its stratum's cutoff.

    The cutoffs have one row per stratum; they are sent to all tasks while the
    planner's estimate is small, else joined with hot strata split.
    """
    key, cut = spare("stratum_key", stats.columns), spare("stratum_cutoff", stats.columns)
    # Null is a stratum too: both sides carry a key that is never null.
    def named(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))

    dim = written(chosen.select(named(F.col("stratum")).alias(key), F.col("cutoff").alias(cut)), "cutoffs")
    joined = fact_dim_join(stats.withColumn(key, named(F.col(f"`{stratum}`"))), dim, [key], "left")
    over = F.lit(False)
    for rule, score in scores(prefix).items():
        over = over | F.coalesce(score > F.try_element_at(F.col(cut), F.lit(rule)), F.lit(False))
    return joined.withColumn(kept, ~(base_failed(prefix) | over)).drop(key, cut)


def quality_report(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """Per row of ``docs``: doc_id, the base counts, ``base_failed`` and ``kept``.

    The counts are worked out once, written, and both calibrate and judge. Null
    and empty texts fail the base. Rows that share an id are judged one by one.
    """
    narrow = docs.select("doc_id", F.col(stratum).alias("stratum"), "text")
    counted = text_statistics(narrow).drop("text")
    stats = written(counted, "quality-statistics")
    found = judge(stats, cutoffs(stats, labels, "stratum", **options), "stratum")
    return found.select("doc_id", *BASE, base_failed().alias("base_failed"), "kept")


def good_documents(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", most_sent: int = 500_000, **options
) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged.

    Null and empty texts have no words, so the base refuses them. Repeated rows are
    judged one by one, rows without an id by the cutoffs alone.
    The counts are worked out twice, once on labelled documents to calibrate and once
    beside the texts; no text is shuffled while at most ``most_sent`` ids are labelled.
    """
    narrow = docs.select("doc_id", F.col(stratum).alias("stratum"), "text")
    known = written(
        labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").alias("_id")).distinct(), "labelled"
    )
    known = F.broadcast(known) if known.count() <= most_sent else known
    labelled = narrow.join(known, F.col("doc_id") == F.col("_id"), "left_semi")
    stats = written(text_statistics(labelled).drop("text"), "quality-statistics")
    chosen = cutoffs(stats, labels, "stratum", **options)
    prefix, kept = spare("q__", docs.columns), spare("kept", docs.columns)
    judged = judge(text_statistics(docs, prefix=prefix), chosen, stratum, prefix, kept)
    return judged.where(F.col(kept)).select(*[f"`{c}`" for c in docs.columns])
