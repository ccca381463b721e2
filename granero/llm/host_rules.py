"""Quality rules whose failures also count against the host.

Everything is a column expression. A document's measures come from its words; a
rule is a condition on the measures. Failures are counted per host and rule, and
a host's rate is shrunk towards the rate of all hosts by a beta prior fitted to
the hosts themselves. A host whose shrunk rate is too high takes its documents
with it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.llm.tables import BLANKS, blank_words, let
from granero.sources.staging import stage

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
WINDOW = 3


def _neighbours_equal(ordered: Column) -> Column:
    """Positions of the sorted (hash, position) pairs whose hash occurs twice or more."""
    last = F.size(ordered) - 1
    marked = F.transform(
        ordered,
        lambda pair, i: F.when(
            ((i > 0) & (ordered[F.greatest(i - 1, F.lit(0))]["h"] == pair["h"]))
            | ((i < last) & (ordered[F.least(i + 1, last)]["h"] == pair["h"])),
            pair["p"],
        ),
    )
    return F.sort_array(F.filter(marked, lambda place: place.isNotNull()))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words in windows that a text has twice or more, first ones included.

    Windows are compared by a 64-bit hash.
    """

    def covered(places: Column) -> Column:
        last = F.size(places) - 1
        return F.aggregate(
            F.transform(
                places,
                lambda place, i: F.when(
                    i < last, F.least(places[F.least(i + 1, last)] - place, F.lit(window))
                ).otherwise(window),
            ),
            F.lit(0).cast("bigint"),
            lambda total, part: total + part,
        )

    def count(given: Column) -> Column:
        windows = F.size(given) - (window - 1)
        pairs = F.transform(
            F.sequence(F.lit(0), windows - 1),
            lambda p: F.struct(
                F.xxhash64(*(given[p + k] for k in range(window))).alias("h"), p.alias("p")
            ),
        )
        return F.when(
            windows >= 2,
            let(F.sort_array(pairs), lambda ordered: let(_neighbours_equal(ordered), covered)),
        ).otherwise(F.lit(0).cast("bigint"))

    return let(words, count)


def repeated_lines(text: Column) -> Column:
    """Number of lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))
    return let(lines, lambda own: (F.size(own) - F.size(F.array_distinct(own))).cast("bigint"))


def measures(text: Column) -> dict[str, Column]:
    """The measures of a whole text; a null text has no words, lines or signs."""
    given = F.coalesce(text.cast("string"), F.lit(""))
    return {
        "n_words": F.size(blank_words(given)).cast("bigint"),
        "word_chars": (F.length(given) - F.regexp_count(given, F.lit(f"[{BLANKS}]"))).cast("bigint"),
        "n_symbols": F.regexp_count(given, F.lit("[#*$%&|<>]")).cast("bigint"),
        "n_dup_lines": repeated_lines(given),
        "n_repeat_words": repeated_words(blank_words(given)),
    }


@dataclass(frozen=True)
class HostPolicy:
    """``worst_rate``: a host is dropped when the shrunk share of its documents that
    fail one rule is above it."""

    worst_rate: float = 0.5


def base_rules() -> dict[str, Column]:
    """Rules that fail a document by themselves."""
    return {
        "few_words": F.col("n_words") < 50,
        "repeated": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
    }


def host_rules() -> dict[str, Column]:
    """Rules that only count against the host: signs and repeated lines."""
    return {
        "signs": 10 * F.col("n_symbols") > F.col("word_chars"),
        "lines": 5 * F.col("n_dup_lines") > F.col("n_words"),
    }


def beta_priors(counts: DataFrame, rules: list[str]) -> dict[str, tuple[float, float]]:
    """Per rule (a, b) of the beta prior that fits the hosts' rates by moments.

    The between-host variance is the variance of the rates less what chance adds
    to it. Hosts that do not differ by more than chance, or a single host, give
    the strongest prior: as many documents as all hosts have.
    """
    n = F.col("n").cast("double")
    found = counts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n").alias("n"),
        F.avg(1 / n).alias("inverse"),
        *(F.sum(rule).alias(f"{rule}_sum") for rule in rules),
        *(F.var_pop(F.col(rule) / n).alias(f"{rule}_var") for rule in rules),
    ).first()
    priors = {}
    for rule in rules:
        total = found["n"] or 0
        mean = min(max((found[f"{rule}_sum"] or 0) / total, 1e-6), 1 - 1e-6) if total else 0.5
        chance = mean * (1 - mean) * (found["inverse"] or 0)
        between = (found[f"{rule}_var"] or 0) - chance
        strength = mean * (1 - mean) / between - 1 if between > 0 else float(total)
        strength = min(max(strength, 1e-3), float(max(total, 1)))
        priors[rule] = (mean * strength, (1 - mean) * strength)
    return priors


def host_quality(
    docs: DataFrame,
    host: str = "source",
    policy: HostPolicy = HostPolicy(),
    own: Mapping[str, Column] | None = None,
    shared: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Measures and verdicts of all documents.

    ``own`` rules fail a document; those and the ``shared`` ones count against its
    host. Result: doc_id, the measures, ``base_failed``, ``host_rejected`` and
    ``kept``. A missing host is a host of its own. Null and empty texts have zero
    measures. Repeated rows count as often as they occur and all come back. Other
    columns are not read. An empty table gives an empty result.
    """
    own = base_rules() if own is None else own
    shared = host_rules() if shared is None else shared
    rules = {**own, **shared}
    measured = stage(
        docs.select(
            F.col("doc_id"),
            F.col(host).alias("_host"),
            *(column.alias(name) for name, column in measures(F.col("text")).items()),
        )
    )
    counts = measured.groupBy("_host").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(rule).alias(name) for name, rule in rules.items()),
    )
    # One row of sums comes back, however many hosts there are.
    priors = beta_priors(counts, list(rules))
    bad = F.lit(False)
    for name, (a, b) in priors.items():
        bad = bad | ((F.col(name) + a) / (F.col("n") + a + b) > policy.worst_rate)
    rejected = counts.where(bad).select(F.col("_host").alias("_bad_host"), F.lit(True).alias("_bad"))
    failed = F.lit(False)
    for rule in own.values():
        failed = failed | rule
    return (
        measured.join(rejected, F.col("_host").eqNullSafe(F.col("_bad_host")), "left")
        .withColumn("base_failed", failed)
        .withColumn("host_rejected", F.coalesce(F.col("_bad"), F.lit(False)))
        .select(
            "doc_id",
            *MEASURES,
            "base_failed",
            "host_rejected",
            (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"),
        )
    )
