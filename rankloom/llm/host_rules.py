"""Host-level quality rules: texts are judged by rules, failures are added up by host, each host's rate is shrunk towards
an empirical beta prior, and the host's verdict is joined back to its texts. All of it is DataFrame expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import compact, joined, written

WINDOW = 5
MIN_WORDS = 10
#: Percent of a text's words that may lie in repeated windows.
MAX_REPEATED = 20
#: A host goes when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.6
#: Below so many hosts, or without any spread between them, the prior is uniform.
MIN_HOSTS = 2

_SPACE = r"[\x20\x09-\x0D]+"
# The white space and the symbols that are counted.
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is computed once however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _words(text: Column) -> Column:
    trimmed = F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, _SPACE)).otherwise(F.expr("cast(array() as array<string>)"))


def _repeated_words(words: Column) -> Column:
    """How many words lie in a window of ``WINDOW`` words that comes twice or more.

    Window hashes with their places are sorted; places whose neighbour has the same hash, in order, cover at most
    ``WINDOW`` words each, less what the next one covers. Texts without a repeated window stop at the distinct count.
    """
    def covered(order: Column) -> Column:
        twice = F.filter(order, lambda x, k: (F.get(order, k - 1)["h"] == x["h"]) | (F.get(order, k + 1)["h"] == x["h"]))
        places = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return F.aggregate(
            places, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")))["n"]

    def hashes(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(0)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, WINDOW))))

    def count(h: Column) -> Column:
        order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(order, covered))

    return _let(words, lambda w: _let(hashes(w), count)).cast("bigint")


def features(docs: DataFrame, host: Column) -> DataFrame:
    """``doc_id``, ``host``, the counts and ``base_failed``. Null texts have no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lean = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), host.cast("string").alias("host"), text.alias("t"))
    lean = lean.withColumn("words", _words(F.col("t")))
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(_without(x, _SPACES)) > 0)
    repeats = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    counted = lean.select(
        "doc_id", "host",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(_without(F.col("t"), _SPACES)).cast("bigint").alias("word_chars"),
        (F.length("t") - F.length(_without(F.col("t"), _SYMBOLS))).cast("bigint").alias("n_symbols"),
        repeats.cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col("words")).alias("n_repeat_words"))
    return counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))


def beta_prior(hosts: DataFrame) -> DataFrame:
    """One row ``a``, ``b``: the beta distribution with the mean and the variance of the hosts' failure rates, uniform
    where there are too few hosts or no spread to tell."""
    rate = F.col("failed") / F.col("n")
    moments = hosts.agg(F.count(F.lit(1)).alias("k"), F.avg(rate).alias("m"), F.var_samp(rate).alias("v"))
    strength = F.col("m") * (1 - F.col("m")) / F.col("v") - 1
    usable = (F.col("k") >= MIN_HOSTS) & (F.col("v") > 0) & (strength > 0) & (F.col("m") > 0)
    return moments.select(F.when(usable, F.col("m") * strength).otherwise(1.0).alias("a"),
                          F.when(usable, (1 - F.col("m")) * strength).otherwise(1.0).alias("b"))


def host_verdicts(judged: DataFrame) -> DataFrame:
    """``host``, ``n``, ``failed``, the shrunk ``rate`` and ``host_failed``. Rows without a host belong to none."""
    hosts = judged.where("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("bigint")).alias("failed"))
    hosts = written(compact(hosts, 0), "hosts")
    prior = beta_prior(hosts).first()
    rate = (F.col("failed") + F.lit(prior["a"])) / (F.col("n") + F.lit(prior["a"] + prior["b"]))
    return hosts.withColumn("rate", rate).withColumn("host_failed", F.col("rate") > MAX_HOST_RATE)


def judge(docs: DataFrame, host: Column) -> DataFrame:
    """Every row's counts, ``base_failed``, its host's ``rate`` and ``kept``: false for a base failure, else for a host whose
    shrunk rate is too high. Rows without a host are judged by the base rules alone; null and repeated ids and repeated
    rows stay rows; other columns aren't read; an empty table gives an empty result."""
    judged = written(features(docs, host), "judged")
    verdicts = host_verdicts(judged).select("host", "rate", "host_failed")
    # The verdicts are one row a host: broadcast if they are few, else a join that splits the rows of a hot host.
    rows = joined(judged, verdicts, "host", "left", verdicts.count(), 64)
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False)))
