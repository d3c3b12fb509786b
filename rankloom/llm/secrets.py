"""Secret scans through a trigram inverted index.

Every regex is reduced to a Boolean query over the trigrams that any match must contain. The index posts, for each trigram
that some rule asks for, the texts (by content hash) that hold it; intersecting postings gives each rule's candidates, and
only these are matched against the regex. A rule without a mandatory trigram scans every text. All of it is DataFrame
expressions; equal texts share one posting, so copies cost nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import compact, joined, written

#: Strings that a part of a regex may stand for before it counts as anything.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``value`` is the group that must have ``least`` characters; matches that fail are dropped but use up their text."""

    kind: str
    regex: str
    value: int = 0
    least: int = 0


# The formats to find. Runs with a minimal length are written as such, which finds the same runs.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)


def trigram_query(regex: str) -> list[list[frozenset[str]]]:
    """Clauses that all must hold; a clause is a list of alternatives, each a set of lower-case trigrams that all occur.

    The regex is walked from left to right. As long as what was read stands for few strings, they are kept; when it grows
    beyond that, or anything may repeat, the strings so far become a clause and the walk starts anew.
    """
    clauses: list[list[frozenset[str]]] = []

    def close(strings: set[str]) -> None:
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
        if strings and frozenset() not in sets:
            clauses.append(sorted((a for a in sets if not any(b < a for b in sets)), key=sorted))

    def stands_for(node) -> set[str] | None:
        """The strings of one node, None for too many."""
        name, arg = str(node[0]), node[1]
        if name == "LITERAL":
            return {chr(arg).lower()}
        if name == "IN":
            out: set[str] = set()
            for kind, value in arg:
                if str(kind) == "LITERAL":
                    out.add(chr(value).lower())
                elif str(kind) == "RANGE" and value[1] - value[0] < MAX_STRINGS:
                    out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
                else:
                    return None
            return out if len(out) <= 8 else None
        if name == "SUBPATTERN":
            return sequence(arg[3])
        if name == "BRANCH":
            parts = [sequence(p) for p in arg[1]]
            return None if None in parts else set().union(*parts)
        if name == "MAX_REPEAT" and arg[0] == 0 and arg[1] == 1:
            some = sequence(arg[2])
            return None if some is None else some | {""}
        if name == "MAX_REPEAT" and arg[0] == arg[1]:
            some = sequence(arg[2])
            return None if some is None else cross([some] * arg[0])
        return None

    def cross(parts: list[set[str]]) -> set[str] | None:
        out = {""}
        for part in parts:
            out = {a + b for a in out for b in part}
            if len(out) > MAX_STRINGS:
                return None
        return out

    def sequence(nodes) -> set[str] | None:
        parts = [stands_for(n) for n in nodes]
        return None if None in parts else cross(parts)

    held: set[str] = {""}
    for node in regex_parser.parse(regex):
        part = stands_for(node)
        more = None if part is None else cross([held, part])
        if more is None:
            close(held)
            held = part if part is not None else {""}
        else:
            held = more
    close(held)
    return clauses


def _folded(text: Column) -> Column:
    return F.lower(text)


def _content(text: Column) -> Column:
    return F.xxhash64(text)


def build_index(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Postings ``trigram``, ``content`` for the trigrams that the rules ask for. Null texts are empty."""
    wanted = sorted({t for r in rules for clause in trigram_query(r.regex) for a in clause for t in a})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lean = docs.select(_content(text).alias("content"), _folded(text).alias("low"))
    there = F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted)) if wanted else F.expr(
        "cast(array() as array<string>)")
    return lean.select("content", F.explode(F.array_compact(there)).alias("trigram")).select("trigram", "content").distinct()


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``content`` and ``rules``, the bits of the rules whose query a text meets. Rules without a query have no bit."""
    spark = index.sparkSession
    asked = [(k, c, a, t, len(alternative), len(clauses))
             for k, r in enumerate(rules) for clauses in [trigram_query(r.regex)]
             for c, clause in enumerate(clauses) for a, alternative in enumerate(clause) for t in sorted(alternative)]
    query = spark.createDataFrame(asked, "rule int, clause int, alternative int, trigram string, needs int, clauses int")
    whole = index.join(F.broadcast(query), "trigram").groupBy("content", "rule", "clause", "alternative").agg(
        F.count(F.lit(1)).alias("n"), F.max("needs").alias("needs"), F.max("clauses").alias("clauses")).where("n = needs")
    met = whole.groupBy("content", "rule").agg(
        F.countDistinct("clause").alias("n"), F.max("clauses").alias("clauses")).where("n = clauses")
    return met.groupBy("content").agg(F.expr("bit_or(shiftleft(1, rule))").alias("rules"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of the matches of ``rule``: what lies between matches and the matches themselves add up to their places."""
    regex = F.lit(rule.regex)
    t = "array<struct<start: bigint, kind_order: int, end: bigint, kind: string>>"
    matches = F.regexp_extract_all(text, regex, F.lit(0))
    values = F.regexp_extract_all(text, regex, F.lit(rule.value)) if rule.value else matches
    zipped = F.arrays_zip(F.split(text, rule.regex, -1).alias("gap"), matches.alias("match"), values.alias("value"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"]).cast("bigint")
        end = start + F.length(x["match"]).cast("bigint")
        span = F.struct(start.alias("start"), F.lit(order).alias("kind_order"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        kept = F.when(F.length(x["value"]) >= rule.least, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(F.coalesce(end, start).alias("at"), kept.alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr(f"cast(array() as {t})").alias("out"))
    return F.aggregate(zipped, start, step)["out"]


def find(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``docs`` with all its columns and ``secret_spans``: an array of ``start``, ``kind_order``, ``end`` (code points, end
    exclusive) and ``kind``, by start, then by the order of the rules. A column of that name is replaced.

    Null and empty texts have no spans; null and repeated ids and repeated rows stay; an empty table gives an empty one.
    """
    names = [n for n in docs.columns if n != "secret_spans"]
    plain = docs.select(*(F.col(f"`{n}`") for n in names)).toDF(*(f"c{i}" for i in range(len(names))))
    text = F.coalesce(F.col(f"c{names.index('text')}").cast("string"), F.lit(""))
    asked = candidates(build_index(plain.select(text.alias("text")), rules), rules)
    asked = written(compact(asked, 0), "candidates")
    rows = joined(plain.withColumn("content", _content(text)), asked, "content", "left", asked.count(), 32)

    none = F.expr("cast(array() as array<struct<start: bigint, kind_order: int, end: bigint, kind: string>>)")
    parts = []
    for k, rule in enumerate(rules):
        if trigram_query(rule.regex):
            there = F.coalesce(F.col("rules"), F.lit(0)).bitwiseAND(1 << k) != 0
        else:
            there = F.lit(True)
        parts.append(F.when(there & text.rlike(rule.regex), _spans(text, rule, k)).otherwise(none))
    found = rows.withColumn("secret_spans", F.array_sort(F.concat(*parts)))
    return found.select(*plain.columns, "secret_spans").toDF(*names, "secret_spans")


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each run of overlapping spans in the text replaced by ``mark``; ``n_chars``, where there is one, follows.
    Texts without a secret, and null ones, stay as they are."""
    found = find(docs, rules)
    text = F.col("text").cast("string")

    def step(state: Column, x: Column) -> Column:
        fresh = x["start"] >= state["at"]
        # In code points; substring counts from 1.
        between = text.substr(state["at"].cast("int") + 1, (x["start"] - state["at"]).cast("int"))
        return F.struct(
            F.greatest(state["at"], x["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], between, F.lit(mark))).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    folded = F.aggregate(F.col("secret_spans"), start, step)
    rest = F.concat(folded["out"], text.substr(folded["at"].cast("int") + 1, F.length(text)))
    # The new text is a column of its own before its length is taken.
    out = found.withColumn("text", F.when(F.size("secret_spans") > 0, rest).otherwise(text))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.size("secret_spans") > 0, length).otherwise(F.col("n_chars")))
    return out.select(*(F.col(f"`{n}`") for n in docs.columns))


def _check(rules: tuple[Rule, ...]) -> None:
    if len(rules) > 31 or len({r.kind for r in rules}) < len(rules):
        raise ValueError("at most 31 rules, of different kinds")
    reduce(lambda _, r: re.compile(r.regex), rules, None)


_check(BASE + MORE)
