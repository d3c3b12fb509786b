"""Language identification by compression: a text is compressed with a raw-content zstandard dictionary of each language,
and the language whose dictionary leaves the fewest bytes is chosen. Only letters count,
whatever their case."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import compact, small_enough, written

UNKNOWN = "und"
#: Bytes of a language's dictionary; texts are drawn into it until it is full.
DICTIONARY_BYTES = 64 << 10
#: Hash buckets of a language: one text is drawn from each, so this bounds the sample.
DRAWS = 256
#: Of zstandard: from here on it searches the whole dictionary for matches.
LEVEL = 9
#: A text is compressed in blocks, so that the dictionary and not the text's own past explains it.
BLOCK_BYTES = 2 << 10
#: Starts that break a tie between the sizes of a short text.
SHIFTS = 8
#: A prediction is rejected when the runner-up needs less than this share of bytes more.
MARGIN = 0.002

# Unicode's category L, as in the training rows: numbers such as a half or a circled two are no letters.
_LETTER = regex.compile(r"\p{L}")
_LETTERS = regex.compile(r"\p{L}+")


@dataclass(frozen=True)
class Dictionaries:
    languages: list[str]
    contents: list[bytes]
    level: int = LEVEL

    def compressors(self) -> list:
        import zstandard as zs

        out = []
        for content in self.contents:
            # A dictionary needs eight bytes; spaces tell nothing about a language.
            data = zs.ZstdCompressionDict(content.ljust(8), dict_type=zs.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=self.level)
            out.append(zs.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False))
        return out


def learn(docs: DataFrame, training: Column) -> Dictionaries:
    """Dictionaries of all non-null languages in the rows of ``docs`` where ``training`` holds.

    Of each language, the rows are dealt into ``DRAWS`` hash buckets and the text with the smallest hash of each bucket
    is drawn; drawn texts share the dictionary evenly, each with a part that begins at a hashed place, so that all draws
    count and any part of a text may teach. So no language, however frequent, meets in one task. Rows without text or without
    a letter teach nothing; repeated rows are drawn once; an empty table teaches no language.
    """
    order = F.xxhash64("doc_id", "text")
    known = docs.select("doc_id", "text", "lang").where(training & F.col("lang").isNotNull()).where(
        F.col("text").rlike(r"\p{L}"))
    ranked = known.select("lang", order.alias("h")).withColumn("bucket", F.pmod("h", F.lit(DRAWS)))
    drawn = ranked.groupBy("lang", "bucket").agg(F.min("h").alias("h"), F.count(F.lit(1)).alias("n"))
    drawn = written(compact(drawn, 0), "draws")
    rows = drawn.count()
    shares = drawn.groupBy("lang").agg(F.ceil(F.lit(DICTIONARY_BYTES) / F.count(F.lit(1))).cast("int").alias("share"))
    picked = drawn.select("lang", "h").join(shares, "lang")
    found = known.withColumn("h", order).join(F.broadcast(picked) if small_enough(rows, 40) else picked, ["lang", "h"])
    part = F.expr("substring(text, 1 + CAST(pmod(h DIV 4096, greatest(1, length(text) - share + 1)) AS INT), share)")
    texts = found.select("lang", "h", part.alias("text")).dropDuplicates(["lang", "h"])
    by: dict[str, list[tuple[int, bytes]]] = {}
    for r in texts.orderBy("lang", "h").toLocalIterator():
        held = by.setdefault(r["lang"], [])
        if sum(len(t) for _, t in held) < DICTIONARY_BYTES:
            held.append((r["h"], _folded(r["text"])))
    often = dict(drawn.groupBy("lang").agg(F.sum("n")).collect())
    languages = sorted(by, key=lambda k: (-often[k], k))
    return Dictionaries(languages, [b"\n".join(t for _, t in by[k])[:DICTIONARY_BYTES] for k in languages])


def _folded(text: str) -> bytes:
    return " ".join(_LETTERS.findall(text.lower())).encode()


def _sizes(column: pa.Array, compressors: list):
    for text in column.to_pylist():
        if text is None or not _LETTER.search(text):
            yield None
        else:
            raw = _folded(text)
            blocks = [raw[at: at + BLOCK_BYTES] for at in range(0, len(raw), BLOCK_BYTES)]
            sizes = [sum(len(c.compress(b)) for b in blocks) for c in compressors]
            if sizes and len(raw) <= BLOCK_BYTES and sorted(sizes)[:2].count(min(sizes)) == 2:
                # Whole bytes are too coarse here: add up the sizes of the text without its first 0, 1, 2... bytes.
                sizes = [sum(len(c.compress(raw[k:])) for k in range(SHIFTS)) for c in compressors]
            yield sizes


def verdict(text: Column, known: Dictionaries, margin: float = MARGIN) -> Column:
    """``struct<lang, score, rejected>`` of a text. ``lang`` is the smallest size's language (ties: the more frequent
    one in training, then by name), ``und`` for a null text, one without a letter, and when nothing was learned; ``score``
    grows from 0.5 with the margin
    to the runner-up (0 for ``und``, 1 when one language is known); ``rejected`` when it is ``und`` or the margin is below
    ``margin`` of the runner-up's size."""
    result = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    @F.arrow_udf("lang string, score double, rejected boolean")
    def judge(column: pa.Array) -> pa.Array:
        compressors = known.compressors()
        out = []
        for sizes in _sizes(column, compressors):
            if not sizes:
                out.append((UNKNOWN, 0.0, True))
                continue
            best = min(range(len(sizes)), key=sizes.__getitem__)
            second = min((s for k, s in enumerate(sizes) if k != best), default=None)
            gap = 1.0 if second is None else 1 - sizes[best] / second
            out.append((known.languages[best], min(1.0, 0.5 + 5 * gap), gap < margin))
        return pa.array([dict(zip(("lang", "score", "rejected"), x)) for x in out], result)

    return judge(text.cast("string"))


def identify(docs: DataFrame, known: Dictionaries, margin: float = MARGIN) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``rejected`` of every row; nulls, repeated rows and ids stay as they are."""
    return docs.select("doc_id", verdict(F.col("text"), known, margin).alias("v")).select(
        "doc_id", F.col("v.lang").alias("lang_pred"), F.col("v.score").alias("score"), F.col("v.rejected").alias("rejected"))


def accepted(docs: DataFrame, known: Dictionaries, margin: float = MARGIN) -> DataFrame:
    """``docs`` with all its columns, without the rows whose language is rejected."""
    return docs.where(~verdict(F.col("text"), known, margin)["rejected"])
