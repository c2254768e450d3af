"""Language identification with bit-sliced Bloom filters of letter n-grams.

Every slot of the filter table holds a mask with one bit per language. An n-gram is three code points
of the lower-cased text, the middle one a letter, other signs counting as one blank. Adding an n-gram
of a language sets the language's bit in `PROBES` slots; the AND of an n-gram's slots is the set of
all languages that contain it. Each language's hits among a text's n-grams are counted, the filter's
expected false positives are taken off, and the largest corrected count decides.

Learning uses a bounded sample: of each language about `TRAIN_ROWS` documents, chosen by the hash of
their ids. N-grams are counted over it as a Spark job; a language contains an n-gram whose share of its
n-grams is at least `MIN_SHARE`, however often other languages have it, so at most 1 / MIN_SHARE n-grams of
a language reach the driver.

Defined cases: a null text or one without a letter is `und` with score 0; a text of which no n-gram is
known, and ties, go to the first language by code point (score 0 without a hit); without any learned
language every text is `und`; rows without a language are not learned from; repeated rows count again;
other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import blocks, give_back, small_batches, table
from riskloom.llm.quality import held_out
from riskloom.session import materialize

#: Documents of each language that are learned from, about.
TRAIN_ROWS = 2000
#: Languages a model may have; more are an error, as their masks would no longer be small.
MOST_LANGUAGES = 1024
SLOTS, PROBES, MIN_SHARE = 1 << 18, 3, 3e-5


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed n-grams of all texts, how many each text has, and whether it has a letter."""
    lowered = [(text or "").lower() for text in texts]
    codes = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le"), np.uint32)
    present = np.flatnonzero(np.bincount(codes))
    table = np.zeros(int(present[-1]) + 1, np.int64)
    for code in present.tolist():
        if chr(code).isalpha():
            table[code] = code
    codes = table[codes]
    middle = np.flatnonzero(codes[1:-1]) + 1
    packed = codes[middle - 1] << 42 | codes[middle] << 21 | codes[middle + 1]
    # Text i covers positions start[i] to start[i] + size[i] of the joined codes.
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    starts = 1 + np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    first, last = np.searchsorted(middle, starts), np.searchsorted(middle, starts + sizes)
    return packed, last - first, last > first


def probes(packed: np.ndarray) -> list[np.ndarray]:
    """The slots of each n-gram."""
    mixed = packed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    bits = SLOTS.bit_length() - 1
    return [(mixed >> np.uint64(64 - bits * (i + 1))).astype(np.int64) & (SLOTS - 1) for i in range(PROBES)]


@dataclass
class Filters:
    """languages in order; masks[w][slot] holds the bits of languages 64w to 64w + 63."""

    languages: list[str]
    masks: list[np.ndarray]
    false_rate: np.ndarray

    @staticmethod
    def build(languages: list[str], known: dict[str, np.ndarray]) -> Filters:
        masks = [np.zeros(SLOTS, np.uint64) for _ in range(-(-len(languages) // 64))]
        for i, language in enumerate(languages):
            for slots in probes(known.get(language, np.zeros(0, np.int64))):
                masks[i // 64][slots] |= np.uint64(1 << i % 64)
        fill = [float(((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) for i in range(len(languages))]
        return Filters(languages, masks, np.array(fill) ** PROBES)

    def hits(self, packed: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each text and language, the n-grams that the language's filter holds."""
        out = np.zeros((len(sizes), len(self.languages)), np.int64)
        filled = np.flatnonzero(sizes > 0)
        if not len(filled) or not self.languages:
            return out
        starts = (np.cumsum(sizes) - sizes)[filled]
        slots = probes(packed)
        for word, mask in enumerate(self.masks):
            found = mask[slots[0]]
            for more in slots[1:]:
                found &= mask[more]
            for bit in range(min(64, len(self.languages) - 64 * word)):
                here = ((found >> np.uint64(bit)) & np.uint64(1)).astype(np.int32)
                out[filled, 64 * word + bit] = np.add.reduceat(here, starts)
        return out

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        packed, sizes, lettered = grams(texts)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        right = (self.hits(packed, sizes) - sizes[:, None] * self.false_rate) / (1 - self.false_rate)
        right = np.maximum(right, 0)
        best = right.argmax(axis=1)
        share = right.max(axis=1) / np.maximum(right.sum(axis=1), 1e-12)
        names = [self.languages[i] if ok else "und" for i, ok in zip(best.tolist(), lettered.tolist())]
        return names, np.where(lettered, np.clip(share, 0, 1), 0.0)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS) -> Filters:
    """Filters of the languages of `docs`; what is held out must not be in it."""
    rows_of = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang IS NOT NULL")
    counted = materialize(rows_of.groupBy("lang").agg(F.count("*").alias("count")), "languages")
    languages = [row["lang"] for row in counted.orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not languages:
        return Filters([], [], np.zeros(0))
    # One row for each of at most MOST_LANGUAGES languages.
    quota = F.broadcast(counted.select("lang", F.least(F.lit(1.0), rows / F.col("count")).alias("part")))
    drawn = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1 << 30)) < F.col("part") * (1 << 30)
    sample = rows_of.join(quota, "lang").where(drawn).select("lang", "text")

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for block in blocks(texts, chars=1_000_000):
                    values, n = np.unique(grams(block)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(n)], ["lang", "gram", "n"])

    each = sample.mapInArrow(count_grams, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    each = materialize(each, "language-grams")
    totals = F.broadcast(each.groupBy("lang").agg(F.sum("n").alias("total")))
    frame = each.join(totals, "lang").where(F.col("n") >= MIN_SHARE * F.col("total")).select("lang", "gram").toPandas()
    return Filters.build(languages, {lang: part["gram"].to_numpy(np.int64) for lang, part in frame.groupby("lang")})


def identify(spark: SparkSession, filters: Filters, text_col: str = "text") -> Column:
    """A struct of lang_pred and score for each text."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(filters)

    @F.arrow_udf("lang_pred string, score double")
    def identified(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for batch in batches:
            names, scores = [], []
            for block in blocks(batch.to_pylist(), chars=1_000_000):
                found, values = known.decide(block)
                names += found
                scores += values.tolist()
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])
        batch = names = scores = None  # noqa: F841
        give_back()

    return identified(text_col)


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    filters = learn(docs.where(~held_out()))
    found = docs.select("doc_id", held_out().alias("held_out"), identify(spark, filters).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")
