"""Document fingerprints from Lempel-Ziv phrases.

A text's UTF-8 bytes are parsed into dictionary phrases: the longest phrase seen so far plus one byte
becomes a new phrase. The set of phrases, hashed, is reduced to a one-permutation minimum-hash
signature of `BINS` 16-bit values; the share of equal values estimates how much of their phrases two
texts have in common, as a compression distance does.

Neighbours in the order of ids come from Spark's range partitioning: each range is sorted and read as a
stream, and the texts at the ends of ranges are written beside the results and joined afterwards, the
last of a range with the first of the next. No window spans the table.

Defined cases: a null text is an empty one; an empty text has one fixed fingerprint, alike to itself
only; null ids come first; rows of one id follow each other by text; equal texts have equal
fingerprints. A single document is its own next one. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import give_back, small_batches, table
from riskloom.session import scratch_path

BINS = 64
#: Where null ids stand in the order.
LEAST = -(2**63)
_BASE = np.uint64(0x9E3779B97F4A7C15)
EMPTY = "0" * (4 * BINS)


class Parser:
    """The phrase dictionary of one text; it can go on with another ending from where it was marked."""

    def __init__(self) -> None:
        self.known: dict[int, int] = {}
        self.node = 0

    def mark(self) -> tuple[int, int]:
        return len(self.known), self.node

    def back(self, mark: tuple[int, int]) -> None:
        size, self.node = mark
        for _ in range(len(self.known) - size):
            self.known.popitem()

    def feed(self, data: bytes, offset: int) -> list[int]:
        """The positions of the last bytes of the phrases that end in `data`."""
        known, node, ends = self.known, self.node, []
        get, end = known.get, ends.append
        fresh = (len(known) + 1) << 8
        for at, byte in enumerate(data, offset):
            key = node + byte
            step = get(key)
            if step is None:
                known[key] = fresh
                fresh += 256
                node = 0
                end(at)
            else:
                node = step
        self.node = node
        return ends


def _powers(n: int, held: list = [np.ones(1, np.uint64)]) -> np.ndarray:  # noqa: B006 - kept per task
    if len(held[0]) < n:
        powers = np.full(max(n, 2 * len(held[0])), _BASE, np.uint64)
        powers[0] = 1
        held[0] = np.multiply.accumulate(powers)
    return held[0]


def phrase_hashes(data: bytes, ends: list[int]) -> np.ndarray:
    """A 64-bit hash of the content of each phrase; a rest after the last end is a phrase too."""
    stops = np.array(ends, np.int64) + 1
    if not len(stops) or stops[-1] < len(data):
        stops = np.append(stops, len(data))
    starts = np.concatenate(([0], stops[:-1]))
    # Polynomials of whole prefixes, read backwards so that each phrase's own is a difference shifted down.
    lengths = stops - starts
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    weighed = (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[place]
    hashes = np.add.reduceat(weighed, starts)
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0x94D049BB133111EB)
    return hashes ^ (hashes >> np.uint64(32))


def signature(hashes: np.ndarray) -> str:
    """The least hash of each of `BINS` ranges, 16 bits each, as hex; an empty range repeats its right neighbour."""
    hashes = np.unique(hashes)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    edges = np.searchsorted(hashes >> shift, np.arange(BINS + 1, dtype=np.uint64))
    filled = edges[:-1] < edges[1:]
    least = hashes[np.minimum(edges[:-1], len(hashes) - 1)]
    bins = np.flatnonzero(filled)
    source = bins[np.searchsorted(bins, np.arange(BINS)) % len(bins)]
    away = (source - np.arange(BINS)) % BINS
    values = ((least[source] >> np.uint64(32)).astype(np.uint32) + 40503 * away.astype(np.uint32)) & 0xFFFF
    return values.astype(">u2").tobytes().hex()


def likeness(left: str, right: str) -> float:
    """The share of equal values of two signatures, with chance agreement of 16-bit values taken off."""
    if EMPTY in (left, right):
        return float(left == right)
    a, b = (np.frombuffer(bytes.fromhex(x), ">u2") for x in (left, right))
    chance = 2.0**-16
    return max(0.0, (float((a == b).mean()) - chance) / (1 - chance))


def fingerprint(text: str | None) -> str:
    data = (text or "").encode()
    return signature(phrase_hashes(data, Parser().feed(data, 0))) if data else EMPTY


def edited(text: str, following: str) -> tuple[str, int]:
    """The text with its last half replaced by as much of the following one, and where the old part ends."""
    half = len(text) // 2
    cut = len(text) - half
    return text[:cut] + following[:half], cut


def both_fingerprints(text: str, following: str) -> tuple[str, str, str]:
    """The text's fingerprint, its edited text and that one's fingerprint; the common start is parsed once."""
    changed, cut = edited(text, following)
    if not text:
        return EMPTY, changed, EMPTY
    start, rest, other = text[:cut].encode(), text[cut:].encode(), changed[cut:].encode()
    parser = Parser()
    ends = parser.feed(start, 0)
    mark = parser.mark()
    first = signature(phrase_hashes(start + rest, ends + parser.feed(rest, len(start))))
    if rest == other:
        return first, changed, first
    parser.back(mark)
    return first, changed, signature(phrase_hashes(start + other, ends + parser.feed(other, len(start))))


def _judged(items: list[tuple[int | None, str, str]]) -> list[list]:
    """The result of each (id, text, following text)."""
    out = []
    for key, text, following in items:
        first, changed, second = both_fingerprints(text, following)
        out.append([key, len(text), hashlib.sha256(changed.encode()).hexdigest(), first, second, likeness(first, second)])
    for i, row in enumerate(out):
        same = i + 1 < len(out) and items[i + 1][1] == items[i][2]
        row.append(likeness(row[3], out[i + 1][3] if same else fingerprint(items[i][2])))
    return out


def in_order(docs: DataFrame, id_col: str, text_col: str, range_rows: int | None) -> DataFrame:
    """(id, text) in ranges of ids, sorted; texts of one id may be in several ranges by how they begin."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.select("id", "text", F.coalesce("id", F.lit(LEAST)).alias("place"), F.substring("text", 1, 16).alias("head"))
    keys = ["place", "head"]
    ranged = rows.repartitionByRange(max(1, -(-rows.count() // range_rows)), *keys) if range_rows else rows.repartitionByRange(*keys)
    return ranged.sortWithinPartitions("place", "text").select("id", "text")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_rows: int | None = None
) -> DataFrame:
    """One row per document: id, n_chars, fingerprint, edited_sha256, edited_fingerprint, near_edited, near_next.

    `range_rows` is the number of rows of a range; without it there are as many ranges as a shuffle has
    partitions, small ones joined.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            items, first = [], held is None
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                if held is not None:
                    items.append((*held, text))
                elif first:
                    yield _batch([], [(None, text, part, 0)])
                held, first = (key, text), False
            if items:
                yield _batch(_judged(items), [])
        if held is not None:
            yield _batch([], [(*held, part, 1)])
        held = items = batch = None  # noqa: F841
        give_back()

    def run_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, following in zip(*(column.to_pylist() for column in batch.columns)):
                yield _batch(_judged([(key, text, following)]), [])
        batch = None  # noqa: F841
        give_back()

    # Most results are written once; with them the texts at the ends of ranges, which are joined afterwards.
    path = scratch_path(docs.sparkSession, "fingerprints")
    made = in_order(docs, id_col, text_col, range_rows).mapInArrow(run, _KIND)
    made.write.option("compression", "zstd").parquet(path)
    done = docs.sparkSession.read.schema(_KIND).parquet(path)
    ends = done.where("edge IS NOT NULL").select("part", "edge", "id", "text")
    # One row for each range that has documents; the first range follows the last.
    after = F.lead("part").over(W.orderBy("part"))
    parts = ends.where("edge = 0").select("part", after.alias("next"))
    parts = parts.select("part", F.coalesce("next", ends.agg(F.min("part")).scalar()).alias("next"))
    starts = ends.where("edge = 0").select(F.col("part").alias("next"), F.col("text").alias("following"))
    last = ends.where("edge = 1").join(parts, "part").join(starts, "next").select("id", "text", "following")
    rest = last.mapInArrow(run_ends, _KIND)
    return done.where("edge IS NULL").unionByName(rest).select(*_NAMES).withColumnRenamed("id", id_col)


def _batch(rows: list[list], ends: list[tuple]) -> pa.RecordBatch:
    """Results, or texts at the ends of ranges: (id, text, part, edge)."""
    made = [[*row, None, None, None] for row in rows]
    made += [[key, *[None] * (len(_NAMES) - 1), text, part, edge] for key, text, part, edge in ends]
    columns = [pa.array(c, t) for c, t in zip(zip(*made), [*_TYPES, pa.string(), pa.int32(), pa.int32()])]
    return pa.RecordBatch.from_arrays(columns, [*_NAMES, "text", "part", "edge"])


_NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_KIND = (
    "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, text string, part int, edge int"
)


def op10_fingerprints(spark, folder: str) -> DataFrame:
    return fingerprints(table(spark, folder, "documents").select("doc_id", "text"))
