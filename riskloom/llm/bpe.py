"""Byte-level BPE encoding by corpus-level merge replay, and decoding.

The distinct words of a block of documents are laid out as one array of symbols. An inverted index
maps the rank of every present token pair to the positions where the pair stands; merges are applied
in rank order to all positions of the corpus block at once, and only the neighbours of a merged
position get new index entries. A word in which a merge makes a pair of a lower rank than the one
being applied is replayed on its own, so results equal word-by-word merging.

New words are laid out in strips of bounded bytes, so that memory grows neither with the words of a
block nor with the corpus; of the words seen before a task remembers a bounded number.

Defined cases: a null or empty text has no tokens and decodes to no bytes; special-token strings are
ordinary text; repeated rows are encoded alike; a single word longer than a strip is a strip of its own. Other
columns, whatever their names, are carried along, and a column named as the result is replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import blocks, give_back, small_batches, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
NONE = np.int32(2**31 - 1)
#: Words, and their bytes, whose encodings a task remembers before it starts afresh.
CACHE_WORDS, CACHE_BYTES = 100_000, 4 << 20
#: Bytes of new words that are replayed together, and characters of texts encoded together.
STRIP_BYTES, BLOCK_CHARS = 1 << 20, 4_000_000


class Merges:
    """A vocabulary as arrays: rank of each byte, and sorted pair keys with the rank each pair merges to."""

    def __init__(self, lines: list[bytes]):
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = [
            (ranks[left] << 32 | ranks[right], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := token[:cut]) in ranks and (right := token[cut:]) in ranks
        ]
        pairs.sort()
        self.keys = np.array([key for key, _ in pairs], np.int64)
        self.ranks = np.array([rank for _, rank in pairs], np.int32)

    @staticmethod
    def load(path: str) -> Merges:
        with open(path, "rb") as file:
            return Merges(file.read().splitlines())

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank each pair merges to, NONE where it merges to nothing."""
        if not len(self.keys):
            return np.full(len(left), NONE, np.int32)
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)


def replay(words: list[bytes], merges: Merges) -> list[bytes]:
    """The token ids of each word, as little-endian unsigned 32-bit integers."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    symbols = merges.bytes[np.frombuffer(b"".join(words), np.uint8)]
    n = len(symbols)
    ends = np.cumsum(sizes)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    filled = sizes > 0
    after[ends[filled] - 1] = -1
    before[(ends - sizes)[filled]] = -1
    alive = np.ones(n, bool)
    rank = np.full(n, NONE, np.int32)
    left = np.flatnonzero(after >= 0)
    rank[left] = merges.of(symbols[left], symbols[left + 1])

    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def note(positions: np.ndarray) -> None:
        found = rank[positions]
        order = np.argsort(found, kind="stable")
        found, positions = found[order], positions[order]
        positions = positions[: np.searchsorted(found, NONE)]
        if not len(positions):
            return
        found = found[: len(positions)]
        cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
        starts = [0, *cuts.tolist()]
        values = found[starts].tolist()
        for value, start, end in zip(values, starts, [*starts[1:], len(positions)]):
            held = index.get(value)
            if held is None:
                index[value] = [positions[start:end]]
                heapq.heappush(waiting, value)
            else:
                held.append(positions[start:end])

    note(left)
    again: set[int] = set()
    while waiting:
        now = heapq.heappop(waiting)
        held = index.pop(now)
        at = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
        at = at[rank[at] == now]
        if not len(at):
            continue
        # Overlapping occurrences stand next to each other; of such a run every second one merges.
        follows = np.zeros(len(at), bool)
        follows[1:] = before[at[1:]] == at[:-1]
        if follows.any():
            place = np.arange(len(at))
            first = np.maximum.accumulate(np.where(follows, 0, place))
            at = at[(place - first) % 2 == 0]
        right = after[at]
        beyond = after[right]
        symbols[at] = now
        after[at] = beyond
        inner = beyond >= 0
        before[beyond[inner]] = at[inner]
        alive[right] = False
        rank[right] = rank[at] = NONE
        touched = before[at]
        lead = touched >= 0
        lead_at = touched[lead]
        tail_at = at[inner]
        rank[lead_at] = merges.of(symbols[lead_at], symbols[after[lead_at]])
        rank[tail_at] = merges.of(symbols[tail_at], symbols[after[tail_at]])
        fresh = np.concatenate((lead_at, tail_at))
        lower = fresh[rank[fresh] < now]
        if len(lower):
            again.update(np.searchsorted(ends, lower, side="right").tolist())
            for word in np.unique(np.searchsorted(ends, lower, side="right")).tolist():
                rank[ends[word] - sizes[word] : ends[word]] = NONE
        note(fresh)

    data = symbols[alive].astype("<u4").tobytes()
    counts = np.concatenate(([0], np.cumsum(alive)))
    stops = counts[ends].tolist()
    starts = counts[ends - sizes].tolist()
    out = [data[4 * a : 4 * b] for a, b in zip(starts, stops)]
    for word in again:
        out[word] = replay_word(words[word], merges)
    return out


def replay_word(word: bytes, merges: Merges) -> bytes:
    """One word, always merging the leftmost pair of the lowest rank."""
    symbols = merges.bytes[np.frombuffer(word, np.uint8)].tolist()
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    known: dict[tuple[int, int], int] = {}

    def of(p: int) -> int:
        q = after[p]
        if q >= n:
            return int(NONE)
        pair = (symbols[p], symbols[q])
        if pair not in known:
            known[pair] = int(merges.of(np.array(pair[:1]), np.array(pair[1:]))[0])
        return known[pair]

    rank = [of(p) for p in range(n)]
    heap = [(r, p) for p, r in enumerate(rank) if r < NONE]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        r, p = heapq.heappop(heap)
        if not alive[p] or rank[p] != r:
            continue
        q = after[p]
        symbols[p], alive[q] = r, False
        after[p] = after[q]
        if after[p] < n:
            before[after[p]] = p
        for x in (before[p], p):
            if x >= 0:
                rank[x] = of(x)
                if rank[x] < NONE:
                    heapq.heappush(heap, (rank[x], x))
    return np.array([s for s, a in zip(symbols, alive) if a], "<u4").tobytes()


class WordCodes:
    """Encodings of words, remembered for the words seen last within bounds of number and bytes."""

    def __init__(self, merges: Merges, pattern: str):
        import regex

        self.merges, self.split = merges, regex.compile(pattern).findall
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.codes: list[bytes] = []
        self.size = 0

    def encoded(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text. New words are replayed together, in strips of bounded bytes."""
        if len(self.codes) > CACHE_WORDS or self.size > CACHE_BYTES:
            self._clear()
        rows = []
        for text in texts:
            words = self.split(text or "")
            rows.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
        strip, held = [], 0
        for word in map(str.encode, islice(self.number, len(self.codes), None)):
            if strip and held + len(word) > STRIP_BYTES:
                self.codes += replay(strip, self.merges)
                strip, held = [], 0
            strip.append(word)
            held += len(word)
            self.size += len(word)
        if strip:
            self.codes += replay(strip, self.merges)
        get = self.codes.__getitem__
        return [b"".join(map(get, row.tolist())) for row in rows]


def decoded_bytes(ids: bytes | None, tokens: dict[int, bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids: str = "ids") -> DataFrame:
    """`docs` with a binary column `ids`: the tokens as little-endian unsigned 32-bit integers."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(Merges.load(path))

    @F.arrow_udf("binary")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = WordCodes(shared.value, pattern)
        for batch in batches:
            done = [x for block in blocks(batch.to_pylist(), chars=BLOCK_CHARS) for x in words.encoded(block)]
            yield pa.array(done, pa.binary())
        words = batch = done = None  # noqa: F841
        give_back()

    return docs.withColumn(ids, encoded(text_col))


def decode(docs: DataFrame, path: str, ids: str = "ids", result: str = "decoded") -> DataFrame:
    """`docs` with a binary column `result`: the bytes that the ids stand for; null ids give no bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(Merges.load(path).tokens)

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([decoded_bytes(x.as_py(), shared.value) for x in batch], pa.binary())
        batch = None  # noqa: F841
        give_back()

    return docs.withColumn(result, decoded(ids))


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text", result: str = "coded") -> DataFrame:
    """`docs` with a struct column `result` of ids and of what they decode to, made by one worker."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(Merges.load(path))

    @F.arrow_udf("ids binary, decoded binary")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, kind = WordCodes(shared.value, pattern), [("ids", pa.binary()), ("decoded", pa.binary())]
        for batch in batches:
            ids = [x for block in blocks(batch.to_pylist(), chars=BLOCK_CHARS) for x in words.encoded(block)]
            back = [decoded_bytes(x, shared.value.tokens) for x in ids]
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(back, pa.binary())], fields=[pa.field(*f) for f in kind])
        words = batch = ids = back = None  # noqa: F841
        give_back()

    return docs.withColumn(result, coded(text_col))


def token_count(ids: str = "ids"):
    return (F.octet_length(ids) / 4).cast("long")


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id",
        token_count("coded.ids").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )
