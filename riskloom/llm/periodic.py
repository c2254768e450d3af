"""Periodic runs of words, found on a grammar of the texts.

A run is a stretch of words with smallest period q that holds at least `PERIODS` periods and
`MIN_WORDS` words and that no neighbouring word extends. Words are maximal stretches of other
characters than ASCII white space.

Method, for a block of documents at a time (a document is never cut):

1. Re-Pair: words become numbers, and pairs of neighbouring symbols that occur twice or more are
   replaced by nonterminals, the more frequent of overlapping pairs first, until no pair occurs twice.
   What remains of each document is paired off into a balanced tree.
2. Each nonterminal is a left and a right part. Of the runs inside its expansion, those that cross the
   boundary of the parts are computed once. Such a run has two periods on one side of the boundary, so
   that a square starts or ends there: its periods are found from equal word triples, the next ones by
   binary search in an index of triples, and multiples of a known period are leapt over.
3. The runs of a nonterminal are moved to every place where the derivation of the documents uses it. Each
   run of a text is whole in the smallest nonterminal that holds it; shorter views of it come from
   nonterminals inside. Stretches of one period that overlap by a period are merged.

Memory of a task is bounded by `BLOCK_CHARS`, or by its longest document (about 60 bytes for each character).

Defined cases: a null, empty or white text has no words, no runs and an empty collapsed text; repeated
rows are treated alike; the text and all other columns, whatever their names, are carried along
untouched, and a column named as the result is replaced.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import CRC32_SQL, blocks, small_batches, table, text_udf

#: A run has at least so many periods and so many words.
PERIODS, MIN_WORDS = 4, 6
#: Documents of a block, by rows and characters; a longer one is a block of its own.
BLOCK_ROWS, BLOCK_CHARS = 2000, 2_000_000
_RESULT = pa.struct([
    ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed", pa.string()),
])


def re_pair(text: np.ndarray, n_words: int):
    """Grammar of a sequence of word numbers; negative numbers are separators and stay alone.

    Returns the remaining symbols and their places, the size of every symbol, for every nonterminal its
    two parts and one place of the text, and the bounds of the rounds in which they were made.
    """
    symbols, places = text.copy(), np.arange(len(text))
    sizes, parts, homes = [np.ones(n_words, np.int64)], [], []
    known_keys, known_names = np.zeros(0, np.int64), np.zeros(0, np.int64)
    rounds, total = [0], n_words
    size = sizes[0]
    while len(symbols) > 1:
        keys = symbols[:-1] << 32 | symbols[1:]
        keys[(symbols[:-1] < 0) | (symbols[1:] < 0)] = -1
        found, pair, often = np.unique(keys, return_inverse=True, return_counts=True)
        often[found < 0] = 0
        if often.max() < 2:
            break
        # Rank of each pair: frequent ones first, none for pairs that occur once.
        rank = np.zeros(len(found), np.int64)
        many = np.flatnonzero(often >= 2)
        rank[many[np.argsort(often[many], kind="stable")]] = np.arange(1, len(many) + 1)
        own = rank[pair]
        before, after = np.concatenate(([0], own[:-1])), np.concatenate((own[1:], [0]))
        # Of a repeated symbol every second occurrence counts, from the start of the repetition.
        at = np.arange(len(own))
        first = np.maximum.accumulate(np.where(own != before, at, 0))
        take = np.flatnonzero((own > 0) & (own >= before) & (own >= after) & ((at - first) % 2 == 0))
        used, which, one = np.unique(pair[take], return_index=True, return_inverse=True)[:3]
        used_keys = found[used]
        # A pair that an earlier round named keeps its name.
        spot = np.searchsorted(known_keys, used_keys)
        spot_in = np.minimum(spot, max(len(known_keys) - 1, 0))
        old = known_keys[spot_in] == used_keys if len(known_keys) else np.zeros(len(used), bool)
        names = np.empty(len(used), np.int64)
        names[old] = known_names[spot_in[old]]
        names[~old] = total + np.arange((~old).sum())
        total += int((~old).sum())
        left, right = used_keys[~old] >> 32, used_keys[~old] & 0xFFFFFFFF
        parts.append(np.stack((left, right)))
        homes.append(places[take[which[~old]]])
        size = np.concatenate((size, size[left] + size[right]))
        rounds.append(total - n_words)
        merged = np.concatenate((known_keys, used_keys[~old]))
        order = np.argsort(merged)
        known_keys, known_names = merged[order], np.concatenate((known_names, names[~old]))[order]
        symbols[take] = names[one]
        keep = np.ones(len(symbols), bool)
        keep[take + 1] = False
        symbols, places = symbols[keep], places[keep]
    if parts:
        return symbols, places, size, np.concatenate(parts, 1), np.concatenate(homes), rounds
    return symbols, places, size, np.zeros((2, 0), np.int64), np.zeros(0, np.int64), rounds


def _tree(symbols: np.ndarray, places: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, boundary and end of the nodes of balanced trees over the symbols between separators."""
    word = symbols >= 0
    lo, hi = places[word], places[word] + size[symbols[word]]
    tree = np.cumsum(~word)[word]
    found = []
    while len(lo):
        first = np.concatenate(([True], tree[1:] != tree[:-1]))
        at = np.arange(len(lo))
        offset = at - np.maximum.accumulate(np.where(first, at, 0))
        head = np.flatnonzero(offset % 2 == 0)
        mate = np.minimum(head + 1, len(lo) - 1)
        paired = (head + 1 < len(lo)) & (tree[mate] == tree[head])
        if not paired.any():
            break
        found.append((lo[head[paired]], lo[mate[paired]], hi[mate[paired]]))
        hi_new = np.where(paired, hi[mate], hi[head])
        lo, hi, tree = lo[head], hi_new, tree[head]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _agree(text: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words from i and from j on are equal, up to `most`."""
    out = np.zeros(len(i), np.int64)
    live, width = np.flatnonzero(most > 0), 4
    while len(live):
        going, step, off = [], max(1, 500_000 // width), np.arange(width)
        for part in (live[k : k + step] for k in range(0, len(live), step)):
            reach = out[part, None] + off
            inside = reach < most[part, None]
            reach = np.where(inside, reach, 0)
            same = inside & (text[i[part, None] + reach] == text[j[part, None] + reach])
            n = np.where(same.all(1), width, np.argmin(same, 1))
            out[part] += n
            going.append(part[n == width])
        live, width = np.concatenate(going), min(2 * width, 4096)
    return out


class _Triples:
    """Where each triple of neighbouring words stands."""

    def __init__(self, text: np.ndarray):
        n = max(len(text) - 2, 0)
        mixed = text[:n] * 0x9E3779B1 + text[1 : n + 1]
        mixed = (mixed ^ (mixed >> 29)) * 0x1CE4E5B9 + text[2 : n + 2]
        order = np.argsort(mixed, kind="stable")
        new = np.concatenate(([0], np.cumsum(mixed[order][1:] != mixed[order][:-1]))) if n else np.zeros(0, np.int64)
        self.name = np.empty(n, np.int64)
        self.name[order] = new
        self.span = n + 1
        self.index = new * self.span + order

    def following(self, of: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place at or after `least` of the triple at `of`, or a place beyond all."""
        if not len(self.name):
            return np.full(len(of), 1 << 60)
        start = self.name[of] * self.span
        at = np.searchsorted(self.index, start + np.minimum(least, self.span - 1))
        found = self.index[np.minimum(at, len(self.index) - 1)] - start
        return np.where((at < len(self.index)) & (found < self.span), found, 1 << 60)


def _squares(text: np.ndarray, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray):
    """(node, period, start, end): stretches inside [lo, hi) in which a square starts at the boundary."""
    node, limit, least = np.arange(len(mid)), mid + (hi - mid) // 2, mid + 1
    found = []

    def settle(of: np.ndarray, period: np.ndarray) -> None:
        right = _agree(text, mid[of], mid[of] + period, hi[of] - mid[of] - period)
        square = right >= period
        hit, q, f = of[square], period[square], right[square]
        backwards, end = text[::-1], len(text)
        g = _agree(backwards, end - mid[hit], end - mid[hit] - q, mid[hit] - lo[hit])
        found.append((hit, q, mid[hit] - g, mid[hit] + q + f))
        least[of] = mid[of] + period + 1
        # Squares inside a stretch of period q have multiples of q as periods.
        least[hit] = np.maximum(least[hit], mid[hit] + (q + f) // 2 + 1)

    # Periods of one and two words are shorter than a triple.
    for short in (1, 2):
        of = node[(mid + short <= limit) & (least <= mid + short)]
        of = of[text[mid[of]] == text[mid[of] + short]]
        if len(of):
            settle(of, np.full(len(of), short))
    least = np.maximum(least, mid + 3)
    triples = _Triples(text)
    node = node[least <= limit]
    while len(node):
        place = triples.following(mid[node], least[node])
        near = place <= limit[node]
        node, place = node[near], place[near]
        if not len(node):
            break
        settle(node, place - mid[node])
        node = node[least[node] <= limit[node]]
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found))


def crossing_runs(text: np.ndarray, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray):
    """(node, start, end, period) of the runs inside [lo, hi) across `mid`, by nodes."""
    n = len(text)
    right = _squares(text, lo, mid, hi)
    left = _squares(np.ascontiguousarray(text[::-1]), n - hi, n - mid, n - lo)
    node = np.concatenate((right[0], left[0]))
    period = np.concatenate((right[1], left[1]))
    start = np.concatenate((right[2], n - left[3]))
    end = np.concatenate((right[3], n - left[2]))
    order = np.lexsort((period, end, start, node))
    node, start, end, period = node[order], start[order], end[order], period[order]
    # Of one stretch the smallest period counts.
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    new &= end - start >= np.maximum(MIN_WORDS, PERIODS * period)
    return node[new], start[new], end[new], period[new]


def all_runs(text: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of a sequence with separators, by start."""
    symbols, places, size, parts, homes, rounds = re_pair(text, n_words)
    left_size = size[parts[0]]
    whole = size[n_words:]
    tops = _tree(symbols, places, size)
    n_rules = len(homes)
    node, start, end, period = crossing_runs(
        text,
        np.concatenate((homes, tops[0])),
        np.concatenate((homes + left_size, tops[1])),
        np.concatenate((homes + whole, tops[2])),
    )
    of_rule = node < n_rules
    starts, ends, periods = [start[~of_rule]], [end[~of_rule]], [period[~of_rule]]
    node, start, end, period = node[of_rule], start[of_rule], end[of_rule], period[of_rule]
    first = np.searchsorted(node, np.arange(n_rules))
    amount = np.searchsorted(node, np.arange(n_rules), side="right") - first
    # Which symbols have runs, themselves or in a part.
    bears = np.zeros(n_words + n_rules + 1, bool)
    for a, b in zip(rounds, rounds[1:]):
        bears[n_words + a : n_words + b] = (amount[a:b] > 0) | bears[parts[0, a:b]] | bears[parts[1, a:b]]
    use = (symbols >= 0) & bears[np.maximum(symbols, 0)]
    symbol, place = symbols[use], places[use]
    while len(symbol):
        rule = symbol - n_words
        each = amount[rule]
        row = np.repeat(first[rule], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        shift = np.repeat(place - homes[rule], each)
        starts.append(start[row] + shift)
        ends.append(end[row] + shift)
        periods.append(period[row])
        symbol = np.concatenate((parts[0, rule], parts[1, rule]))
        place = np.concatenate((place, place + left_size[rule]))
        symbol, place = symbol[bears[symbol]], place[bears[symbol]]
    return _merged(np.concatenate(starts), np.concatenate(ends), np.concatenate(periods))


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray):
    """Maximal stretches: those of one period that overlap by a period are one."""
    if not len(start):
        return start, end, period
    order = np.lexsort((start, period))
    start, end, period = start[order], end[order], period[order]
    group = np.cumsum(np.concatenate(([0], period[1:] != period[:-1])))
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * span) - group * span
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] > reach[:-1] - period[1:])
    heads = np.flatnonzero(new)
    last = np.concatenate((heads[1:], [len(start)])) - 1
    start, end, period = start[heads], reach[last], period[heads]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def block_runs(texts: list[str | None]) -> list[dict]:
    """n_words, runs and collapsed text of each text of a block."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    words = [(text or "").encode().split() for text in texts]
    pieces = []
    for i, row in enumerate(words):
        pieces += [np.fromiter(map(number.__getitem__, row), np.int64, len(row)), np.array([-1 - i])]
    text = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
    pieces = None
    start, end, period = all_runs(text, len(number))
    dropped = np.zeros(len(text) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, end, -1)
    dropped = np.cumsum(dropped) > 0
    out, base = [], 0
    for row in words:
        a, b = np.searchsorted(start, [base, base + len(row) + 1])
        kept = row
        if a < b:
            kept = [word for word, gone in zip(row, dropped[base : base + len(row)].tolist()) if not gone]
        runs = zip((start[a:b] - base).tolist(), (end[a:b] - start[a:b]).tolist(), period[a:b].tolist())
        out.append({
            "n_words": len(row),
            "runs": [{"start": s, "length": n, "period": q} for s, n, q in runs],
            "collapsed": b" ".join(kept).decode(),
        })
        base += len(row) + 1
    return out


def periodic_runs(docs: DataFrame, text_col: str = "text", result: str = "periodic") -> DataFrame:
    """`docs` with a struct column `result`: n_words, runs (start, length and period, by start and period) and
    collapsed, the words outside all runs and in the first period of those they are in, joined by a space."""
    small_batches(docs.sparkSession)

    def prepare():
        def run(texts):
            return [row for block in blocks(texts, BLOCK_ROWS, BLOCK_CHARS) for row in block_runs(block)]

        return run

    kind = "n_words bigint, runs array<struct<start bigint, length bigint, period bigint>>, collapsed string"
    return docs.withColumn(result, text_udf(f"struct<{kind}>", _RESULT, prepare)(text_col))


def planted(docs: DataFrame) -> DataFrame:
    """`docs` with the words of every tenth document, by the check sum of its id, repeated periodically."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", "text", h.alias("h"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g, n, at = F.floor(F.col("h") / 10), F.size("words"), F.col("first")
    period = 1 + F.floor((n - at) / (3 + g % 8))
    texts = docs.withColumn("words", F.when((F.col("h") % 10 == 0), F.coalesce(words, F.array())))
    texts = texts.withColumn("first", F.when(F.size("words") > 0, g % n)).withColumn("again", F.when(n > 0, period))
    repeated = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get("words", F.when(i < at, i).otherwise(at + (i - at) % F.col("again")).cast("int")),
    )
    text = F.when(F.col("first").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text"))
    return texts.select("doc_id", text.alias("text"))


def op11_periodic(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, folder, "documents"))).select("doc_id", "periodic.*")
    order = F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("q")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    longest = found.withColumn("longest", F.array_max(order))
    length, period = F.col("longest.length"), -F.col("longest.q")
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


ORACLE = rf"""
WITH docs AS (
  SELECT doc_id, {CRC32_SQL.format(text="cast(doc_id AS VARCHAR)")} AS h,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
sized AS (SELECT *, len(ws) AS n, h // 10 AS g FROM docs),
placed AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM sized),
texts AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN ws ELSE
    list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS ws
  FROM placed),
words AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(n)) AS i FROM texts),
triples AS (
  SELECT doc_id, i, hash(w, lead(w) OVER d, lead(w, 2) OVER d) AS t, lead(w, 2) OVER d AS third
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
equal AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM triples x JOIN triples y ON x.doc_id = y.doc_id AND x.t = y.t AND x.i < y.i
  WHERE x.third IS NOT NULL AND y.third IS NOT NULL),
islands AS (
  SELECT doc_id, q, min(i) AS s, count(*) + 2 + q AS n
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal)
  GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, s, n, min(q) AS q FROM islands WHERE n >= greatest(6, 4 * q) GROUP BY doc_id, s, n),
digests AS (
  SELECT doc_id, count(*) AS n_runs, arg_max({{'s': s, 'n': n, 'q': q}}, [n, -s, -q]) AS longest,
         string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines
  FROM runs GROUP BY doc_id),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM runs),
collapsed AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, longest.s AS start, longest.n AS length, longest.q AS period,
       (1000 * longest.n) // longest.q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM texts LEFT JOIN digests USING (doc_id) LEFT JOIN collapsed USING (doc_id)
"""
