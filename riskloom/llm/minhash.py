"""Near-duplicate documents by b-bit minimum hashes, confirmed on full shingle sets.

Each text is hashed to its set of word shingles. `HASHES` minima are taken of the set; consecutive minima
make the keys of the bands, and the low four bits of each minimum are packed into the signature.

1. Texts of equal sets, by two names of 64 bits, form one class, of which only one text goes on.
2. Classes that share a band key are candidates. The packed signatures estimate the likeness by counting
   equal values and taking off those expected by collision; what is far below the threshold goes.
3. Every class is compared with the most alike of the first members of its band keys, on full shingle
   sets. Confirmed links join classes into components.
4. Members of one band key that are still in different components are all compared the same way: few
   as pairs, many in blocks whose pairs never leave the task. Links within a component change nothing,
   so a large group of copies is never expanded into pairs.

Bands are as long as the threshold allows: a pair that just reaches it shares no band key less than
once in a million times, and the estimate passes links by five standard errors. Everything that is
linked is confirmed exactly.

Defined cases: texts with fewer words than a shingle are one shingle; a null, empty or white text has an
empty set, links with nothing and is its own component; repeated rows are copies; a null id is a
document without links whose component is null and which is kept. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import blocks, give_back, join_counted, merge_labels, small_batches, table, told_apart
from riskloom.llm.components import components
from riskloom.session import materialize

WORDS, LEAST = 5, 0.8
HASHES, BITS = 128, 4
#: How often a pair at the threshold may share no band key.
MISSED = 1e-6
#: Band keys with so many members are compared pair by pair, others in blocks.
PAIRED = 16
#: Members of a block, texts compared with a whole block at once, and shingles of one product.
BLOCK, CHUNK, STRIP = 1024, 256, 4096
#: Words a task remembers before it starts afresh.
CACHE_WORDS = 100_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


class Shingles:
    """Turns texts into sorted arrays of distinct shingle hashes."""

    def __init__(self, words: int):
        self.words = words
        self._clear()

    def _clear(self) -> None:
        self.number: dict[bytes, int] = defaultdict(count().__next__)
        self.hashes = np.zeros(0, np.uint64)

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.number) > CACHE_WORDS:
            self._clear()
        rows = []
        for text in texts:
            # Bytes split at the six ASCII white signs, and only A-Z are lower-cased.
            words = (text or "").encode().lower().split()
            rows.append(np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)))
        fresh = list(islice(self.number, len(self.hashes), None))
        added = np.fromiter((xxhash.xxh3_64_intdigest(word) for word in fresh), np.uint64, len(fresh))
        self.hashes = np.concatenate((self.hashes, added))
        return [self._set(self.hashes[row]) for row in rows]

    def _set(self, words: np.ndarray) -> np.ndarray:
        size = min(self.words, len(words))
        if not size:
            return np.zeros(0, np.uint64)
        total = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            total = _mixed(total * _ODD + words[i : len(words) - size + 1 + i])
        return np.unique(total)


def band_rows(least: float) -> int:
    """The most minima of a band at which a pair of this likeness is missed no more often than MISSED."""
    return max(rows for rows in range(1, 17) if rows == 1 or (1 - least**rows) ** (HASHES // rows) <= MISSED)


def prints(sets: list[np.ndarray], rows: int) -> list[dict]:
    """Size, two 64-bit names of the set, band keys of `rows` minima each, and packed signature of each set."""
    bands = HASHES // rows
    rng = np.random.default_rng(5)
    salts, factors = rng.integers(0, 2**64, (2, HASHES), np.uint64)
    factors |= np.uint64(1)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    filled = np.flatnonzero(sizes)
    out = [{"n": int(n), "node": None, "other": None, "bands": [], "sig": None} for n in sizes.tolist()]
    if not len(filled):
        return out
    flat = np.concatenate([sets[i] for i in filled.tolist()])
    starts = np.cumsum(sizes[filled]) - sizes[filled]
    least = np.empty((HASHES, len(filled)), np.uint64)
    for k in range(HASHES):
        least[k] = np.minimum.reduceat((flat ^ salts[k]) * factors[k], starts)
    names, others = (
        _mixed(np.add.reduceat(_mixed(flat ^ salt), starts) + sizes[filled].astype(np.uint64)) for salt in (np.uint64(0), _ODD)
    )
    keys = np.empty((bands, len(filled)), np.uint64)
    for band in range(bands):
        key = np.full(len(filled), band + 1, np.uint64)
        for row in least[band * rows : (band + 1) * rows]:
            key = _mixed(key * _ODD + row)
        keys[band] = key
    # The top bits are the well-mixed ones of a product.
    low = (_mixed(least) >> np.uint64(64 - BITS)).astype(np.uint64).reshape(HASHES // 16, 16, len(filled))
    packed = np.bitwise_or.reduce(low << (np.arange(16, dtype=np.uint64) * np.uint64(BITS))[None, :, None], axis=1)
    keys, packed = keys.T.astype(np.int64).tolist(), packed.T.astype(np.int64).tolist()
    names, others = names.astype(np.int64).tolist(), others.astype(np.int64).tolist()
    for i, at in enumerate(filled.tolist()):
        out[at].update(node=names[i], other=others[i], bands=keys[i], sig=packed[i])
    return out


def likeness(a: str, b: str) -> Column:
    """The likeness that two packed signatures let expect: equal values, less those equal by collision."""
    same = F.lit(HASHES)
    ones = int("1" * 16, 16)
    for i in range(HASHES // 16):
        odd = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        spread = odd.bitwiseOR(F.shiftrightunsigned(odd, 1)).bitwiseOR(F.shiftrightunsigned(odd, 2)).bitwiseOR(F.shiftrightunsigned(odd, 3))
        same = same - F.bit_count(spread.bitwiseAND(F.lit(ones)))
    chance = 2.0**-BITS
    return (same / HASHES - chance) / (1 - chance)


def passing(least: float) -> float:
    """The estimate that a pair at the threshold falls below once in three million times."""
    chance = 2.0**-BITS
    same = chance + (1 - chance) * least
    return least - 5 * (same * (1 - same) / HASHES) ** 0.5 / (1 - chance)


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, least: tuple[int, int]) -> DataFrame:
    """Those of `pairs` (a, b) whose full shingle sets are alike enough; `texts` has (node, text)."""
    up, down = least

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, last, last_set = Shingles(words), None, None
        for batch in batches:
            good = []
            columns = [batch.column(name).to_pylist() for name in ("b", "text_a", "text_b")]
            for b, text_a, text_b in zip(*columns):
                if b != last:
                    last, last_set = b, made.of([text_b])[0]
                mine = made.of([text_a])[0]
                both = len(np.intersect1d(mine, last_set, assume_unique=True))
                good.append(both * down >= up * (len(mine) + len(last_set) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))
        made = last_set = batch = columns = None  # noqa: F841
        give_back()

    one = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    two = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return two.select("a", "b", "text_a", "text_b").mapInArrow(check, "a bigint, b bigint")


def estimates(sigs: np.ndarray, other: np.ndarray) -> np.ndarray:
    """`likeness` of each row of `sigs` with each row of `other`."""
    same = np.full((len(sigs), len(other)), HASHES, np.int32)
    ones = np.uint64(int("1" * 16, 16))
    for left, right in zip(sigs.T, other.T):
        odd = left[:, None] ^ right[None, :]
        spread = odd | odd >> np.uint64(1) | odd >> np.uint64(2) | odd >> np.uint64(3)
        same -= np.bitwise_count(spread & ones)
    chance = 2.0**-BITS
    return (same / HASHES - chance) / (1 - chance)


def intersections(sets: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of `sets` shares with each of `other`."""
    sizes, other_sizes = ([len(x) for x in group] for group in (sets, other))
    kinds, place = np.unique(np.concatenate([*sets, *other]), return_inverse=True)
    # Only shingles of several texts can be shared; they are counted by products of 0/1 strips.
    often = np.flatnonzero(np.bincount(place, minlength=len(kinds)) > 1)
    column = np.full(len(kinds), -1)
    column[often] = np.arange(len(often))
    column = column[place]
    row = np.repeat(np.arange(len(sets) + len(other)), [*sizes, *other_sizes])
    shared = np.zeros((len(sets), len(other)), np.float32)
    for start in range(0, len(often), STRIP):
        here = np.flatnonzero((column >= start) & (column < start + STRIP))
        strip = np.zeros((len(sets) + len(other), min(STRIP, len(often) - start)), np.float32)
        strip[row[here], column[here] - start] = 1
        shared += strip[: len(sets)] @ strip[len(sets) :].T
    return shared


def confirmed_in_blocks(members: DataFrame, texts: DataFrame, words: int, least: tuple[int, int]) -> DataFrame:
    """Links (a, b) that join different components within a band key, for keys with many members.

    A key's members are dealt to blocks and every pair of blocks is one group. A group compares its
    texts by products of 0/1 matrices and returns a spanning forest of the components it joins.
    """
    up, down = least
    bound = passing(up / down)
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.col("node"), n_blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda x: F.struct(F.least(x, mine).alias("i"), F.greatest(x, mine).alias("j")))
    dealt = members.select("key", "node", "component", "n", "sig", mine.alias("block"), F.explode(pairs).alias("to"))
    dealt = dealt.join(texts, "node").select("key", "to.i", "to.j", "block", "node", "component", "n", "sig", "text")

    def check(group: pa.Table) -> pa.Table:
        column = {name: group.column(name).to_numpy(zero_copy_only=False) for name in ("i", "j", "block", "node", "component", "n")}
        sig = np.stack(group.column("sig").to_pylist()).astype(np.int64).astype(np.uint64)
        left, right = np.flatnonzero(column["block"] == column["i"]), np.flatnonzero(column["block"] == column["j"])
        names, part = np.unique(column["component"], return_inverse=True)
        n, out = column["n"], ([], [])
        if len(left) and len(right) and len(names) > 1:
            sets = Shingles(words).of(group.column("text").to_pylist())
            label = np.arange(len(names))
            for start in range(0, len(left), CHUNK):
                some = left[start : start + CHUNK]
                small, large = np.minimum(n[some][:, None], n[right]), np.maximum(n[some][:, None], n[right])
                likely = (part[some][:, None] != part[right]) & (small * down >= large * up)
                likely &= estimates(sig[some], sig[right]) >= bound
                rows, columns = np.flatnonzero(likely.any(axis=1)), np.flatnonzero(likely.any(axis=0))
                if not len(rows):
                    continue
                both = intersections([sets[k] for k in some[rows]], [sets[k] for k in right[columns]])
                union = n[some[rows]][:, None] + n[right[columns]] - both
                a, b = np.nonzero(likely[np.ix_(rows, columns)] & (both * down >= up * union))
                if len(a):
                    merge_labels(label, part[some[rows[a]]], part[right[columns[b]]])
            moved = np.flatnonzero(label != np.arange(len(label)))
            out = names[moved], names[label[moved]]
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    return dealt.groupBy("key", "i", "j").applyInArrow(check, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    least: tuple[int, int] = (round(100 * LEAST), 100),
) -> DataFrame:
    """(id, n_shingles, component_id, kept, mark, first), one row for each row of `docs`.

    `mark` is a hash of the text, by which rows of equal ids are told apart, and `first` is true of the rows with
    the least id and mark of their component, which are equal rows. Documents are linked whose shingle sets have an intersection of at least least[0] / least[1] of their union.
    """
    small_batches(docs.sparkSession)
    bound = passing(least[0] / least[1])
    band = band_rows(least[0] / least[1])

    @F.arrow_udf("n bigint, node bigint, other bigint, bands array<bigint>, sig array<bigint>")
    def printed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = Shingles(words)
        names = [(name, pa.int64()) for name in ("n", "node", "other")]
        kind = pa.struct([*names, ("bands", pa.list_(pa.int64())), ("sig", pa.list_(pa.int64()))])
        for batch in batches:
            done = [row for block in blocks(batch.to_pylist(), chars=1_000_000) for row in prints(made.of(block), band)]
            yield pa.array(done, kind)
        made = batch = done = None  # noqa: F841
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("mark"), printed("text").alias("p")).select("id", "mark", "p.*")
    rows = told_apart(materialize(rows, "prints"))
    usable = F.col("node").isNotNull() & F.col("id").isNotNull()
    grouped = rows.where(usable).groupBy("node").agg(
        F.min(F.struct("id", "mark")).alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.count("*").alias("count")
    )
    classes = materialize(grouped, "print-classes")
    banded = classes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("count")).where("count > 1")
    shared = materialize(shared, "bands")
    members = join_counted(banded, shared, "key", classes.count() * (HASHES // band)).select("key", "node", "hub")
    members = materialize(members, "band-members")

    involved = members.select("node").distinct().join(classes.select("node", "first", "n", "sig"), "node")
    involved = materialize(involved, "involved")
    wanted = involved.select("node", F.col("first.id").alias("id"), F.col("first.mark").alias("mark"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))
    texts = texts.join(wanted, ["id", "mark"]).groupBy("node").agg(F.first("text").alias("text"))
    texts = materialize(texts, "involved-texts")

    light = involved.select("node", "n", "sig")
    left, right = (light.select(*[F.col(c).alias(f"{c}_{side}") for c in light.columns]) for side in "ab")

    def alike(pairs: DataFrame) -> DataFrame:
        """(a, b, about): pairs of nodes whose sizes and signatures allow a link."""
        both = pairs.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))
        sized = F.least("n_a", "n_b") * least[1] >= F.greatest("n_a", "n_b") * least[0]
        return both.where(sized).select("a", "b", likeness("sig_a", "sig_b").alias("about")).where(F.col("about") >= bound)

    first_pairs = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    best = alike(first_pairs).groupBy("a").agg(F.max_by("b", F.struct("about", "b")).alias("b"))
    links = materialize(confirmed(best, texts, words, least), "links")
    named = components(links)

    placed = members.select("key", "node").join(named, "node", "left")
    placed = placed.select("key", "node", F.coalesce("component", "node").alias("component"))
    open_keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    placed = placed.join(open_keys.where("low <> high").select("key", "size"), "key").join(light, "node")
    placed = materialize(placed, "open-bands")
    few, many = placed.where(F.col("size") <= PAIRED), placed.where(F.col("size") > PAIRED)
    one, two = (few.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "component", "n", "sig")]) for side in "ab")
    sized = F.least("n_a", "n_b") * least[1] >= F.greatest("n_a", "n_b") * least[0]
    unlike = (F.col("component_a") < F.col("component_b")) & sized & (likeness("sig_a", "sig_b") >= bound)
    rest = one.join(two, (one.key == two.key) & unlike).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    more = confirmed(rest, texts, words, least).unionByName(confirmed_in_blocks(many, texts, words, least))
    more = materialize(more, "links")
    # The first links hang together through their components.
    named = components(named.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    done = classes.select("node", "first", "count").join(named, "node", "left")
    done = materialize(done.withColumn("component", F.coalesce("component", "node")), "class-components")
    lowest = done.groupBy("component").agg(F.min("first").alias("lowest"), F.count("*").alias("count"))
    total = classes.count()
    final = join_counted(done.select("node", "component", F.col("count").alias("size")), lowest, "component", total)
    final = materialize(final.select("node", "lowest", F.col("size").alias("count")), "class-lowest")
    linked = join_counted(rows.where(usable).select("id", "n", "mark", "node"), final, "node", rows.count())
    linked = linked.select("id", "n", "mark", F.col("lowest.id").alias("component_id"), (F.struct("id", "mark") == F.col("lowest")).alias("first"))
    alone = rows.where(~usable).select("id", "n", "mark", F.col("id").alias("component_id"), F.lit(True).alias("first"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"), "mark", "first"
    )


def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), words=3, least=(85, 100))
    return found.drop("mark", "first")


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
members AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM members a JOIN members b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sets sa ON sa.doc_id = a JOIN sets sb ON sb.doc_id = b
  WHERE 100 * n >= 85 * (len(sa.s) + len(sb.s) - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON a = other)
SELECT doc_id, len(s)::BIGINT AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM sets JOIN reach USING (doc_id) GROUP BY doc_id, s
"""
