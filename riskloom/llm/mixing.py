"""Mixing sources to target weights with a low-discrepancy schedule.

Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share all words of the corpus by
weight; no target exceeds `MOST` times its source's size, and what is above is shared again by weight.

Schedule: slot i of `SLOTS`, or of one for each `SLOT_WORDS` words if that is more, takes the golden-ratio point frac((i + 1/2) * PHI), and the point's place
among the cumulative targets is the slot's source. A source's slots are ranked. Its documents, in the
order of a hash, make one stream of words, repeated up to `MOST` times; the target's length of it is cut
into as many blocks of equal words as the source has slots, and the slot of rank r takes block r. So
any stretch of slots holds the sources in their shares, and the taken words equal the targets but for
rounding to whole words. A source too light for a point of its own gets one slot at the end.

Words before each document are summed in two levels, over buckets of the hash and within each bucket,
so that a source of any size is spread over many tasks.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source of its
own, after all others; equal ids are ordered by text, and equal rows are taken one after the other; an
empty table gives an empty mix; extra columns do not matter. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import join_counted, table
from riskloom.session import materialize

WEIGHTS = (5, 2, 1)
#: How often a source's words may be repeated.
MOST = 3
SLOTS, SLOT_WORDS = 1 << 16, 1_000_000
#: Bins of the unit interval in which points meet sources, and slots that are ranked together.
BINS, STRETCH = 1 << 12, 1 << 12
#: Documents that one bucket of a source is meant to hold.
BUCKET_ROWS = 20_000
PHI = 0.6180339887498949
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized_documents(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Stored (id, source, size, mixed, mark): sizes, the hash that shuffles, and one that tells texts apart."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(text_col).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).alias("mixed"),
        F.xxhash64(text_col).alias("mark"),
    )
    return materialize(rows, "sized-documents")


def targets(sized: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, place, source_size, n_docs, target), one row for each source.

    Sources by rising ratio of limit to weight are the order in which they reach their limits. The
    windows run over the sources, not over documents.
    """
    found = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    by_name = Window.partitionBy().orderBy(F.asc_nulls_last("source"))
    found = found.withColumn("place", F.row_number().over(by_name) - 1)
    cycle = F.array(*[F.lit(w) for w in weights])
    found = found.withColumn("weight", cycle[F.col("place") % len(weights)]).withColumn("limit", F.col("source_size") * most)
    by_ratio = Window.partitionBy().orderBy(F.col("limit") / F.col("weight"), "place")
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    heavy = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # What a unit of weight gets if all earlier sources are at their limits.
    found = found.withColumn("order", F.row_number().over(by_ratio)).withColumn("unit", left / heavy)
    free = F.col("limit") > F.col("unit") * F.col("weight")
    first = F.min(F.when(free, F.struct("order", "unit"))).over(whole)
    target = F.when(F.col("order") < first["order"], F.col("limit").cast("double")).otherwise(first["unit"] * F.col("weight"))
    return found.select("source", "place", "source_size", "n_docs", F.coalesce(target, F.col("limit").cast("double")).alias("target"))


def schedule(wanted: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(slot, place, rank): the source of each slot and the slot's rank among the source's slots.

    Points and the stretches of the cumulative targets meet in bins of the unit interval; a bin holds the
    few sources whose stretches touch it. Slots are ranked inside runs of `STRETCH` slots and runs are added
    up per source, so that no task holds all slots or all of a source's.
    """
    spark = wanted.sparkSession
    by_place = Window.partitionBy().orderBy("place")
    edges = wanted.where("target > 0").withColumn("upto", F.sum("target").over(by_place))
    whole = F.sum("target").over(Window.partitionBy())
    edges = edges.select("place", ((F.col("upto") - F.col("target")) / whole).alias("low"))
    # A stretch ends where the next one starts, and the last one after every point.
    edges = edges.withColumn("high", F.coalesce(F.lead("low").over(by_place), F.lit(2.0)))
    bin_of = lambda point: F.least(F.floor(point * BINS), F.lit(BINS - 1))
    edges = edges.withColumn("bin", F.explode(F.sequence(bin_of(F.col("low")), bin_of(F.col("high")))))
    turn = (F.col("id") + 0.5) * PHI
    points = spark.range(slots).select(F.col("id").alias("slot"), (turn - F.floor(turn)).alias("point")).withColumn("bin", bin_of(F.col("point")))
    given = points.join(edges, "bin").where((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))).select("slot", "place")
    given = materialize(given, "mixture-slots")
    bare = wanted.where("target > 0").join(given.select("place").distinct(), "place", "left_anti")
    given = given.unionByName(bare.select((F.lit(slots) + F.col("place")).cast("long").alias("slot"), "place"))
    given = given.withColumn("stretch", F.expr(f"slot div {STRETCH}"))
    counts = given.groupBy("place", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("place").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("place", "stretch", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("place", "stretch").orderBy("slot")) - 1
    ranked = given.withColumn("inside", inside).join(counts, ["place", "stretch"])
    return ranked.select("slot", "place", (F.col("before") + F.col("inside")).alias("rank"))


def slots_for(words: int, slots: int) -> int:
    """At least `slots`, and so many that a slot's words do not grow with the corpus."""
    return max(slots, -(-words // SLOT_WORDS))


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    most: int = MOST,
    slots: int = SLOTS,
) -> DataFrame:
    """A row for each document: id, source, mark, size, source_size, target, taken and first_slot.

    `taken` counts the words that the mix takes, repeats included; `first_slot` is null if none.
    """
    sized = sized_documents(docs, id_col, text_col, source_col)
    wanted = materialize(targets(sized, weights, most), "mixture-targets")
    words = wanted.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    given = materialize(schedule(wanted, slots_for(words, slots)), "mixture-schedule")
    counts = given.groupBy("place").agg(F.count("*").alias("n_slots"))
    plan = wanted.join(counts, "place", "left").withColumn("n_slots", F.coalesce("n_slots", F.lit(0)))
    # Words the mix takes of each source, and buckets that its documents are spread over.
    plan = plan.withColumn("words", F.round("target").cast("long")).withColumn("buckets", F.ceil(F.col("n_docs") / BUCKET_ROWS))
    plan = materialize(plan, "mixture-plan")

    # Sources with very many documents, of which there are few, are joined without a shuffle.
    key = F.struct(F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none"))
    counted = plan.withColumn("key", key).drop("source").withColumnRenamed("n_docs", "count")
    rows = join_counted(sized.withColumn("key", key), counted, "key", sized.count()).drop("key", "count")
    part = F.conv(F.substring("mixed", 1, 8), 16, 10).cast("long")
    # Buckets are ranges of the hash, so their order is the order of the stream.
    rows = rows.withColumn("bucket", F.floor(part * F.col("buckets") / F.lit(1 << 32)))
    held = rows.groupBy("place", "bucket").agg(F.sum("size").alias("bucket_size"), F.count("*").alias("bucket_rows"))
    earlier = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        "place", "bucket",
        F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("bucket_rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    within = Window.partitionBy("place", "bucket").orderBy("mixed", "id", "mark", "size")
    rows = rows.withColumn("own_end", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("own_row", F.row_number().over(within))
    rows = rows.join(held, ["place", "bucket"]).withColumn("start", F.col("words_before") + F.col("own_end") - F.col("size"))
    rows = rows.withColumn("row", F.col("rows_before") + F.col("own_row"))

    # Blocks [floor(r W / k), floor((r + 1) W / k)) of the W words of a source with k slots.
    epochs = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda e: F.col("start") + e * F.col("source_size"))
    rows = rows.withColumn("from", F.explode(epochs)).withColumn("upto", F.least(F.col("from") + F.col("size"), F.col("words")))
    # A document without words in this repeat keeps one row that no block matches.
    some = (F.col("size") > 0) & (F.col("from") < F.col("words")) & (F.col("n_slots") > 0)
    block = lambda word: F.expr(f"(({word} + 1) * n_slots - 1) div words")
    pieces = F.when(some, F.sequence(block("`from`"), block("(upto - 1)"))).otherwise(F.array(F.lit(-1).cast("long")))
    rows = rows.withColumn("rank", F.explode(pieces))
    low = F.greatest("from", F.expr("(rank * words) div n_slots"))
    high = F.least("upto", F.expr("((rank + 1) * words) div n_slots"))
    rows = rows.withColumn("piece", F.when(F.col("rank") >= 0, high - low).otherwise(0))
    dealt = rows.join(given, ["place", "rank"], "left")
    done = dealt.groupBy("place", "row").agg(
        *[F.first(c).alias(c) for c in ("id", "source", "mark", "size", "source_size", "target")],
        F.sum(F.when(F.col("slot").isNotNull(), F.col("piece")).otherwise(0)).alias("taken"),
        F.min("slot").alias("first_slot"),
    )
    return done.select(F.col("id").alias(id_col), "source", "mark", "size", "source_size", "target", "taken", "first_slot")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix as whole documents, with the columns of `docs`: each is repeated as often as its words are taken, rounded.

    Rows that are equal in id, source and text share what they are taken together.
    """
    plan = mixture(docs, id_col, text_col, source_col, **options).where("size > 0")
    plan = plan.groupBy(F.col(id_col).alias("p_id"), F.col("source").alias("p_source"), F.col("mark").alias("p_mark")).agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias("copies")
    )
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("d_id"), F.col(source_col).cast("string").alias("d_source"), F.xxhash64(text_col).alias("d_mark"))
    same = F.col("d_id").eqNullSafe(F.col("p_id")) & F.col("d_source").eqNullSafe(F.col("p_source")) & (F.col("d_mark") == F.col("p_mark"))
    taken = rows.join(plan.where("copies > 0"), same)
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    done = mixture(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return done.select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null')) AS mixed FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sources),
limited AS (
  SELECT *, [5, 2, 1][(place % 3 + 1)::INT] AS weight, 3 * source_size AS lim FROM placed),
units AS (
  SELECT *, row_number() OVER (ORDER BY lim / weight, place) AS ord,
         (sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS unit
  FROM limited),
wanted AS (
  SELECT source, source_size, CASE WHEN ord < coalesce((SELECT min(ord) FROM units WHERE lim > unit * weight), 1e18) THEN lim::DOUBLE
         ELSE weight * (SELECT arg_min(unit, ord) FROM units WHERE lim > unit * weight) END AS target FROM units),
streams AS (
  SELECT doc_id, size, source_size, target, round(target)::BIGINT AS words,
         (sum(size) OVER (PARTITION BY s.source ORDER BY mixed, doc_id ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(start + size, words) - start)
        + greatest(0, least(start + source_size + size, words) - start - source_size)
        + greatest(0, least(start + 2 * source_size + size, words) - start - 2 * source_size))::BIGINT AS taken
FROM streams
"""
