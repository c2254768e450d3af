"""Groups of spelling variants: frequent words and the far more frequent words one edit away.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. The form of a
word is its most frequent near word, if that is at least `TIMES` as frequent; its root is where the forms
lead in the end.

Method:

1. Words are counted, first in the tasks that find them. They go on between a start and an end mark.
2. Gram dictionary: grams of `SHORTEST` to `LONGEST` signs are counted over all words. A gram is kept as a
   unit as soon as it is rare; a frequent one is pruned in favour of its longer grams. `MOST_GRAMS` bounds
   the number of frequent ones at any size, as the limit of rarity grows with the words.
3. Each place of a word starts one gram of variable length: the shortest that is rare, no longer than half
   of the word. Its list holds the words that have it at this distance from their start, another list those
   with this distance from their end.
4. An edit affects just the grams that cover its place. Of two grams that do not overlap it leaves one,
   the left one at its distance from the start or the right one at its distance from the end. So a
   word merges two lists only, those of the cheapest pair of its grams that no edit affects together.
   The longer word of a pair looks up the other; grams are cut by its half on both sides.
5. Members of merged lists are verified by edit distance inside the join; only near pairs leave it. Long
   lists are split into blocks of members and of words that look them up.

Defined cases: a null or empty text has no words; a null id counts as the empty text where `change` sees
it; repeated rows count again; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import CRC32_SQL, give_back, small_batches, table
from riskloom.operators.joins import broadcast_if_small
from riskloom.session import materialize

#: Words have at least so many code points and occur so often.
MIN_CHARS, MIN_COUNT = 6, 5
#: How many times as frequent as a word its form is.
TIMES = 5
#: Signs of a gram, and how many grams may count as frequent.
SHORTEST, LONGEST, MOST_GRAMS = 2, 8, 200_000
#: A gram is rare if it stands in no more than so many places of words, or in a MOST_GRAMS-th of all.
RARE = 32
#: Members of a list, and words that look it up, which one task compares.
BLOCK = 2000
#: Entries that a task counts before it hands them on, and words to a task.
HELD, TASK_WORDS = 300_000, 50_000
_RUN = "[A-Za-zÀ-ÿ]+"


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    change: Callable[[str, str], str] | None = None,
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n): words with A-Z lower-cased, and how often they occur.

    `change` may respell a word of a document, given the id as text and the word.
    """
    small_batches(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, held = re.compile(_RUN).findall, defaultdict(int)

        def flush() -> pa.RecordBatch:
            words = pa.array([word.decode("latin-1") for word in held])
            made = pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # All signs of a word are of one byte in Latin-1, where only A-Z are lowered.
                for run, n in Counter(find(text.as_py() or "")).items():
                    if len(run) < min_chars:
                        continue
                    word = run.encode("latin-1").lower()
                    if change:
                        word = change(doc or "", word.decode("latin-1")).encode("latin-1")
                        if len(word) < min_chars:
                            continue
                    held[word] += n
                if len(held) >= HELD:
                    yield flush()
        if held:
            yield flush()
        batch = None  # noqa: F841
        give_back()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(counted, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def frequent_grams(words: DataFrame) -> tuple[dict[str, int], int]:
    """The grams that are not rare, with the places they stand in, at most MOST_GRAMS, and the limit of rarity."""
    lengths = range(SHORTEST, LONGEST)
    places = sum(F.greatest(F.length("word") + 3 - q, F.lit(0)) for q in lengths)
    total = words.agg(F.coalesce(F.sum(places.cast("long")), F.lit(0))).first()[0]
    rare = max(RARE, -(-total // MOST_GRAMS))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                word = f"^{word}$"
                for q in lengths:
                    held.update([word[p : p + q] for p in range(len(word) - q + 1)])
                if len(held) >= HELD:
                    yield pa.RecordBatch.from_pydict({"gram": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pa.RecordBatch.from_pydict({"gram": list(held), "n": list(held.values())})
        batch = held = None  # noqa: F841
        give_back()

    counts = words.select("word").mapInArrow(counted, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    return {row.gram: row.n for row in counts.where(F.col("n") > rare).collect()}, rare


def longest_gram(length: int) -> int:
    """Signs of the longest gram of a word that looks up others: half of it, with its marks."""
    return min((length + 2) // 2, LONGEST)


def gram_sizes(word: str, most: int, frequent: dict[str, int]) -> list[int]:
    """For each place of a marked word the signs of its gram: the shortest rare one, up to `most` or the end."""
    out, n = [], len(word)
    for p in range(n - SHORTEST + 1):
        q, end = SHORTEST, min(most, n - p)
        while q < end and word[p : p + q] in frequent:
            q += 1
        out.append(q)
    return out


def cheapest_pair(word: str, sizes: list[int], frequent: dict[str, int]) -> tuple[int, int]:
    """Places of the two grams that do not overlap and whose lists are the shortest together."""
    # Grams of the greatest length are not counted; they are no more frequent than the gram they extend.
    cost = [frequent.get(word[p : p + min(q, LONGEST - 1)], 0) for p, q in enumerate(sizes)]
    n = len(sizes)
    # The cheapest gram that starts at a place or later.
    later = list(range(n))
    for p in range(n - 2, -1, -1):
        if cost[later[p + 1]] < cost[p]:
            later[p] = later[p + 1]
    best = None
    for p, q in enumerate(sizes):
        if p + q < n:
            other = later[p + q]
            if best is None or cost[p] + cost[other] < best[0]:
                best = (cost[p] + cost[other], p, other)
    return best[1:]


def gram_lists(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(key, word, n, asks): the lists of every word, and the two lists that the word itself merges.

    A list is that of a gram, its distance from the start or the end, and the length of the words that
    look it up; its key is a hash of these. Words that share a key by chance fail the verification.
    """
    shared = words.sparkSession.sparkContext.broadcast(frequent)
    schema = pa.schema([("key", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("asks", pa.bool_())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, digest = shared.value, xxhash.xxh3_64_intdigest

        def key(side: str, length: int, offset: int, gram: str) -> int:
            return digest(f"{side}{length},{offset},{gram}") - (1 << 63)

        keys, names, counts, asks = [], [], [], []

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(asks, pa.bool_())], schema=schema)
            for held in (keys, names, counts, asks):
                held.clear()
            return made

        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                marked, own = f"^{word}$", len(word)
                free = gram_sizes(marked, longest_gram(own + 1), grams)
                for length in (own, own + 1):
                    most = longest_gram(length)
                    for p, q in enumerate(free):
                        gram = marked[p : p + min(q, most)]
                        keys += (key("<", length, p, gram), key(">", length, own + 2 - p, gram))
                rows = 4 * len(free)
                asks += [False] * rows + [True] * 2
                names += [word] * (rows + 2)
                counts += [n] * (rows + 2)
                most = longest_gram(own)
                sizes = [min(q, most) for q in free]
                left, right = cheapest_pair(marked, sizes, grams)
                keys += (
                    key("<", own, left, marked[left : left + sizes[left]]),
                    key(">", own, own + 2 - right, marked[right : right + sizes[right]]),
                )
                if len(keys) >= HELD:
                    yield flush()
        if keys:
            yield flush()
        batch = None  # noqa: F841
        give_back()

    return words.select("word", "n").mapInArrow(listed, "key bigint, word string, n bigint, asks boolean")


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, n_a, b, n_b): each two near words once, with their counts."""
    frequent, _ = frequent_grams(words)
    lists = materialize(gram_lists(words, frequent), "gram-lists")
    sizes = lists.groupBy("key").agg(F.count_if("asks").alias("q"), F.count_if(~F.col("asks")).alias("m"))
    long = sizes.where((F.col("q") > 0) & ((F.col("q") > block) | (F.col("m") > block)))
    parts = [F.ceil(F.col(c) / block).cast("int").alias(f"{c}_parts") for c in ("q", "m")]
    long = broadcast_if_small(materialize(long.select("key", *parts), "long-lists"))
    one = F.lit(1)

    def side(asks: bool, own: str, other: str) -> DataFrame:
        rows = lists.where(F.col("asks") == asks).drop("asks").join(long, "key", "left")
        part = F.pmod(F.xxhash64("word"), F.coalesce(f"{own}_parts", one)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(f"{other}_parts", one) - 1))
        return rows.select("key", "word", "n", part.alias(own), copies.alias(other))

    asking, members = side(True, "q", "m").alias("x"), side(False, "m", "q").alias("y")
    shorter = F.length("y.word") < F.length("x.word")
    ordered = shorter | ((F.length("y.word") == F.length("x.word")) & (F.col("y.word") < F.col("x.word")))
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("key", "q", "m")]
    near = F.levenshtein("x.word", "y.word", 1) == 1
    found = asking.join(members, [*same, ordered, near])
    pairs = found.select(F.col("x.word").alias("a"), F.col("x.n").alias("n_a"), F.col("y.word").alias("b"), F.col("y.n").alias("n_b"))
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, twice as far in each round."""
    found = forms.select("word", F.col("form").alias("root"))
    while True:
        found = materialize(found, "roots")
        then = found.select(F.col("word").alias("root"), F.col("root").alias("then"))
        if not found.join(then, "root", "left_semi").limit(1).count():
            return found
        found = found.join(then, "root", "left").select("word", F.coalesce("then", "root").alias("root"))


def spelling_groups(words: DataFrame, times: int = TIMES) -> DataFrame:
    """Per word of (word, n) its form, root, n, n_near (near words) and form_n."""
    spark = words.sparkSession
    words = materialize(words.select("word", "n"), "words-counted")
    # Small files are read by few tasks, so the words are dealt to tasks by their number.
    tasks = max(spark.sparkContext.defaultParallelism, -(-words.count() // TASK_WORDS))
    pairs = materialize(near_pairs(words.repartition(tasks, "word")), "near-pairs")
    mirrored = pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    # Of equally frequent words the first in the order of code points, which is that of UTF-8 bytes.
    best = F.min(F.struct((-F.col("n_b")).alias("minus"), F.col("b").alias("form")))
    near = pairs.unionByName(mirrored).groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    enough = -F.col("best.minus") >= times * F.col("n")
    judged = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"),
    )
    judged = materialize(judged, "forms")
    found = roots(judged.where("form IS NOT NULL"))
    rooted = judged.join(found, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def letter_lost(doc: str, word: str) -> str:
    """The word without one letter, for one in 199 words of documents by check sum."""
    h = crc32(f"{doc}:{word}".encode())
    if h % 199:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_groups(word_counts(table(spark, folder, "documents"), change=letter_lost))


ORACLE = rf"""
WITH runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (
  SELECT doc_id, run, count(*) AS n, doc_id || ':' || run AS t FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
summed AS (SELECT run, n, {CRC32_SQL.format(text="t")} AS h FROM counted),
spelled AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM summed),
words AS (
  SELECT word, cast(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT x.word AS a, y.word AS b, y.n FROM cuts x JOIN cuts y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION
  SELECT x.word, y.word, y.n FROM cuts x JOIN words y ON x.rest = y.word
  UNION
  SELECT x.word, y.word, y.n FROM cuts y JOIN words x ON y.rest = x.word),
best AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, {{'n': -n, 'b': encode(b)}}) AS form, max(n) AS form_n
  FROM near GROUP BY a),
judged AS (
  SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * words.n THEN form END AS form,
         CASE WHEN form_n >= 5 * words.n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
led AS (
  WITH RECURSIVE chain(word, root, step) AS (
    SELECT word, word, 0 FROM judged
    UNION ALL
    SELECT chain.word, judged.form, step + 1 FROM chain JOIN judged ON judged.word = chain.root WHERE judged.form IS NOT NULL)
  SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN led USING (word)
"""
