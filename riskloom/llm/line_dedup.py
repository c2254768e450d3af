"""Corpus-wide removal of repeated lines.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. Keys of at
least `min_chars` code points that occur in at least `min_docs` rows lose all their lines.

Method: every row gives the hashes of its distinct keys, so that counting a hash counts its documents; of
the rows whose id occurs again, distinct pairs of id and hash are counted. Hashes over the threshold are joined back to the (document, hash) pairs, the few very
frequent ones without a shuffle, and gathered per document, whose lines are then filtered and rejoined
in their order.

Defined cases: a null or empty text is one empty line and stays an empty text; an empty key is never
dropped; rows with equal ids count as one document, and a null id is an id like any other; extra
columns are carried along untouched, whatever their names, but one named as the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import give_back, join_counted, small_batches, table, text_udf
from riskloom.operators.joins import broadcast_if_small
from riskloom.session import materialize

MIN_DOCS, MIN_CHARS = 10, 1
_WHITE = b" \t\n\x0b\x0c\r"
_RESULT = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())])


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[int | None]:
    """The signed 64-bit hash of each line's key, in order; None where the key is too short."""
    found = []
    for line in (text or "").encode().split(b"\n"):
        key = line.strip(_WHITE).lower()
        long = len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)
        found.append(xxhash.xxh3_64_intdigest(key) - (1 << 63) if long else None)
    return found


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int) -> DataFrame:
    """(id, drop): for each document with such lines, the hashes of its lines that are to go."""
    small_batches(docs.sparkSession)
    keys_of = text_udf(
        "array<bigint>",
        pa.list_(pa.int64()),
        lambda: lambda texts: [list({k for k in line_keys(t, min_chars) if k is not None}) for t in texts],
    )
    keyed = materialize(docs.select(F.col(id_col).alias("id"), keys_of(text_col).alias("keys")), "line-keys")
    pairs = keyed.select("id", F.explode("keys").alias("key"))
    counts = materialize(_documents(keyed).groupBy("key").count().where(F.col("count") >= min_docs), "line-counts")
    n_pairs = keyed.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    found = join_counted(pairs, counts, "key", n_pairs)
    return found.groupBy("id").agg(F.collect_set("key").alias("drop"))


def _documents(keyed: DataFrame) -> DataFrame:
    """(id, key) once for each document and key: rows whose id occurs once are so already."""
    pairs = keyed.select("id", F.explode("keys").alias("key"))
    again = materialize(keyed.groupBy("id").count().where("count > 1").select(F.col("id").alias("again")), "repeated-ids")
    if not again.limit(1).count():
        return pairs
    again = broadcast_if_small(again)
    same = pairs.id.eqNullSafe(again.again)
    return pairs.join(again, same, "left_anti").unionByName(pairs.join(again, same, "left_semi").distinct())


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    result: str = "lines",
) -> DataFrame:
    """`docs` with a struct column `result` of n_lines, n_dropped and kept (the text that stays)."""

    def prepare():
        def run(rows):
            out = []
            for row in rows:
                text, drop = row["text"] or "", row["drop"]
                if not drop:
                    out.append({"n_lines": text.count("\n") + 1, "n_dropped": 0, "kept": text})
                    continue
                gone = set(drop)
                lines = text.split("\n")
                kept = [line for line, key in zip(lines, line_keys(text, min_chars)) if key not in gone]
                out.append({"n_lines": len(lines), "n_dropped": len(lines) - len(kept), "kept": "\n".join(kept)})
            return out

        return run

    filtered = _struct_udf(prepare)
    drops = repeated_lines(docs, id_col, text_col, min_docs, min_chars)
    whole = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("own_id"), F.col(text_col).alias("text"))
    joined = whole.join(drops, whole.own_id.eqNullSafe(drops.id), "left")
    done = joined.select("doc", filtered(F.struct("text", "drop")).alias("done"))
    return done.select(*[F.col(f"doc.`{c}`") for c in docs.columns if c.lower() != result.lower()], F.col("done").alias(result))


def _struct_udf(prepare):
    @F.arrow_udf("n_lines bigint, n_dropped bigint, kept string")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = prepare()
        for batch in batches:
            yield pa.array(run(batch.to_pylist()), type=_RESULT)
        batch = None  # noqa: F841
        give_back()

    return apply


def op1_line_dedup(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = drop_repeated_lines(docs)
    return done.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
gone AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(gone.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (gone.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN gone USING (key) GROUP BY doc_id
"""
