"""Columns of the contracts that SQL can express, for queries of which it cannot express all."""

import duckdb
import numpy as np
import pytest

from riskloom.llm import bpe, fingerprint, language, minhash, pii, quality
from riskloom.llm.common import CRC32_SQL

SMALL = "/root/testdata/sf0.001"
HELD = CRC32_SQL.format(text="cast(doc_id AS VARCHAR)") + " % 3 = 1"


@pytest.fixture(scope="module")
def rows_of():
    def run(sql):
        db = duckdb.connect()
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
        return sorted(db.execute(sql).fetchall())

    return run


def collected(df, *columns):
    return sorted(tuple(row[c] for c in columns) for row in df.collect())


def test_language_rows_and_unknown_texts(spark, rows_of):
    df = language.op2_language(spark, SMALL)
    got = df.selectExpr("doc_id", "held_out", "lang_pred = 'und' AS und", "score BETWEEN 0 AND 1 AS inside")
    want = rows_of(f"SELECT doc_id, {HELD}, NOT coalesce(regexp_matches(text, '\\p{{L}}'), false), true FROM documents")
    assert collected(got, *got.columns) == want


def test_quality_rows(spark, rows_of):
    df = quality.op4_quality(spark, SMALL)
    got = df.selectExpr("doc_id", "held_out", "score BETWEEN 0 AND 1 AND predicted = cast(score >= 0.5 AS int) AS follows")
    assert collected(got, *got.columns) == rows_of(f"SELECT doc_id, {HELD}, true FROM documents")


def test_decoded_tokens_are_the_texts(spark, rows_of):
    want = rows_of("SELECT doc_id, sha256(coalesce(text, '')) FROM documents")
    assert collected(bpe.op9_bpe(spark, SMALL), "doc_id", "decoded_sha256") == want


def test_edited_texts(spark, rows_of):
    want = rows_of("""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS x, length(coalesce(text, '')) AS n FROM documents),
        f AS (SELECT *, coalesce(lead(x) OVER (ORDER BY doc_id), first(x) OVER (ORDER BY doc_id)) AS y FROM t)
        SELECT doc_id, n, sha256(substr(x, 1, n - n // 2) || substr(y, 1, n // 2)) FROM f""")
    assert collected(fingerprint.op10_fingerprints(spark, SMALL), "doc_id", "n_chars", "edited_sha256") == want


def slow_signature(hashes):
    """The least hash of each of 64 equal ranges of hashes; an empty range takes the next one's, marked by how far it is."""
    least = {}
    for h in hashes:
        least[h >> 58] = min(least.get(h >> 58, h), h)
    out = []
    for i in range(64):
        away = next(k for k in range(64) if (i + k) % 64 in least)
        out.append(((least[(i + away) % 64] >> 32) + 40503 * away) & 0xFFFF)
    return out


@pytest.mark.parametrize("n", [1, 2, 9, 64, 700])
def test_signatures_and_their_likeness_against_plain_loops(n):
    rng = np.random.default_rng(n)
    hashes = rng.integers(0, 2**64, n, np.uint64)
    changed = np.concatenate((hashes[n // 3 :], rng.integers(0, 2**64, n // 3, np.uint64)))
    one, two = (slow_signature([int(h) for h in x]) for x in (hashes, changed))
    left, right = fingerprint.signature(hashes), fingerprint.signature(changed)
    assert left == "".join(f"{v:04x}" for v in one) and right == "".join(f"{v:04x}" for v in two)
    share = sum(a == b for a, b in zip(one, two)) / 64
    assert fingerprint.likeness(left, right) == pytest.approx(max(0, (share - 2**-16) / (1 - 2**-16)))


def test_personal_data_of_a_text_with_very_many_spans(spark):
    line = "call (555) 123-4567, write to joe@x.org, +1 555 123 4567 from 10.0.0.1\n"
    text = line * 5000
    found = pii.personal_data(spark.createDataFrame([(1, text), (2, line)], "doc_id long, text string")).collect()
    spans = {row.doc_id: [(s.kind, s.start, s.end, s.base) for s in row.spans] for row in found}
    one = [(1 - 1, line.index("joe"), line.index("joe") + 9, True), (3, line.index("+1"), line.index("+1") + 15, True),
           (1, line.index("10."), line.index("10.") + 8, True)]
    assert sorted(s for s in spans[2] if s[3]) == sorted(one)
    want = sorted((len(line) * i + s, k, len(line) * i + e, b) for i in range(5000) for k, s, e, b in spans[2])
    assert [(s, k, e, b) for k, s, e, b in spans[1]] == want


def test_sets_of_one_name_are_told_apart_by_the_other(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    want = collected(minhash.near_duplicates(docs), "doc_id", "component_id", "n_shingles")
    plain = minhash.prints

    def clashing(sets, rows):
        out = plain(sets, rows)
        for row in out:
            if row["node"] is not None:
                row["node"] %= 5
        return out

    monkeypatch.setattr(minhash, "prints", clashing)
    assert collected(minhash.near_duplicates(docs), "doc_id", "component_id", "n_shingles") == want


def test_hundreds_of_languages(spark):
    signs = [chr(0x4E00 + i) for i in range(2000)]
    docs = [(k * 10 + i, " ".join(signs[k * 5 + (i + j) % 5] + signs[k * 5 + j % 5] for j in range(30)), f"l{k:03d}") for k in range(400) for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    filters = language.learn(df)
    assert len(filters.languages) == 400 and len(filters.masks) == 7
    found = df.select("lang", language.identify(spark, filters).alias("f")).where("lang = f.lang_pred").count()
    assert found == len(docs)
