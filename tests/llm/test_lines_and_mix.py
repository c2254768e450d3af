import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm.line_dedup import drop_repeated_lines, line_keys
from riskloom.llm.mixing import mixed_documents, mixture, targets

DOCS = "doc_id long, text string, source string, kept string, taken string, id string"


def docs_of(spark, *rows):
    return spark.createDataFrame([(*row, "k", "t", "i") for row in rows], DOCS)


def brute_lines(rows, least):
    keys = [[line.strip(" \t\n\x0b\x0c\r").encode().lower() for line in (text or "").split("\n")] for _, text, _ in rows]
    holders = {}
    for (doc, _, _), own in zip(rows, keys):
        for key in set(own) - {b""}:
            holders.setdefault(key, set()).add(doc)
    count = {key: len(docs) for key, docs in holders.items()}
    out = []
    for (doc, text, _), own in zip(rows, keys):
        lines = (text or "").split("\n")
        kept = [line for line, key in zip(lines, own) if count.get(key, 0) < least]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_lines_against_brute_force(spark):
    rows = [(i, f"Common\nown {i}\n  cOMMON \n\nÉtat" if i % 2 else f"own {i}\n\tcommon\r", "s") for i in range(20)]
    rows += [(100, None, "s"), (101, "", None), (None, "common", "s"), (102, "\n\n\n", "s"), (5, "own 5 again", "s")]
    rows += [(103, "common\n" * 30_000 + "tail", "s"), (104, "same", "s"), (104, "same", "s")]
    found = drop_repeated_lines(docs_of(spark, *rows), min_docs=3, result="done")
    assert found.columns == ["doc_id", "text", "source", "kept", "taken", "id", "done"]
    got = [(r.doc_id, r.done.n_lines, r.done.n_dropped, r.done.kept) for r in found.collect()]
    assert sorted(got, key=str) == brute_lines(rows, 3)


def test_rows_of_one_id_are_one_document(spark):
    rows = [(7, "shared\nown", "s")] * 10 + [(i, "other", "s") for i in range(10, 19)] + [(19, "other", "s"), (19, "other", "s")]
    done = drop_repeated_lines(docs_of(spark, *rows)).where("doc_id = 7").select("lines.*").collect()
    assert len(done) == 10 and {tuple(r) for r in done} == {(2, 0, "shared\nown")}
    assert {r.lines.kept for r in drop_repeated_lines(docs_of(spark, *rows)).where("doc_id <> 7").collect()} == {""}


def test_a_column_named_as_the_result_is_replaced(spark):
    docs = spark.createDataFrame([(1, "a\nb", "x", "y")], "doc_id long, text string, Lines string, drop string")
    found = drop_repeated_lines(docs)
    assert found.columns == ["doc_id", "text", "drop", "lines"] and found.first().lines.n_lines == 2


def test_lines_of_an_empty_table(spark):
    assert drop_repeated_lines(docs_of(spark).limit(0)).count() == 0


def test_line_keys_lower_only_ascii_and_strip_only_ascii_white():
    assert line_keys("ABC")[0] == line_keys(" abc\t")[0]
    assert line_keys("É")[0] != line_keys("é")[0]
    assert line_keys(" a")[0] != line_keys("a")[0]
    assert line_keys(" \t") == [None] and line_keys(None) == [None]
    assert line_keys("ab", min_chars=3) == [None]


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, cap, share the excess again, until no target is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, free = sum(sizes.values()), {}, set(names)
    while free:
        heavy = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / heavy >= most * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / heavy for s in free}
            break
        target |= {s: float(most * sizes[s]) for s in over}
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return target


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", "B", "é", "zz", None, "src"]), st.integers(0, 5000), min_size=1))
def test_targets_against_repeated_sharing(spark, sizes):
    got = targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    want = brute_targets(sizes)
    for row in got:
        assert row.target == pytest.approx(want[row.source], rel=1e-9, abs=1e-6)


def test_mixture_takes_the_targets_evenly(spark):
    rows = [(i, "w " * (i % 17), "big" if i % 3 else "small") for i in range(400)]
    rows += [(1000, None, "small"), (1001, "", None), (1002, "x y z", None), (None, "n u l l", "null id")]
    rows += [(7, "w " * 40, "big"), (7, "w " * 40, "big"), (1003, "long " * 50_000, "long")]
    docs = docs_of(spark, *rows)
    got = mixture(docs, slots=512).collect()
    assert len(got) == len(rows)
    again = mixture(docs.repartition(7), slots=512).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken, r.first_slot)
    assert sorted(map(key, got)) == sorted(map(key, again))
    for source in {r.source for r in got}:
        mine = [r for r in got if r.source == source]
        assert sum(r.taken for r in mine) == pytest.approx(mine[0].target, abs=1)
        assert sum(r.size for r in mine) == mine[0].source_size
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert all((r.first_slot is None) == (r.taken == 0) for r in got)


def test_schedule_has_low_discrepancy(spark):
    from riskloom.llm.mixing import schedule

    wanted = spark.createDataFrame([("a", 0, 5.0), ("b", 1, 2.0), ("c", 2, 1.0), ("d", 3, 1e-9), ("e", 4, 0.0)], "source string, place int, target double")
    slots = sorted(schedule(wanted, 800).collect(), key=lambda r: r.slot)
    assert len(slots) == 801 and slots[-1].place == 3  # too light for a point of its own
    for end in (80, 160, 400, 800):
        share = sum(1 for r in slots[:end] if r.place == 0) / end
        assert share == pytest.approx(0.625, abs=4 / end)
    assert [r.rank for r in slots if r.place == 1] == list(range(sum(1 for r in slots if r.place == 1)))


def test_mix_of_empty_tables_and_whole_documents(spark):
    assert mixture(docs_of(spark).limit(0)).count() == 0
    docs = docs_of(spark, *[(i, "a b c d", "x") for i in range(8)], *[(i + 50, "a b c d", "y") for i in range(2)])
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = {r.source: r["sum(n)"] for r in mixed.selectExpr("source", "4 n").groupBy("source").sum("n").collect()}
    # y is at its limit of three times its 8 words? 40 words at 5 to 2 give x 28.6 and y 11.4.
    assert words["x"] == pytest.approx(28.6, abs=4) and words["y"] == pytest.approx(11.4, abs=4)


def test_hash_of_the_query_is_that_of_the_kept_text(spark):
    from riskloom.llm.line_dedup import op1_line_dedup

    row = op1_line_dedup(spark, "/root/testdata/sf0.001").where("n_dropped = 0").orderBy("doc_id").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(f"doc_id = {row.doc_id}").first().text
    assert row.kept_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
