import zlib

import pytest

import corpus_pipeline
from riskloom.llm import line_dedup, minhash, mixing, quality
from riskloom.session import materialize

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into and comes out of each stage."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = materialize(stage(spark, docs, SMALL), name)
        out[name] = (docs, made)
        docs = made
    return out


def test_columns_and_order_of_the_stages(stages):
    assert list(stages) == ["quality", "lines", "near_duplicates", "mix", "tokens"]
    for name, (before, after) in stages.items():
        if name != "tokens":
            assert after.dtypes == before.dtypes


def test_quality_rejects_bad_and_keeps_good_documents(spark, stages):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").join(before.select("doc_id", "text"), "doc_id").collect()
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    bad = [r.doc_id in kept for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.4


def test_lines_are_those_of_brute_force(stages):
    before, after = (sorted(x.collect(), key=lambda r: r.doc_id) for x in stages["lines"])
    count = {}
    for row in before:
        for key in set(line_dedup.line_keys(row.text)) - {None}:
            count[key] = count.get(key, 0) + 1
    for old, new in zip(before, after, strict=True):
        keys = line_dedup.line_keys(old.text)
        text = "\n".join(line for line, key in zip((old.text or "").split("\n"), keys) if count.get(key, 0) < 10)
        assert (new.doc_id, new.text, new.n_chars) == (old.doc_id, text, len(text))


def test_one_document_of_each_group_of_near_copies_stays(stages):
    before, after = (x.select("doc_id", "text").collect() for x in stages["near_duplicates"])
    made = minhash.Shingles(minhash.WORDS)
    sets = {r.doc_id: set(made.of([r.text])[0].tolist()) for r in before}
    kept = {r.doc_id for r in after}
    holders = {}
    for doc, own in sets.items():
        for shingle in own:
            holders.setdefault(shingle, []).append(doc)
    links = {}
    for doc, own in sets.items():
        shared = {}
        for shingle in own:
            for other in holders[shingle]:
                shared[other] = shared.get(other, 0) + 1
        links[doc] = [o for o, n in shared.items() if o != doc and n * 100 >= 80 * (len(own) + len(sets[o]) - n)]
    seen = set()
    for doc in sorted(sets):
        if doc in seen:
            continue
        group, todo = set(), [doc]
        while todo:
            one = todo.pop()
            if one not in group:
                group.add(one)
                todo += links[one]
        seen |= group
        assert kept & group == {min(group)}


def test_mix_reaches_its_targets_with_whole_documents(spark, stages):
    before, after = stages["mix"]
    wanted = mixing.targets(mixing.sized_documents(before, "doc_id", "text", "source")).collect()
    words = {r.source: r.n for r in after.select("source", mixing.word_count().alias("w")).groupBy("source").agg({"w": "sum"}).toDF("source", "n").collect()}
    longest = before.select(mixing.word_count().alias("w")).agg({"w": "max"}).first()[0]
    for row in wanted:
        assert words.get(row.source, 0) == pytest.approx(row.target, abs=longest)
    assert after.join(before, ["doc_id", "text"], "left_anti").count() == 0


def test_tokens_decode_to_their_texts(stages):
    before, after = stages["tokens"]
    assert after.count() == before.count() and after.where("NOT whole").count() == 0


def test_run_gives_what_the_stages_give(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    rows = lambda df: sorted((r.doc_id, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in df.collect())
    assert rows(got) == rows(stages["tokens"][1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_odd_documents(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, None, None, None, 0), (2, "", "en", "s", 0), (None, "no id at all", "en", "s", 12), (3, "same text here again", "en", "s", 20), (3, "same text here again", "en", "s", 20)]
    docs = spark.createDataFrame(odd, kind)
    lines = corpus_pipeline.line_stage(spark, docs, SMALL)
    assert sorted(map(str, lines.collect())) == sorted(map(str, docs.collect()))
    near = corpus_pipeline.near_duplicate_stage(spark, docs, SMALL)
    want = [(1, None), (2, ""), (3, "same text here again"), (None, "no id at all")]
    assert sorted(((r.doc_id, r.text) for r in near.collect()), key=str) == sorted(want, key=str)
    assert corpus_pipeline.mixing_stage(spark, docs, SMALL).where("text IS NULL OR text = ''").count() == 0
    assert corpus_pipeline.token_stage(spark, docs, SMALL).where("whole").count() == 5
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_a_copy_takes_no_other_row_of_its_id_along(spark):
    a, b = "one two three four five six seven eight", "nine ten eleven twelve thirteen fourteen fifteen sixteen"
    docs = spark.createDataFrame(
        [(3, a, "en", "s", 1), (9, a, "en", "s", 1), (9, b, "en", "s", 1), (9, b, "en", "s", 1), (4, b + " end", "en", "s", 1),
         (None, a, "en", "s", 1), (None, a, "en", "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    near = corpus_pipeline.near_duplicate_stage(spark, docs, SMALL)
    got = sorted(((r.doc_id, r.text) for r in near.collect()), key=str)
    assert got == sorted([(3, a), (4, b + " end"), (None, a)], key=str)
    apart = docs.where("doc_id <> 4")
    near = corpus_pipeline.near_duplicate_stage(spark, apart, SMALL)
    assert sorted((r.doc_id, r.text) for r in near.collect()) == [(3, a), (9, b)]


def test_the_stage_scores_without_labels_of_held_out_rows(spark):
    assert spark.range(9).where(quality.held_out("id")).count() == sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in range(9))
