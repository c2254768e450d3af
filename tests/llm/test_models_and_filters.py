import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.llm import language, pii, quality, url_filter

SMALL = "/root/testdata/sf0.01"


# --- quality ---------------------------------------------------------------------------------------


def test_held_out_rows_follow_the_rule(spark):
    got = spark.range(200).select("id", quality.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)
    assert spark.createDataFrame([(None,)], "id long").select(quality.held_out("id")).first()[0] is False


def test_contexts_and_pooling_against_plain_loops():
    words, index = quality.Buckets(), quality.index_vectors()
    texts = ["a b, a", None, "", "one", "x y z x !!"]
    types, sizes = words.of(texts)
    assert sizes.tolist() == [4, 0, 0, 1, 5]
    want = np.zeros_like(index)
    start = 0
    for size in sizes.tolist():
        own = types[start : start + size].tolist()
        for i, word in enumerate(own):
            for j in range(max(0, i - quality.WINDOW), min(size, i + quality.WINDOW + 1)):
                if j != i:
                    want[word] += index[own[j]]
        start += size
    assert (quality.contexts(types, sizes, index) == want).all()
    vectors = quality.unit(index + 0.01).astype(np.float32)
    pooled = quality.pooled(types, sizes, vectors)
    rows = vectors[types[:4]]
    assert pooled[0, : quality.WIDTH] == pytest.approx(rows.mean(0), abs=1e-5)
    assert pooled[0, quality.WIDTH : 2 * quality.WIDTH] == pytest.approx(rows.std(0), abs=1e-3)
    assert pooled[0, 2 * quality.WIDTH] == pytest.approx(np.mean([rows[i] @ rows[i + 1] for i in range(3)]), abs=1e-5)
    assert not pooled[1].any()


def test_strips_change_nothing(monkeypatch):
    words, vectors = quality.Buckets(), quality.unit(quality.index_vectors() + 0.01).astype(np.float32)
    types, sizes = words.of([" ".join(f"w{i * j % 37}" for j in range(1 + 13 * i)) for i in range(12)])
    whole = quality.pooled(types, sizes, vectors)
    monkeypatch.setattr(quality, "STRIP", 17)
    assert quality.pooled(types, sizes, vectors) == pytest.approx(whole, abs=1e-6)


def test_quality_holds_out_of_sample(spark):
    scored = quality.op4_quality(spark, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.97
    assert scored.count() == 1000


def test_quality_learns_nothing_from_held_out_labels(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (quality.fit(docs, x.where(~quality.held_out()).select("doc_id", "quality")) for x in (labels, flipped))
    assert (first.net.first == second.net.first).all() and first.net.temperature == second.net.temperature


def test_quality_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "a b " * 50_000, 0.5), (3, "a", 0.5), (None, "b", 0.5)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r[0] for r in docs.select(quality.score(spark, quality.fit(docs, none))).collect()] == [0.5] * 5
    one = spark.createDataFrame([(1, 1), (1, 0), (3, 1), (77, 0), (2, None)], "doc_id long, quality int")
    model = quality.fit(docs, one)
    assert model.net is None  # ids 1 and 3 are both of label 1
    assert docs.limit(0).select(quality.score(spark, model)).count() == 0
    both = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    scores = [r[0] for r in docs.select(quality.score(spark, quality.fit(docs, both))).collect()]
    assert all(0 <= s <= 1 for s in scores) and scores[0] == scores[1]


def test_training_rows_are_bounded_and_balanced(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    known = docs.select(F.col("doc_id").alias("id"), (F.col("doc_id") % 5 > 0).cast("int").alias("label"))
    rows = quality.training_rows(docs, known, "doc_id", "text", 100).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in rows} == {0: 50, 1: 50}


# --- language --------------------------------------------------------------------------------------


def test_grams_against_plain_loops():
    texts = ["Ab c", None, "", "1 2", "é!"]
    packed, sizes, lettered = language.grams(texts)
    want, n = [], []
    for text in texts:
        own = " " + (text or "").lower() + " "
        code = [ord(c) if c.isalpha() else 0 for c in own]
        found = [code[i - 1] << 42 | code[i] << 21 | code[i + 1] for i in range(1, len(code) - 1) if code[i]]
        want += found
        n.append(len(found))
    assert packed.tolist() == want and sizes.tolist() == n and lettered.tolist() == [x > 0 for x in n]


def test_filters_hold_every_gram_and_count_false_ones():
    rng = np.random.default_rng(1)
    known = {f"l{i:02}": rng.integers(0, 2**62, 2000) for i in range(70)}  # more than one mask word
    made = language.Filters.build(sorted(known), known)
    assert len(made.masks) == 2
    for i, name in enumerate(sorted(known)):
        assert made.hits(known[name], np.array([2000]))[0, i] == 2000
    false = made.hits(rng.integers(0, 2**62, 20_000), np.array([20_000]))[0] / 20_000
    assert false == pytest.approx(made.false_rate, abs=2e-3)


def test_language_holds_out_of_sample(spark):
    rows = language.op2_language(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == 1000


def test_language_of_odd_texts(spark):
    docs = spark.createDataFrame(
        [(i, t, l, "x") for i, (t, l) in enumerate([("the cat sat on the mat", "en"), ("die katze und der hund", "de"), ("no lang", None)] * 5)],
        "doc_id long, text string, lang string, score string",
    )
    model = language.learn(docs)
    assert model.languages == ["de", "en"]
    odd = spark.createDataFrame([(None,), ("",), ("123 !",), ("the the the",), ("DIE KATZE",), ("中",), ("the cat " * 30_000,)], "text string")
    got = [tuple(r.f) for r in odd.select(language.identify(spark, model).alias("f")).collect()]
    assert [g[0] for g in got] == ["und", "und", "und", "en", "de", "de", "en"]
    assert got[0][1] == got[5][1] == 0 and all(0 <= g[1] <= 1 for g in got)
    nothing = language.learn(docs.limit(0))
    assert odd.select(language.identify(spark, nothing).alias("f")).where("f.lang_pred = 'und' AND f.score = 0").count() == 7
    assert odd.limit(0).select(language.identify(spark, model)).count() == 0


# --- personal data ---------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(PLAIN.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match.group())
            total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
            if {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in match.group().split(".")),
                "card": 14 <= len(digits) <= 19 and total % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]:
                out.append((match.start(), number, match.end(), f"{kind}:{match.start()}:{match.end()}"))
    return ",".join(x[3] for x in sorted(out))


def luhn(rng, n):
    digits = [rng.randint(0, 9) for _ in range(n - 1)]
    total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
    return "".join(map(str, digits)) + str(-total % 10)


def test_base_spans_against_plain_search(spark):
    rng = random.Random(6)
    parts = ["a@b.co", "a@b.c%d@e.f", "x.y+z@q-r.de.", "@x.y", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.4", "+1 (743) 555-3824", "+12", "+44 20 7946 0958-", "é中", " ", "\n", "-", "."]
    texts = ["".join(rng.choice(parts + [luhn(rng, rng.randint(12, 20)), luhn(rng, 16)[:4] + "-" + "1234 5678"]) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    texts += [None, "", "a" * 200_000, "9" * 50_000, "a@" + "b." * 20_000 + "c", "+" + "1 " * 50_000, "a.b@c.d " * 3000]
    docs = spark.createDataFrame([(i, t, "s", "b") for i, t in enumerate(texts)], "doc_id long, text string, spans string, base string")
    found = pii.personal_data(docs.repartition(4))
    got = {r.doc_id: r.base for r in found.select("doc_id", pii.written(F.filter("spans", lambda s: s["base"])).alias("base")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == plain_spans(text or ""), (text or "")[:200]


def test_added_spans_are_loose_forms_that_look_right(spark):
    texts = ["call me: phone (743) 555-3824 today"] * 30 + ["tel 212-555-0123, fax 212-555-0199"] * 10 + ["write jane(at)mail(dot)com soon"] * 10
    texts += ["Nothing personal, page 12 of 99."] * 50 + ["+1 (743) 555-3824"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.personal_data(docs).select("doc_id", pii.written(F.col("spans")).alias("spans")).collect()}
    assert spans[0] == "phone:15:29" and spans[40] == "email:6:26"
    assert spans[60] == "" and spans[100] == "phone:0:17"


def test_em_finds_reliable_labelers():
    rng = random.Random(2)
    counts = {}
    for _ in range(4000):
        true = rng.random() < 0.3
        # The first two labelers are right nine times in ten, the others are noise.
        votes = tuple([(1 if true == (rng.random() < 0.9) else -1) for _ in range(2)] + [rng.choice([-1, 0, 1]) for _ in range(3)])
        counts[votes] = counts.get(votes, 0) + 1
    soft = pii.reliabilities([(0, *votes, n) for votes, n in counts.items()])
    sure = [p for (_, a, b, *_rest), p in soft.items() if a == b == 1]
    never = [p for (_, a, b, *_rest), p in soft.items() if a == b == -1]
    assert min(sure) > 0.8 > 0.2 > max(never)


def test_personal_data_of_an_empty_table(spark):
    assert pii.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_personal_data_runs_without_python_workers(spark):
    plan = pii.op6_pii(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- URLs ------------------------------------------------------------------------------------------


def to_regex(glob):
    out = re.escape(glob).replace(r"\*\*", "(?s:.*)").replace(r"\*", "[^/]*")
    return re.compile(out + r"\Z")


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.text(alphabet="ab/.*é", min_size=1, max_size=40), min_size=1, max_size=12),
    st.lists(st.text(alphabet="ab/.é", max_size=50), min_size=1, max_size=8),
)
def test_automaton_equals_regular_expressions(globs, addresses):
    globs = [re.sub(r"\*{3,}", "**", glob) for glob in globs]
    got = url_filter.Automaton(globs).fits(addresses)
    assert got.tolist() == [[bool(to_regex(g).match(a)) for g in globs] for a in addresses]


def test_verdicts(spark):
    urls = {
        "http://example.net/en/x": ("example.net", "/en/x", "example.net/en/", "allow"),
        "https://A.B.NET/x?q#f": ("a.b.net", "/x", "net/", "block"),
        "http://a.net": ("a.net", "", None, "allow"),
        "http://evil.com/x.net/y": ("evil.com", "/x.net/y", None, "allow"),
        "http://notnet/": ("notnet", "/", None, "allow"),
        "http://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
        "http://example.com/DE/": ("example.com", "/DE/", None, "allow"),
        "http://example.com/de": ("example.com", "/de", None, "allow"),
        "x://y://z.org/fr/1": ("y:", "//z.org/fr/1", None, "allow"),
        "http://sub.x.org/fr/1#?": ("sub.x.org", "/fr/1", "org/fr/", "allow"),
        "http://h?x=/en/": ("h", "", None, "allow"),
        "http://ads.shop/x": ("ads.shop", "/x", None, "block"),
        "http://É.NET/": ("É.net", "/", "net/", "block"),
        "no scheme.net/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://long.net/" + "a/" * 50_000: ("long.net", "/" + "a/" * 50_000, "net/", "block"),
    }
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    got = pages.select("url", url_filter.judged(spark).alias("f")).collect()
    assert {r.url: tuple(r.f) for r in got} == urls
    assert pages.limit(0).select(url_filter.judged(spark)).count() == 0


def test_equally_long_rules_go_by_their_order():
    made = url_filter.UrlFilter([("allow", "ab/"), ("block", "ab/"), ("block", "b/")], [])
    assert [r["verdict"] for r in made.judge(["x://ab/", "x://b/"])] == ["allow", "block"]


def test_hash_of_no_spans(spark):
    row = pii.op6_pii(spark, "/root/testdata/sf0.001").where("n_email + n_ip + n_card + n_phone = 0").first()
    assert row.base_sha256 == hashlib.sha256(b"").hexdigest()
