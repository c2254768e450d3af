import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import periodic


def brute(words):
    """(start, length, period) of every run, by trying all periods at all places."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapsed(words):
    gone = {i for s, n, q in brute(words) for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


repeated = st.builds(
    lambda head, unit, times, cut, tail: head + (unit * times)[: len(unit) * times - cut] + tail,
    st.lists(st.sampled_from("abc"), max_size=6), st.lists(st.sampled_from("ab"), min_size=1, max_size=6),
    st.integers(1, 12), st.integers(0, 3), st.lists(st.sampled_from("abc"), max_size=6),
)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(repeated, st.lists(st.sampled_from("ab"), max_size=40)), max_size=5))
def test_runs_equal_brute_force(texts):
    texts = texts + texts[:1]
    for words, got in zip(texts, periodic.block_runs([" ".join(t) for t in texts])):
        assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == brute(words)
        assert got["collapsed"] == brute_collapsed(words) and got["n_words"] == len(words)


def test_a_repetition_of_repetitions():
    unit = ["a", "b"] * 5 + ["c"]
    words = ["x", *unit * 6, "y"]
    got = periodic.block_runs([" ".join(words)])[0]
    assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == brute(words)
    assert (1, 66, 11) in brute(words) and len(brute(words)) == 7


def test_a_grammar_derives_its_text():
    import numpy as np

    rng = np.random.default_rng(2)
    text = np.concatenate([rng.integers(0, 4, 500), [-1], np.tile(rng.integers(0, 4, 7), 40), [-2]])
    symbols, places, size, parts, homes, rounds = periodic.re_pair(text, 4)

    def derive(symbol):
        return [symbol] if symbol < 4 else derive(parts[0, symbol - 4]) + derive(parts[1, symbol - 4])

    assert [w for s in symbols for w in derive(s)] == text.tolist()
    pairs = [tuple(p) for p in zip(symbols[:-1].tolist(), symbols[1:].tolist()) if min(p) >= 0]
    assert len(pairs) == len(set(pairs)) and rounds[-1] == len(homes)
    for rule, home in enumerate(homes):
        assert derive(rule + 4) == text[home : home + size[rule + 4]].tolist()


def test_defined_cases(spark):
    rows = [(1, None, 7), (2, "", 7), (2, " \t\n", 8), (3, "a " * 6, 9), (3, "a " * 6, 9), (None, "a " * 5, 9),
            (4, "é é " * 12, 1), (5, "a b c d " * 50_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    found = periodic.periodic_runs(df)
    assert found.columns == ["doc_id", "text", "runs", "periodic"]
    got = {(r.doc_id, r.text): r.periodic for r in found.collect()}
    assert found.count() == len(rows)
    assert got[(1, None)].n_words == 0 and got[(2, " \t\n")].collapsed == "" and got[(2, "")].runs == []
    assert [tuple(r) for r in got[(3, "a " * 6)].runs] == [(0, 6, 1)] and got[(3, "a " * 6)].collapsed == "a"
    assert got[(None, "a " * 5)].runs == [] and got[(4, "é é " * 12)].collapsed == "é é"
    assert [tuple(r) for r in got[(5, "a b c d " * 50_000)].runs] == [(0, 200_000, 4)]
    assert periodic.periodic_runs(df.limit(0)).count() == 0


def test_planted_repetitions_follow_the_check_sum_of_the_id(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(i, text) for i in range(200)] + [(None, text)], "doc_id long, text string")
    words = text.split()
    for row in periodic.planted(df).collect():
        h = zlib.crc32(str(row.doc_id).encode())
        want = words
        if row.doc_id is not None and h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            want = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert row.text.split() == want
