import random
import re
from collections import Counter

import pytest

from riskloom.llm import spelling


def one_edit(a, b):
    """Whether one inserted, deleted or replaced sign makes a into b."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[head + 1 :] == b[head + 1 :]
    short, long = sorted((a, b), key=len)
    return short[head:] == long[head + 1 :]


def brute_groups(counts, times=5):
    out = {}
    for word, n in counts.items():
        near = [v for v in counts if one_edit(word, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        out[word] = [form, n, len(near), counts[form] if form else None]
    for word in out:
        root = word
        while out[root][0]:
            root = out[root][0]
        out[word].insert(1, root)
    return {word: tuple(row) for word, row in out.items()}


def groups(spark, counts):
    found = spelling.spelling_groups(spark.createDataFrame(list(counts.items()) or [], "word string, n long")).collect()
    assert len(found) == len(counts)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found}


def similar_words(seed, signs, bases, edits, spread):
    rng = random.Random(seed)
    counts = Counter()
    for _ in range(bases):
        word = "".join(rng.choice(signs) for _ in range(rng.randint(6, 14)))
        for _ in range(edits):
            counts[word] = rng.choice(spread)
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(signs) + word[at:],
                               word[:at] + rng.choice(signs) + word[at + 1 :]])
            if len(word) < 6:
                break
    return dict(counts)


@pytest.mark.parametrize("rare, most, block", [(32, 200_000, 2000), (2, 200_000, 3), (1, 40, 2000)])
def test_groups_equal_brute_force(spark, monkeypatch, rare, most, block):
    monkeypatch.setattr(spelling, "RARE", rare)
    monkeypatch.setattr(spelling, "MOST_GRAMS", most)
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (block,))
    counts = similar_words(1, "abcé", 60, 9, [5, 5, 30, 160, 900]) | similar_words(2, "ab", 25, 12, [5, 26, 131])
    counts |= {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "aaaaaaaaa": 625, "b" * 300: 5, "b" * 299 + "a": 25, "ÿÀÿÀÿÀ": 7}
    assert groups(spark, counts) == brute_groups(counts)


def test_a_list_with_a_third_of_all_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "RARE", 4)
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (50,))
    rng = random.Random(4)
    counts = {"abcd" + "".join(rng.choice("efghij") for _ in range(rng.randint(2, 4))): rng.choice([5, 40]) for _ in range(500)}
    assert groups(spark, counts) == brute_groups(counts)


def test_two_lists_reach_every_near_word():
    """An edit of a word leaves one of the two grams, at its distance from the start or the end."""
    rng = random.Random(6)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(6, 12)))
        frequent = {g: rng.randint(1, 99) for q in range(2, 8) for i in range(12 - q)
                    if rng.random() < 0.7 for g in ["".join(rng.choice("^abc$") for _ in range(q))]}
        frequent |= {f"^{word}$"[i : i + q]: 50 for q in range(2, 8) for i in range(len(word) + 3 - q) if rng.random() < 0.8}
        most = spelling.longest_gram(len(word))
        marked = f"^{word}$"
        sizes = spelling.gram_sizes(marked, most, frequent)
        left, right = spelling.cheapest_pair(marked, sizes, frequent)
        assert left + sizes[left] <= right
        for other in {word[:i] + c + word[j:] for i in range(len(word) + 1) for j in (i, i + 1) for c in ("", "a", "z")}:
            if not one_edit(word, other) or len(other) < 5:
                continue
            changed = f"^{other}$"
            of = spelling.gram_sizes(changed, most, frequent)
            at = len(changed) - (len(marked) - right)
            keeps_left = left < len(of) and changed[left : left + of[left]] == marked[left : left + sizes[left]]
            keeps_right = 0 <= at < len(of) and changed[at : at + of[at]] == marked[right : right + sizes[right]]
            assert keeps_left or keeps_right, (word, other)


def test_frequent_grams_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MOST_GRAMS", 30)
    words = spark.createDataFrame([(w, 5) for w in similar_words(3, "abc", 80, 5, [5])], "word string, n long")
    found, rare = spelling.frequent_grams(words)
    assert rare >= spelling.RARE and len(found) <= 30 and all(n > rare for n in found.values())


def test_counts_and_defined_cases(spark):
    rows = [(1, "Letter letter LETTER, leTTer-letter", "x"), (1, "Letter", "x"), (2, None, "x"), (3, "", None),
            (None, "letter élèves ÉLÈVES short élèves élèves élèves élèves", "x"), (4, "x" * 50_000 + " ab", "x"), (4, "y×÷zzzz " * 5, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    got = {r.word: r.n for r in spelling.word_counts(df).collect()}
    assert got == {"letter": 7, "élèves": 5, "y×÷zzzz": 5}
    assert spelling.word_counts(df, min_count=1, min_chars=1).where("word = 'É'").count() == 0
    empty = spelling.spelling_groups(spelling.word_counts(df.limit(0)))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_the_lost_letter_changes_words_of_documents(spark):
    text = " ".join("".join(random.Random(i).choice("abcde") for _ in range(8)) for i in range(400))
    df = spark.createDataFrame([(i, text) for i in range(12)], "doc_id long, text string")
    want = Counter()
    for doc in range(12):
        for word in re.findall("[a-z]+", text):
            want[spelling.letter_lost(str(doc), word)] += 1
    got = spelling.word_counts(df, change=spelling.letter_lost, min_count=1).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in want.items() if len(w) >= 6}
    assert any(len(w) == 7 for w in want)
