import base64
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import bpe, fingerprint

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges.load(PATH)


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abeéthein! \n'sß中文aaa٣_", min_size=1, max_size=60), min_size=1, max_size=8))
def test_replay_equals_the_library(merges, reference, texts):
    words = [w for text in texts for w in regex.findall(public_tokenizers.PATTERN, text)]
    got = bpe.replay([w.encode() for w in words], merges)
    assert [i for x in got for i in ids(x)] == [i for text in texts for i in reference.encode_ordinary(text)]


def test_replay_of_long_words_and_of_one_word_alone(merges, reference):
    words = ["a" * 9001, "!" * 5000, "ab" * 3000, "é" * 777, "x"]
    got = bpe.replay([w.encode() for w in words], merges)
    assert [ids(x) for x in got] == [reference.encode_ordinary(w) for w in words]
    assert [bpe.replay_word(w.encode(), merges) for w in words] == got
    assert bpe.replay([], merges) == [] and bpe.replay([b""], merges) == [b""]


def test_merge_that_makes_a_lower_rank():
    """`b c` (rank 300) makes the pair `a bc`, whose rank is lower than that of the pair that came later."""
    lines = [base64.b64encode(bytes([i])) + b" %d" % i for i in range(256)]
    lines += [base64.b64encode(t) + b" %d" % r for t, r in [(b"abc", 290), (b"bc", 300), (b"ab", 310), (b"cab", 320), (b"abcab", 295)]]
    merges = bpe.Merges(lines)
    rng = random.Random(4)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))).encode() for _ in range(500)]
    assert bpe.replay(words, merges) == [bpe.replay_word(w, merges) for w in words]


def test_encode_and_decode_tables(spark, reference):
    texts = ["Hello world's  end\n\n", None, "", "<|endoftext|> is text", "tail " * 20_000, "same", "same", " é中\u0085᠎ x"]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, words string, keys string")
    done = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH)
    assert done.columns == [*docs.columns, "ids", "decoded"]
    for row in done.collect():
        assert ids(row.ids) == reference.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
    assert bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    both = bpe.round_trip(docs.withColumnRenamed("words", "coded"), PATH, public_tokenizers.PATTERN)
    assert sorted(both.columns) == ["coded", "doc_id", "keys", "text"]
    again = {r.doc_id: (bytes(r.coded.ids), bytes(r.coded.decoded)) for r in both.collect()}
    assert again == {r.doc_id: (bytes(r.ids), bytes(r.decoded)) for r in done.collect()}


def test_new_words_are_replayed_in_strips_and_forgotten(merges, reference, monkeypatch):
    monkeypatch.setattr(bpe, "STRIP_BYTES", 7)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    codes = bpe.WordCodes(merges, public_tokenizers.PATTERN)
    texts = ["one two three", "a very long_long_word that no strip holds", None, "one two three", "four five six seven"]
    for _ in range(3):
        assert [ids(x) for x in codes.encoded(texts)] == [reference.encode_ordinary(t or "") for t in texts]
    assert len(codes.codes) <= 5 + sum(len(t.split()) for t in texts if t)


def slow_phrases(data):
    seen, found, start = set(), [], 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in seen:
            seen.add(data[start:end])
            found.append(data[start:end])
            start = end
    return found + ([data[start:]] if start < len(data) else [])


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="abcé ", min_size=1, max_size=200), st.text(alphabet="abcx ", max_size=200))
def test_phrases_and_the_shared_start(text, following):
    data = text.encode()
    ends = fingerprint.Parser().feed(data, 0)
    phrases = slow_phrases(data)
    assert np.cumsum([len(p) for p in phrases]).tolist()[: len(ends)] == [e + 1 for e in ends]
    hashes = fingerprint.phrase_hashes(data, ends)
    assert len(set(hashes.tolist())) == len(set(phrases)) and len(hashes) == len(phrases)
    first, changed, second = fingerprint.both_fingerprints(text, following)
    half = len(text) // 2
    assert changed == text[: len(text) - half] + following[:half]
    assert (first, second) == (fingerprint.fingerprint(text), fingerprint.fingerprint(changed))


def test_likeness():
    base = " ".join(f"w{i * 7919 % 1000}" for i in range(800))
    other = " ".join(f"v{i * 104729 % 1000}z" for i in range(800))
    prints = [fingerprint.fingerprint(t) for t in (base, base + " one more", other, "")]
    assert fingerprint.likeness(prints[0], prints[0]) == 1 and fingerprint.likeness(prints[3], prints[3]) == 1
    assert fingerprint.likeness(prints[0], prints[1]) > 0.9 > 0.5 > fingerprint.likeness(prints[0], prints[2])
    assert fingerprint.likeness(prints[0], prints[3]) == 0


@pytest.mark.parametrize("range_rows", [3, 1000])
def test_fingerprints_follow_the_order_of_ids(spark, range_rows):
    rng = random.Random(1)
    rows = [(rng.randint(-(2**62), 2**62) if i % 3 else i * 1000, "".join(rng.choice("abcd é") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows += [(None, "no id"), (5, None), (6, ""), (7, "x" * 100_000), (8, "same"), (8, "same"), (9, "b"), (9, "a")]
    docs = spark.createDataFrame([(*r, "c", "d") for r in rows], "doc_id long, text string, part string, guest string")
    got = fingerprint.fingerprints(docs.repartition(5), range_rows=range_rows).collect()
    order = sorted(rows, key=lambda r: (-(2**63) if r[0] is None else r[0], r[1] is not None, r[1] or ""))
    want = []
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1]):
        first, changed, second = fingerprint.both_fingerprints(text or "", following or "")
        want.append((doc, len(text or ""), first, second, fingerprint.likeness(first, second), fingerprint.likeness(first, fingerprint.fingerprint(following))))
    assert sorted(((r.doc_id, r.n_chars, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got), key=str) == sorted(want, key=str)


def test_fingerprints_of_one_and_of_no_document(spark):
    one = spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")
    row = fingerprint.fingerprints(one).first()
    assert (row.n_chars, row.near_next) == (6, 1.0)
    assert fingerprint.fingerprints(one.limit(0)).count() == 0
