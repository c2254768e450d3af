import gzip
import random
from pathlib import Path

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.llm import warc


def test_url_keys():
    assert warc.url_key("http://WWW.Example.com/A/b?q=1#top") == "com,example)/A/b?q=1"
    assert warc.url_key("https://a.b.org") == "org,b,a)/" and warc.url_key("https://a.org?x") == "org,a)?x"
    assert warc.url_key(None) == "" and warc.url_key("") == "" and warc.url_key("no scheme/x") == "no scheme)/x"


@given(st.lists(st.lists(st.integers(0, 9).map(lambda n: (n,))).map(sorted), min_size=1, max_size=9))
def test_the_loser_tree_merges_stably(lists):
    got = list(warc.LoserTree(lists))
    want = sorted((entry, k, i) for k, held in enumerate(lists) for i, entry in enumerate(held))
    assert got == [(k, i) for _, k, i in want]


@pytest.mark.parametrize("body", [b"", b"\r\n\r\n", "é\r\n\r\nWARC/1.1\r\n".encode(), b"x" * 3_000_000])
def test_records_round_trip(body):
    fields, block = warc.parse_record(warc.capture_record(7, "http://a/ b\n", "2024-01-01T00:00:00Z", body, None))
    assert block.partition(b"\r\n\r\n")[2] == body and fields["warc-target-uri"] == "http://a/%20b%0A"
    assert fields["warc-record-id"] == "<urn:record:7>" and fields["warc-type"] == "response"
    fields, block = warc.parse_record(warc.capture_record(None, None, "2024-01-01T00:00:00Z", body, 9))
    assert fields["warc-type"] == "revisit" and fields["warc-refers-to"] == "<urn:record:9>" and block.endswith(b"\r\n\r\n")
    assert fields["warc-payload-digest"] == f"sha1:{warc.digest_of(body)}" and "warc-target-uri" not in fields


def captures(spark, rows):
    return spark.createDataFrame(rows, "id long, url string, html string, digest string, file string, at timestamp")


@pytest.fixture
def rows():
    rng = random.Random(8)
    kinds = ["", "same", "same\r\n\r\n", "é" * 400, None]
    rows = [(i, f"http://h{rng.randrange(5)}.org/{rng.randrange(9)}", rng.choice(kinds) if i % 3 else "hot", "d", "f", None)
            for i in range(400)]
    rows += [(1000, None, "alone", "d", "f", None), (1000, None, "alone", "d", "f", None), (5, "http://x/", "twice", "d", "f", None),
             (5, "http://x/", "twice", "d", "f", None), (6, "http://x/", "twice", "d", "f", None), (None, "http://y/", "none", "d", "f", None),
             (None, "http://y/", "twice", "d", "f", None), (2000, "http://long/", "long " * 400_000, "d", "f", None)]
    return rows


def brute(rows, least):
    out = []
    for id_, url, html, *_ in rows:
        payload = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == payload and r[0] is not None]
        top = max(same, default=None)
        again = len(payload) >= least and top is not None and (id_ is None or id_ < top)
        out.append((id_, url, len(payload), warc.digest_of(payload), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_archives_read_back_equal_brute_force(spark, rows, tmp_path, monkeypatch, least):
    monkeypatch.setattr(warc, "FILE_BYTES", 4000)
    monkeypatch.setattr(warc, "RUN_ROWS", 7)
    folder = str(tmp_path / "archives")
    index = warc.write_archives(captures(spark, rows), folder, "id", "url", "html", "at", least)
    histories = warc.capture_histories(index, 50)
    read = warc.read_archives(histories, f"file://{folder}", payloads=True)
    got = warc.resolved(read.drop("payload")).collect()
    columns = ("id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == brute(rows, least)
    held = {(r.id, r.payload_digest): bytes(r.payload) for r in read.where("record_type = 'response'").collect()}
    for id_, _, html, *_ in rows:
        payload = (html or "").encode()
        assert held.get((id_, warc.digest_of(payload)), payload) == payload
    # Every file is a sequence of gzip members: a warcinfo record and the captures.
    names = {r.file for r in index.select("file").distinct().collect()}
    assert len(names) > 8
    text = b"".join(gzip.decompress((Path(folder) / name).read_bytes()) for name in names)
    assert text.count(b"WARC-Type: warcinfo\r\n") == len(names)
    assert text.count(b"WARC-Type: response\r\n") + text.count(b"WARC-Type: revisit\r\n") == len(rows)


def test_histories_are_globally_ordered(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RUN_ROWS", 5)
    hot = [(3000 + i % 50, "http://hot.org/", f"body {i}", "d", "f", None) for i in range(300)]
    df = captures(spark, rows + hot).withColumn("at", F.timestamp_seconds(F.coalesce(F.col("id") % 4, F.lit(0))))
    index = warc.write_archives(df, str(tmp_path / "a"), "id", "url", "html", "at")
    runs = {}
    for r in index.orderBy("run", "place").collect():
        runs.setdefault(r.run, []).append((r.url_key, r.at, r.id is not None, r.id or 0))
    assert max(map(len, runs.values())) <= 5 and all(run == sorted(run) for run in runs.values())
    found = warc.capture_histories(index, 60)
    got = [(r.url_key, r.at, r.id is not None, r.id or 0) for r in found.orderBy("part", "place").collect()]
    assert got == sorted(got) and len(got) == len(rows) + len(hot)
    sizes = [r["count"] for r in found.groupBy("part").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 200  # a hot URL with equal times is cut, too


def test_a_damaged_record_is_noticed(spark, tmp_path):
    index = warc.write_archives(captures(spark, [(1, "http://a/", "text", "d", "f", None)]), str(tmp_path / "a"), "id", "url", "html")
    entry = index.first()
    path = tmp_path / "a" / entry.file
    data = bytearray(path.read_bytes())
    member = warc.capture_record(1, "http://a/", "1970-01-01T00:00:00Z", b"texx", None)
    fields, _ = warc.parse_record(member)
    forged = gzip.compress(gzip.decompress(bytes(data[entry.offset :])).replace(b"\r\n\r\ntext", b"\r\n\r\ntexx"))
    path.write_bytes(bytes(data[: entry.offset]) + forged)
    with pytest.raises(Exception, match="digest"):
        warc.read_archives(index.withColumn("size", F.lit(len(forged)).cast("long")), str(tmp_path / "a")).count()


def test_an_empty_table(spark, tmp_path):
    index = warc.write_archives(captures(spark, []), str(tmp_path / "a"), "id", "url", "html")
    read = warc.resolved(warc.read_archives(warc.capture_histories(index), str(tmp_path / "a")))
    assert read.count() == 0 and "record_type" in read.columns
