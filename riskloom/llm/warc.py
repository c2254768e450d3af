"""WARC archives of captures, their index merged from sorted runs, and reading back by the index.

`write_archives` stores each row as a record of WARC/1.1 in gzip members of their own, so that a record can be
read alone. Of captures with equal payloads the one with the largest id is a `response`, the others are
`revisit` records that name it and hold no payload; payloads below `min_bytes` are always stored.

Method of the index, an external merge: every writing task sorts the entries of its records by URL key, time and
id into runs of bounded length. `capture_histories` cuts the key space into ranges of bounded size, brings
the slices of all runs that fall into a range together, still sorted, and merges them with a loser tree.
Ranges are in order, and so are the entries in each: the histories of all URLs, globally ordered.
`read_archives` reads the records that entries name, file by file in the order of their offsets, and
checks each payload against its digest.

Archive files have names that no other attempt of a task uses, and only files that the stored index names are
read, so that a task which runs again does no harm; what a failed attempt left is never read.

Defined cases: a null payload is an empty one; a null URL has an empty key and no target in its record; blanks
and control signs of a URL are percent-encoded; a null time is the first second of 1970; a null id is less
than any other and is read back as null; rows with equal ids and payloads are all responses if the id is
the largest, else all revisits; other columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import give_back, join_counted, small_batches, table
from riskloom.operators.joins import broadcast_if_small
from riskloom.session import materialize, scratch_path

#: Bytes of an archive before the next one starts, entries of a run, entries of a merged range.
FILE_BYTES, RUN_ROWS, RANGE_ROWS = 256 << 20, 50_000, 200_000
LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ENTRY = [
    ("run", pa.string()), ("place", pa.int64()), ("url_key", pa.string()), ("at", pa.string()), ("id", pa.int64()),
    ("file", pa.string()), ("offset", pa.int64()), ("size", pa.int64()),
]
ENTRY = "run string, place bigint, url_key string, at string, id bigint, file string, offset bigint, size bigint"
CAPTURE = "id bigint, url string, at string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's address, and the folder on it."""
    if re.match(r"(file:)?/", folder):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", folder)
    return fs.FileSystem.from_uri(folder)


def url_key(url: str | None) -> str:
    """The host's labels from the last to the first, then path and query, A-Z of the host lower-cased."""
    if not url:
        return ""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    host = re.split("[/?]", rest, maxsplit=1)[0]
    name = host.rsplit("@", 1)[-1].encode().lower().decode().removeprefix("www.")
    return ",".join(reversed(name.split("."))) + ")" + (rest[len(host) :] or "/")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One WARC record as a gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{name}: {value}" for name, value in fields if value is not None]]
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def capture_record(id_: int | None, url: str | None, at: str, payload: bytes, refers_to: int | None) -> bytes:
    """The record of a capture: a response, or a revisit of the response with the id `refers_to`."""
    revisit = refers_to is not None
    target = url and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    fields = [
        ("WARC-Record-ID", f"<urn:record:{'' if id_ is None else id_}>"), ("WARC-Date", at), ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("WARC-Profile", PROFILE if revisit else None), ("WARC-Refers-To", f"<urn:record:{refers_to}>" if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return record("revisit" if revisit else "response", fields, http if revisit else http + payload)


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """The fields of a record, their names in lower case, and its block."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def _number(uri: str | None) -> int | None:
    digits = (uri or "").removeprefix("<urn:record:").removesuffix(">")
    return int(digits) if digits else None


def revisits(captures: DataFrame, min_bytes: int) -> DataFrame:
    """(id, digest, refers_to) of the captures that repeat the payload of one with a larger id."""
    thin = materialize(captures.select("id", "digest", F.octet_length("payload").alias("bytes")), "warc-payloads")
    groups = thin.where(F.col("bytes") >= min_bytes).groupBy("digest")
    groups = groups.agg(F.count("*").alias("count"), F.max("id").alias("refers_to")).where("count > 1 AND refers_to IS NOT NULL")
    found = join_counted(thin, materialize(groups, "warc-groups"), "digest", thin.count())
    return found.where("id IS NULL OR id < refers_to").select("id", "digest", "refers_to").distinct()


def write_archives(
    captures: DataFrame,
    folder: str,
    id_col: str = "id",
    url_col: str = "url",
    payload_col: str = "payload",
    at_col: str | None = None,
    min_bytes: int = 0,
) -> DataFrame:
    """Write a record for each row below `folder`; returns the stored index, sorted runs of entries."""
    spark = captures.sparkSession
    small_batches(spark)
    at: Column = F.col(at_col).cast("timestamp_ntz") if at_col else F.lit(None).cast("timestamp_ntz")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = captures.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("1970-01-01T00:00:00Z")).alias("at"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
    )
    again = broadcast_if_small(materialize(revisits(rows, min_bytes), "warc-revisits"))
    again = again.withColumnsRenamed({"id": "of", "digest": "its"})
    judged = rows.join(again, rows.id.eqNullSafe(again.of) & (rows.digest == again.its), "left")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = store(folder)
        system.create_dir(base, recursive=True)
        out, name, offset, entries, runs = None, "", 0, [], 0

        def run() -> pa.RecordBatch:
            entries.sort(key=lambda e: (e[0], e[1], e[2] is not None, e[2] or 0, e[3], e[4]))
            title = f"{name}-{runs}"
            columns = [[title] * len(entries), list(range(len(entries))), *map(list, zip(*entries))]
            entries.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, (_, kind) in zip(columns, _ENTRY)], [field for field, _ in _ENTRY]
            )

        for batch in batches:
            for id_, url, time, body, refers_to in zip(*(column.to_pylist() for column in batch.columns)):
                if out is None:
                    name, offset = f"archive-{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                    info = record("warcinfo", [
                        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", time), ("WARC-Filename", name),
                        ("Content-Type", "application/warc-fields"),
                    ], b"software: riskloom\r\nformat: WARC File Format 1.1\r\n")
                    out.write(info)
                    offset = len(info)
                member = capture_record(id_, url, time, body, refers_to)
                out.write(member)
                entries.append((url_key(url), time, id_, name, offset, len(member)))
                offset += len(member)
                if offset >= FILE_BYTES:
                    out.close()
                    out = None
                if len(entries) >= RUN_ROWS:
                    yield run()
                    runs += 1
        if out is not None:
            out.close()
        if entries:
            yield run()
        batch = None  # noqa: F841
        give_back()

    return materialize(judged.select("id", "url", "at", "payload", "refers_to").mapInArrow(written, ENTRY), "warc-index")


class LoserTree:
    """Merges sorted lists: each inner node keeps the loser of its match, so that the next smallest entry
    costs one match for each level above the list it comes from."""

    def __init__(self, lists: list[list]):
        self.lists, self.next = lists, [0] * len(lists)
        self.k = len(lists)
        self.losers = [-1] * max(self.k, 1)
        winners = [-1] * self.k + list(range(self.k))
        for node in range(self.k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        """Whether list a goes first: an ended list never does, and of equal entries the earlier list's goes first."""
        left, right = self.lists[a], self.lists[b]
        i, j = self.next[a], self.next[b]
        if i >= len(left) or j >= len(right):
            return j >= len(right) and (i < len(left) or a < b)
        return left[i] < right[j] or (left[i] == right[j] and a < b)

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(list, position) of every entry in order."""
        for _ in range(sum(map(len, self.lists))):
            at = self.winner
            yield at, self.next[at]
            self.next[at] += 1
            node = (at + self.k) // 2
            while node >= 1:
                if self._before(self.losers[node], at):
                    at, self.losers[node] = self.losers[node], at
                node //= 2
            self.winner = at


def capture_histories(index: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The entries of all runs in the order of URL key, time and id: columns part and place give the order."""
    keys = ["url_key", "at", "id"]
    parts = -(-index.count() // range_rows) or 1
    # Run and place keep entries with equal keys from being one indivisible range.
    ranged = index.repartitionByRange(parts, *keys, "run", "place").withColumn("part", F.spark_partition_id())
    slices = ranged.sortWithinPartitions("run", "place")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if held is None:
            return
        runs = held.column("run").to_pylist()
        starts = [i for i, run in enumerate(runs) if not i or run != runs[i - 1]]
        urls, times, ids = (held.column(c).to_pylist() for c in keys)
        entries = [(u, t, i is not None, i or 0) for u, t, i in zip(urls, times, ids)]
        lists = [entries[a:b] for a, b in zip(starts, [*starts[1:], len(entries)])]
        order = [starts[run] + place for run, place in LoserTree(lists)]
        done = held.take(order).set_column(held.schema.get_field_index("place"), "place", pa.array(range(len(order)), pa.int64()))
        yield from done.drop_columns("run").combine_chunks().to_batches(max_chunksize=10_000)
        held = done = entries = lists = None  # noqa: F841
        give_back()

    made = slices.mapInArrow(merged, f"{ENTRY.removeprefix('run string, ')}, part int")
    return materialize(made, "warc-histories")


def read_archives(entries: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The captures that entries of the index name, from their records; with `payloads` also what they hold.

    The payload of a revisit is in the record it refers to, so its size and payload are null here;
    `resolved` gives it the size.
    """
    fields = [
        ("id", pa.int64()), ("url", pa.string()), ("at", pa.string()), ("record_type", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
    ] + [("payload", pa.binary())] * payloads

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = store(folder)
        name, file = None, None
        for batch in batches:
            rows = []
            for wanted, offset, size in zip(*(column.to_pylist() for column in batch.columns)):
                if wanted != name:
                    if file is not None:
                        file.close()
                    name, file = wanted, system.open_input_file(f"{base}/{wanted}")
                head, block = parse_record(file.read_at(size, offset))
                payload = block.partition(b"\r\n\r\n")[2] if head["warc-type"] == "response" else None
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                if payload is not None and digest_of(payload) != digest:
                    raise ValueError(f"{wanted} at {offset}: the payload is not what its digest says")
                row = (
                    _number(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-date"], head["warc-type"],
                    None if payload is None else len(payload), digest, _number(head.get("warc-refers-to")),
                )
                rows.append(row + (payload,) * payloads)
            columns = zip(*rows) if rows else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, fields)], [f for f, _ in fields])
        if file is not None:
            file.close()
        batch = None  # noqa: F841
        give_back()

    small_batches(entries.sparkSession)
    wanted = entries.select("file", "offset", "size").repartition("file").sortWithinPartitions("file", "offset")
    return wanted.mapInArrow(opened, CAPTURE + ", payload binary" * payloads)


def resolved(captures: DataFrame) -> DataFrame:
    """Captures read back, revisits with the payload size of the response they refer to."""
    captures = materialize(captures, "warc-read")
    sizes = captures.groupBy(F.col("payload_digest").alias("digest"))
    sizes = materialize(sizes.agg(F.max("payload_bytes").alias("full"), F.count("*").alias("count")), "warc-sizes")
    again = captures.where("record_type = 'revisit'").withColumnRenamed("payload_digest", "digest")
    found = join_counted(again, sizes, "digest", captures.count()).withColumn("payload_bytes", F.col("full"))
    found = found.withColumnRenamed("digest", "payload_digest").select(*captures.columns)
    return captures.where("record_type <> 'revisit'").unionByName(found)


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    # The table has no times of capture; the pages count as fetched one a second.
    at = F.timestamp_seconds(1_704_067_200 + F.col("page_id")).cast("timestamp_ntz")
    pages = table(spark, folder, "pages").select("page_id", "url", "html", at.alias("at"))
    archives = scratch_path(spark, "warc")
    index = write_archives(pages, archives, "page_id", "url", "html", "at")
    found = resolved(read_archives(capture_histories(index), archives))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages),
bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(cast('0x' || substr(h, i, 1) AS INT)), 4, '0')), '') AS b
  FROM payloads)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_reduce(
         list_transform(range(1, 6), lambda j: cast(substr(b, 5 * i + j, 1) AS INT)), lambda x, y: 2 * x + y), 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM bits
"""
