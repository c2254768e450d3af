"""URL filters by a bit-parallel wildcard automaton.

Rules are globs over a canonical address, host followed by path: `*` stands for any run of bytes
without a slash, `**` for any run. All globs together form one multiword Shift-And automaton: one bit
for each state, a mask for each byte with the states that it leads to, and masks of the states that a
wildcard holds. One step of a block of addresses advances all globs for all of its addresses.

A domain rule such as `net/` fits its host and all subdomains where the path starts with the rule's;
it becomes the globs `net/**` and `*.net/**`. The longest fitting domain rule decides, of equally long
ones the first; without one, an address that a further glob fits is blocked, and others are allowed.

Defined cases: a null address, or one without `://`, has an empty host and path, no rule, and is
allowed unless a glob fits the empty address; repeated rows get equal verdicts; other columns are carried
along or not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import blocks, small_batches, table

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: Addresses that seldom hold prose: advertising hosts, account pages, shops' baskets, downloads.
GLOBS = ["ad.*/**", "ads.*/**", "**/login", "**/login/**", "**/cart/**", "**/*.exe", "**/*.zip", "**/tag/**"]


def canonical(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path of an address; both empty without `://`."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = min((at for sign in "?#" if (at := rest.find(sign)) >= 0), default=len(rest))
    host, slash, path = rest[:end].partition("/")
    return host.encode().lower().decode(), slash + path


class Automaton:
    """All globs as one Shift-And automaton of `words` 64-bit words; both ends are anchored."""

    def __init__(self, globs: list[str]):
        states: list[tuple[int | None, int]] = []  # the byte that leads to a state, and what holds it
        starts, ends = [], []
        for glob in globs:
            starts.append(len(states))
            states.append((None, 0))
            data, at = glob.encode(), 0
            while at < len(data):
                if data[at : at + 1] == b"*":
                    wide = data[at : at + 2] == b"**"
                    states[-1] = (states[-1][0], max(states[-1][1], 2 if wide else 1))
                    at += 2 if wide else 1
                else:
                    states.append((data[at], 0))
                    at += 1
            ends.append(len(states) - 1)
        self.words = max(1, -(-len(states) // 64))
        self.start = self._mask(starts)
        self.ends = np.array(ends, np.int64)
        self.step = np.array([self._mask([i for i, (b, _) in enumerate(states) if b == byte]) for byte in range(256)])
        held = [self._mask([i for i, (_, hold) in enumerate(states) if hold >= least]) for least in (1, 2)]
        self.hold = np.array([held[1] if byte == ord("/") else held[0] for byte in range(256)])

    def _mask(self, bits: list[int]) -> np.ndarray:
        mask = [0] * self.words
        for bit in bits:
            mask[bit // 64] |= 1 << bit % 64
        return np.array(mask, np.uint64)

    def fits(self, addresses: list[str]) -> np.ndarray:
        """A row for each address and a column for each glob: whether the glob fits the whole address."""
        data = [address.encode() for address in addresses]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        order = np.argsort(-sizes, kind="stable")
        offsets = (np.cumsum(sizes) - sizes)[order]
        flat, sizes = np.frombuffer(b"".join(data), np.uint8), sizes[order]
        state = np.tile(self.start, (len(data), 1))
        one, carry = np.uint64(1), np.uint64(63)
        for at in range(int(sizes[0]) if len(data) else 0):
            live = int(np.searchsorted(-sizes, -at))  # the longer addresses come first
            byte, now = flat[offsets[:live] + at], state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> carry
            state[:live] = (moved & self.step[byte]) | (now & self.hold[byte])
        fit = (state[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64)) & one
        out = np.empty((len(data), len(self.ends)), bool)
        out[order] = fit.astype(bool)
        return out


class UrlFilter:
    def __init__(self, rules: list[tuple[str, str]], globs: list[str]):
        self.rules, n = rules, len(rules)
        self.automaton = Automaton([f"{rule}**" for _, rule in rules] + [f"*.{rule}**" for _, rule in rules] + globs)
        self.order = sorted(range(n), key=lambda i: -len(rules[i][1]))

    def judge(self, urls: list[str | None]) -> list[dict]:
        parts, n = [canonical(url) for url in urls], len(self.rules)
        fits = self.automaton.fits([host + path for host, path in parts])
        ruled = (fits[:, :n] | fits[:, n : 2 * n])[:, self.order]
        first = np.where(ruled.any(axis=1), ruled.argmax(axis=1), -1).tolist() if n else [-1] * len(urls)
        blocked = fits[:, 2 * n :].any(axis=1).tolist()
        out = []
        for (host, path), best, bad in zip(parts, first, blocked):
            verdict, rule = self.rules[self.order[best]] if best >= 0 else ("block" if bad else "allow", None)
            out.append({"host": host, "path": path, "rule": rule, "verdict": verdict})
        return out


def judged(spark: SparkSession, url_col: str = "url", rules=RULES, globs=GLOBS) -> Column:
    """A struct of host, path, rule and verdict for each address."""
    small_batches(spark)
    made = UrlFilter(list(rules), list(globs))
    kind = pa.struct([(name, pa.string()) for name in ("host", "path", "rule", "verdict")])

    @F.arrow_udf("host string, path string, rule string, verdict string")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            done = [row for block in blocks(batch.to_pylist()) for row in made.judge(block)]
            yield pa.array(done, kind)

    return apply(url_col)


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return pages.select("page_id", judged(spark).alias("found")).select("page_id", "found.*")


ORACLE = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, 1, strpos(rest, '/') - 1) ELSE coalesce(rest, '') END AS raw,
         CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM parts),
hosts AS (
  SELECT page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM split),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM hosts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host || path, '^ads?\.[^/]*/') OR regexp_matches(path, '/login$|/login/|/cart/|/tag/|/[^/]*\.(exe|zip)$')
    THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
