"""URL filters: host and path rules in a sorted digest array.

The strings of a rule set are kept in one file: their 64-bit xxhash keys in ascending
order, then offsets and the strings themselves.  Tasks memory-map it, probe a batch of
candidate strings with one binary search over the keys, and compare the stored string, so
a digest collision never decides.  A url's candidates are its host and every parent domain
joined with the path prefixes of the lengths that rules have.

The file travels with ``SparkContext.addFile`` and may not exceed ``MAX_INDEX_BYTES``;
``judge_by_join`` takes rule tables of any size.
"""

from __future__ import annotations

import functools
import hashlib
import os
import struct
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkContext, SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planpulse.llm.common import rows_batch, ship

MAX_INDEX_BYTES = 256 << 20
PROBES = 1 << 18


class DigestArray:
    """Strings with a small value each, found by digest; backed by a memory-mapped file."""

    def __init__(self, path: str):
        n, blob = struct.unpack("<QQ", open(path, "rb").read(16))
        part = functools.partial(np.memmap, path, mode="r")
        self.keys = part("<u8", offset=16, shape=(n,)) if n else np.zeros(0, "<u8")
        self.ends = part("<u8", offset=16 + 8 * n, shape=(n,)) if n else self.keys
        self.values = part("u1", offset=16 + 16 * n, shape=(n,)) if n else np.zeros(0, "u1")
        self.blob = part("u1", offset=16 + 17 * n, shape=(blob,)) if blob else np.zeros(0, "u1")

    @staticmethod
    def build(strings: dict[str, int], digest=xxhash.xxh64_intdigest) -> bytes:
        rows = sorted((digest(s.encode()), s.encode(), v) for s, v in strings.items())
        ends = np.cumsum([len(s) for _, s, _ in rows]).astype("<u8")
        blob = b"".join(s for _, s, _ in rows)
        return b"".join([struct.pack("<QQ", len(rows), len(blob)), np.array([k for k, _, _ in rows], "<u8").tobytes(),
                         ends.tobytes(), np.array([v for _, _, v in rows], "u1").tobytes(), blob])

    def stored(self, i: int) -> bytes:
        return self.blob[int(self.ends[i - 1]) if i else 0:int(self.ends[i])].tobytes()

    def find(self, strings: list[bytes], digest=xxhash.xxh64_intdigest) -> np.ndarray:
        """Index of each string, or -1."""
        out = np.full(len(strings), -1, np.int64)
        if not len(self.keys) or not strings:
            return out
        keys = np.fromiter(map(digest, strings), np.uint64, len(strings))
        lo, hi = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        for i in np.flatnonzero(hi > lo).tolist():
            for j in range(int(lo[i]), int(hi[i])):   # more than one only on a collision
                if self.stored(j) == strings[i]:
                    out[i] = j
                    break
        return out


_SENT: set[tuple[str, str]] = set()


def _send(context: SparkContext, name: str, data: bytes) -> None:
    """Give every executor the file, once per application; its name has its digest."""
    if (context.applicationId, name) not in _SENT:
        local = os.path.join(tempfile.mkdtemp(prefix="planpulse-rules-"), name)
        with open(local, "wb") as f:
            f.write(data)
        context.addFile(local)
        _SENT.add((context.applicationId, name))


@functools.lru_cache(maxsize=4)
def _mapped(path: str) -> DigestArray:
    return DigestArray(path)


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z in lower case; else empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.regexp_extract(_after(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to "?", "#" or the end; empty without "://"."""
    return F.coalesce(F.regexp_extract(F.regexp_replace(_after(url), "^[^/?#]+", ""), "^[^?#]*", 0), F.lit(""))


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def split_rule(rule: str) -> tuple[str, str]:
    """A rule is a host and a path that starts with "/", written together."""
    host, slash, path = rule.partition("/")
    if not host or not slash:
        raise ValueError(f"a rule needs a host and a path: {rule!r}")
    return host, slash + path


def judge(pages: DataFrame, rules: dict[str, str], default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every url.

    ``rules``: rule text (``example.org/en/``) -> ``allow`` or ``block``.  A rule fits its
    host and all subdomains if the path starts with its own; the longest rule that fits
    wins (of equally long ones, that with the longer host).  A url that no stored rule fits
    has a null rule and the verdict ``default``.  Null urls and urls without "://" have
    empty host and path; repeated rows are judged alike; further columns are ignored.
    """
    verdicts = ["allow", "block"]
    parsed = {r: split_rule(r) for r in rules}
    data = DigestArray.build({r: verdicts.index(v) for r, v in rules.items()})
    if len(data) > MAX_INDEX_BYTES:
        raise ValueError("too many rules for a file on every executor: use judge_by_join")
    lengths = sorted({len(p) for _, p in parsed.values()}, reverse=True)
    labels = max((h.count(".") + 1 for h, _ in parsed.values()), default=0)
    name = f"rules-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    _send(pages.sparkSession.sparkContext, name, data)
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                        ("rule", pa.string()), ("verdict", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _mapped(SparkFiles.get(name))
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            fits: list[list[int]] = [[] for _ in hosts]
            asked: list[bytes] = []
            whose: list[int] = []

            def ask(asked=asked, whose=whose, fits=fits) -> None:
                found = index.find(asked)
                for k in np.flatnonzero(found >= 0).tolist():
                    fits[whose[k]].append(int(found[k]))
                asked.clear()
                whose.clear()

            for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                new = [x.encode() for x in candidates(host, path, lengths, labels)]
                asked += new
                whose += [i] * len(new)
                if len(asked) >= PROBES:
                    ask()
            ask()
            best = [max(((s := index.stored(j).decode(), j) for j in f),
                        key=lambda x: (len(x[0]), x[0].index("/")), default=(None, -1)) for f in fits]
            yield rows_batch(schema, [batch.column("page_id"), batch.column("host"), batch.column("path"),
                                      [s for s, _ in best],
                                      [default if j < 0 else verdicts[index.values[j]] for _, j in best]])

    return _parts(pages, id_col, url_col).mapInArrow(
        run, "page_id bigint, host string, path string, rule string, verdict string")


def _parts(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    ship(pages.sparkSession)
    url = F.col(url_col).cast("string")
    return pages.select(F.col(id_col).cast("bigint").alias("page_id"), host_of(url).alias("host"),
                        path_of(url).alias("path"))


def candidates(host: str, path: str, lengths: Iterable[int], labels: int) -> list[str]:
    """The rule texts that would fit: parent domains of up to ``labels`` labels, path prefixes."""
    domains, at = [], len(host)
    for _ in range(labels):
        at = host.rfind(".", 0, at)
        domains.append(host[at + 1:])
        if at < 0:
            break
    return [d + path[:n] for n in lengths if n <= len(path) for d in domains if d]


def judge_by_join(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
                  url_col: str = "url") -> DataFrame:
    """The same for a rule table ``rule, verdict`` of any size, as a join on digests.

    Every url's candidates (parent domains times the rules' distinct path lengths) meet the
    rules on the xxhash key and the string itself; the longest is kept per distinct (host,
    path), so repeated urls cost one row.  Rules must be distinct.
    """
    at = F.locate("/", F.col("rule"))
    keyed = rules.select("rule", "verdict", F.xxhash64("rule").alias("_key"), at.alias("_slash"),
                         (F.length("rule") - at + 1).alias("_n"))
    lengths = [r[0] for r in keyed.select("_n").distinct().collect()]   # distinct path lengths: a few numbers
    parts = _parts(pages, id_col, url_col)
    sites = parts.select("host", "path").distinct()
    domain = sites.withColumn("_labels", F.split("host", r"\.")) \
                  .withColumn("_i", F.explode(F.sequence(F.lit(1), F.size("_labels")))) \
                  .withColumn("_domain", F.array_join(F.expr("slice(_labels, _i, size(_labels))"), ".")) \
                  .filter("_domain != ''")
    asked = domain.withColumn("_len", F.explode(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"))) \
                  .filter(F.col("_len") <= F.length("path")) \
                  .select("host", "path", F.concat("_domain", F.expr("substring(path, 1, _len)")).alias("_ask"))
    met = asked.withColumn("_key", F.xxhash64("_ask")).join(keyed, "_key").filter(F.col("_ask") == F.col("rule"))
    best = met.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "_slash")).alias("b"))
    return parts.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict"))
