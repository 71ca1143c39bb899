"""Judge urls by rules and lists kept in a sorted digest array.

The array is one file: 64-bit xxhash keys of hosts in ascending order, where each entry's string lies, and the strings. Every
executor memory-maps its copy. A url's host and all its parent domains are probed by vectorised binary search, and what is found
is confirmed against the stored strings, so colliding keys do no harm. Of the entries that fit, a host with the start of a path,
rules come before lists and the longest wins; of equally long ones a block.

Null urls and urls without `://` have empty host and path and are allowed. Hosts and paths are else taken as they stand.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import shared_root

ALLOW, BLOCK = "allow", "block"
# Largest file that is built; beyond it, split the list.
MOST_BYTES = 1 << 30
LOWER = {c: c + 32 for c in range(65, 91)}


def digest_array(rules: Sequence[tuple[str, str]], listed: Sequence[str]) -> bytes:
    """The file: `rules` are (verdict, host/path), `listed` are blocked host/path, or a host alone, whatever the path."""
    import xxhash

    entries = [("r", verdict, rule) for verdict, rule in rules] + [("l", BLOCK, rule) for rule in listed]
    cells = sorted((xxhash.xxh64_intdigest(rule.partition("/")[0]), f"{kind}\t{v}\t{rule}".encode()) for kind, v, rule in entries)
    keys = np.array([k for k, _ in cells], np.uint64)
    at = np.cumsum([0, *(len(s) for _, s in cells)]).astype(np.uint64)
    raw = np.array([len(cells)], np.uint64).tobytes() + keys.tobytes() + at.tobytes() + b"".join(s for _, s in cells)
    if len(raw) > MOST_BYTES:
        raise ValueError(f"a url index of {len(raw)} bytes is larger than {MOST_BYTES}")
    return raw


def ship(spark: SparkSession, raw: bytes) -> str:
    """Lay the file into the shared folder and have every executor fetch a copy; returns its name."""
    name = f"url-index-{hashlib.sha256(raw).hexdigest()[:20]}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/tidemark/{name}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path) or fs.getFileStatus(path).getLen() != len(raw):
        # aside, then renamed, so that a driver lost meanwhile leaves no half of it under the name
        aside = jvm.org.apache.hadoop.fs.Path(f"{path.toString()}-{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(raw))
        out.close()
        fs.delete(path, False)
        if not fs.rename(aside, path) and not fs.exists(path):
            raise OSError(f"cannot rename {aside.toString()} to {path.toString()}")
    spark.sparkContext.addFile(fs.makeQualified(path).toString())
    return name


class Index:
    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        n = int(raw[:8].view(np.uint64)[0])
        self.keys = raw[8 : 8 + 8 * n].view(np.uint64)
        self.at = raw[8 + 8 * n : 16 + 16 * n].view(np.uint64)
        self.strings = raw[16 + 16 * n :]

    def find(self, hosts: list[str]) -> dict[str, list[tuple[bool, int, bool, str, str]]]:
        """Per host, the entries under just this host: (from a rule, length, blocks, path, rule)."""
        import xxhash

        keys = np.array([xxhash.xxh64_intdigest(h.encode("utf-8", "surrogatepass")) for h in hosts], np.uint64)
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        found = {}
        for i in np.flatnonzero(high > low).tolist():
            own = []
            for e in range(int(low[i]), int(high[i])):
                kind, verdict, rule = bytes(self.strings[int(self.at[e]) : int(self.at[e + 1])]).decode().split("\t")
                host, slash, path = rule.partition("/")
                if host == hosts[i]:
                    own.append((kind == "r", len(rule), verdict == BLOCK, slash + path, rule))
            if own:
                found[hosts[i]] = own
        return found


def split_url(url: str | None) -> tuple[str, str]:
    head, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return rest[:end].translate(LOWER), tail[:stop]


def parents(host: str) -> list[str]:
    """The host and the domains above it."""
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))]


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]], listed: Sequence[str], key: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per page: key, host, path, the rule that decided (null if a list or nothing did), verdict, and the listed entry if any."""
    name = ship(pages.sparkSession, digest_array(rules, listed))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles

        index = Index(SparkFiles.get(name))
        for batch in batches:
            cut = [split_url(u) for u in batch.column(url).to_pylist()]
            domains = sorted({d for h in {h for h, _ in cut} for d in parents(h)})
            found = index.find(domains)
            by_host = {h: [e for d in parents(h) for e in found.get(d, ())] for h in {h for h, _ in cut}}
            rows = []
            for host, path in cut:
                fits = [e for e in by_host[host] if path.startswith(e[3])]
                ruled, _, blocks, _, rule = max(fits, default=(False, 0, False, "", None))
                rows.append((host, path, rule if ruled else None, BLOCK if blocks else ALLOW, None if ruled else rule))
            columns = list(zip(*rows)) or [()] * 5
            made = dict(zip(("host", "path", "rule", "verdict", "listed"), (pa.array(c, pa.string()) for c in columns)))
            yield pa.RecordBatch.from_pydict({key: batch.column(key)} | made)

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, url).mapInArrow(work, f"`{key}` {kind}, host string, path string, rule string, verdict string, listed string")


def allowed(pages: DataFrame, rules: Sequence[tuple[str, str]], listed: Sequence[str], url: str = "url") -> DataFrame:
    """The rows of `pages` whose url is not blocked."""
    name = ship(pages.sparkSession, digest_array(rules, listed))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles

        index = Index(SparkFiles.get(name))
        for batch in batches:
            cut = [split_url(u) for u in batch.column(url).to_pylist()]
            found = index.find(sorted({d for h in {h for h, _ in cut} for d in parents(h)}))
            good = []
            for host, path in cut:
                fits = [e for d in parents(host) for e in found.get(d, ()) if path.startswith(e[3])]
                good.append(not max(fits, default=(False, 0, False))[2])
            yield batch.filter(pa.array(good, pa.bool_()))

    return pages.mapInArrow(work, pages.schema)
