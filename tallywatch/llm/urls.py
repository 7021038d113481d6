"""URL filters: rules and listed hosts in sorted arrays of 64-bit digests."""
from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm.words import ready

#: A digest array is broadcast; a longer list is probed array by array.
ARRAY_BYTES = 64 << 20
JUDGED = "page_id long, url string, host string, path string, rule string, verdict string"


class DigestArray:
    """Keys sorted by their 64-bit xxhash. Digests lie in a memory-mapped file of the worker's own; full keys stand beside them,
    so a probe whose digest collides is not mistaken for the key."""

    def __init__(self, keys: list[str], verdicts: list[str]):
        import xxhash

        digest = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        order = np.argsort(digest, kind="stable")
        self.keys, self.verdicts = [keys[i] for i in order], [verdicts[i] for i in order]
        self.digest = digest[order]
        self.lengths = sorted({len(k.partition("/")[1] + k.partition("/")[2]) for k in keys})

    def mapped(self) -> DigestArray:
        """The same array with its digests read through a mapping; the unnamed file goes with the worker."""
        if len(self.digest):
            with tempfile.TemporaryFile() as f:
                f.write(self.digest.tobytes())
                f.flush()
                self.digest = np.memmap(f, np.uint64, "r", shape=self.digest.shape)
        return self

    def probe(self, candidates: list[str]) -> np.ndarray:
        """Index of each candidate among the keys, or -1: binary search by digest, then comparison of whole strings."""
        import xxhash

        if not candidates or not len(self.digest):
            return np.full(len(candidates), -1)
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, candidates), np.uint64, len(candidates))
        low, high = np.searchsorted(self.digest, wanted, "left"), np.searchsorted(self.digest, wanted, "right")
        found = np.full(len(candidates), -1)
        for i in np.flatnonzero(low < high):
            found[i] = next((k for k in range(low[i], high[i]) if self.keys[k] == candidates[i]), -1)
        return found


def split_url(url: str | None) -> tuple[str, str]:
    """Host (after the first ://, A-Z lower-cased) and path; both empty without ://."""
    _, sign, rest = (url or "").partition("://")
    if not sign:
        return "", ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[cut:]
    return rest[:cut].translate(_LOWER), path[:next((i for i, c in enumerate(path) if c in "?#"), len(path))]


_LOWER = {65 + i: 97 + i for i in range(26)}


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """Every host suffix at a dot with every beginning of the path that has the length of some rule's path."""
    labels = host.split(".")
    paths = [path[:n] for n in lengths if n <= len(path)]
    return [".".join(labels[i:]) + p for i in range(len(labels)) for p in paths]


def judge(pages: DataFrame, rules: list[tuple[str, str]], listed: list[str] = (), array_bytes: int = ARRAY_BYTES) -> DataFrame:
    """page_id, url, host, path, rule (the longest that fits, or null) and verdict.

    `rules` are (key, verdict) with key = host + path, as in ("example.com/en/", "block"); a rule fits its host and all
    subdomains if the path starts with the rule's path. `listed` are hosts whose pages are blocked where no rule fits; all other
    pages are allowed. Method: keys lie in sorted digest arrays; a url's candidate keys (host suffixes by path beginnings) are
    probed by binary search, and the stored strings decide. Arrays longer than `array_bytes` of keys are split and probed in turn.

    Null url or no ://: host and path are empty, no rule fits. Repeated rows: each is judged. Empty table: no rows.
    """
    ready(pages.sparkSession)
    given = sorted({(k, v) for k, v in rules} | {(f"{h}\0", "block") for h in listed})
    blocks: list[list[tuple[str, str]]] = [[]]
    size = 0
    for key, verdict in given:
        if size > array_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append((key, verdict))
        size += len(key) + 64
    out = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"], F.lit("").alias("host"), F.lit("").alias("path"),
                       F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    for block in blocks:
        out = out.mapInArrow(_probe(pages.sparkSession, block), JUDGED)
    return out


def _probe(spark: SparkSession, block: list[tuple[str, str]]):
    shared = spark.sparkContext.broadcast(block)
    cache: dict[int, DigestArray] = {}

    def run(batches):
        if os.getpid() not in cache:
            cache[os.getpid()] = DigestArray([k for k, _ in shared.value], [v for _, v in shared.value]).mapped()
        array = cache[os.getpid()]
        lengths = [n for n in array.lengths if n > 0]
        for batch in batches:
            split = [split_url(u) for u in batch.column("url").to_pylist()]
            tried: list[str] = []
            owner: list[int] = []
            for i, (host, path) in enumerate(split):
                own = candidates(host, path, lengths) + [f"{h}\0" for h in candidates(host, "", [0])] if host else []
                tried += own
                owner += [i] * len(own)
            rule, verdict = batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()
            found = array.probe(tried)
            for j in np.flatnonzero(found >= 0):
                i, key = owner[j], tried[j]
                if key[-1] != "\0" and len(key) > len(rule[i] or ""):
                    rule[i], verdict[i] = key, array.verdicts[found[j]]
                elif key[-1] == "\0" and rule[i] is None:
                    verdict[i] = "block"
            columns = [pa.array([h for h, _ in split], pa.string()), pa.array([p for _, p in split], pa.string()), pa.array(rule, pa.string()), pa.array(verdict, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *columns], ["page_id", "url", "host", "path", "rule", "verdict"])

    return run
