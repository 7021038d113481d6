"""Benchmark decontamination: suffix arrays over the training texts, searched for every suffix of the benchmark."""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.words import FOLDED, U64, ranges, ready, text_bytes, word_chunks

#: A block of the benchmark is broadcast; its size is checked, and a larger benchmark is searched block by block.
BLOCK_BYTES = 16 << 20
#: Stands for a null item_id while texts are searched.
NAMELESS = -1 << 62
FOUND = "doc_id long, n_words long, hits array<struct<start:int,stop:int>>, matches array<struct<item_id:long,item_at:int,doc_at:int,length:int>>"


class Suffixes:
    """The benchmark's words as small numbers, and its suffixes cut at `window` words, packed into comparable bytes."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        self.window = window
        self.item_id = np.array([i for i, _ in items], np.int64)
        chunks = list(word_chunks(pa.array([t for _, t in items], pa.string()), FOLDED, 1 << 40))
        self.first = chunks[0].first if chunks else np.zeros(1, np.int64)
        hashes = chunks[0].hash if chunks else np.zeros(0, U64)
        self.vocabulary, word = np.unique(hashes, return_inverse=True)
        self.word = word.astype(np.int64) + 1
        length = np.diff(self.first)
        owner = np.repeat(np.arange(len(length)), length)
        inside = np.arange(len(self.word)) - self.first[owner] if len(owner) else np.zeros(0, np.int64)
        keep = (length[owner] - inside >= window) | (inside == 0) if len(owner) else np.zeros(0, bool)
        self.at, self.item, self.inside = np.flatnonzero(keep), owner[keep], inside[keep]
        self.length = np.minimum(length[self.item], window)
        self.bits = max(1, int(len(self.vocabulary) + 1).bit_length())
        self.low, self.high = self.keys(self.word, self.at, self.length, 0), self.keys(self.word, self.at, self.length, (1 << self.bits) - 1)
        self.item_length = length
        # A suffix can only be found where its first word stands, followed by its second.
        two = self.at[self.length > 1]
        self.pairs = np.unique((self.word[two] << 32) | self.word[two + 1]) if len(two) else np.zeros(0, np.int64)
        self.single = np.unique(self.word[self.at[self.length == 1]])

    def keys(self, word: np.ndarray, at: np.ndarray, length: np.ndarray, fill: int) -> np.ndarray:
        """`window` words from each place as fixed-width bytes whose order is the words' order; past `length` stands `fill`."""
        per = 63 // self.bits
        n = -(-self.window // per)
        out = np.zeros((len(at), n), ">u8")
        for k in range(n):
            part = np.zeros(len(at), np.int64)
            for j in range(k * per, min(self.window, (k + 1) * per)):
                value = np.where(j < length, word[np.minimum(at + j, len(word) - 1)] if len(word) else 0, fill)
                part = (part << self.bits) | value
            out[:, k] = part
        return np.ascontiguousarray(out).view(f"V{8 * n}").ravel()


def _search(keys: np.ndarray, probes: np.ndarray, side: str) -> np.ndarray:
    """Binary search of all probes at once. Byte strings compare as their unsigned big-endian words."""
    n = keys.dtype.itemsize // 8
    k, p = keys.view(">u8").reshape(-1, n).astype(U64), probes.view(">u8").reshape(-1, n).astype(U64)
    low, high = np.zeros(len(p), np.int64), np.full(len(p), len(k), np.int64)
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        middle = (low[live] + high[live]) >> 1
        a, b = k[middle], p[live]
        less, equal = np.zeros(len(live), bool), np.ones(len(live), bool)
        for j in range(n):
            less |= equal & (a[:, j] < b[:, j])
            equal &= a[:, j] == b[:, j]
        go = less | equal if side == "right" else less
        low[live[go]], high[live[~go]] = middle[go] + 1, middle[~go]


def find(s: Suffixes, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Suffix array over the texts' words, then every benchmark suffix by binary search: (suffix, place) of all occurrences."""
    none = np.zeros(0, np.int64)
    if not len(hashes) or not len(s.vocabulary):
        return none, none
    at = np.minimum(np.searchsorted(s.vocabulary, hashes), len(s.vocabulary) - 1)
    word = np.where(s.vocabulary[at] == hashes, at + 1, 0)
    length = np.diff(first)
    stop = np.repeat(first[1:], length)
    following = np.where(np.arange(len(word)) + 1 < stop, np.append(word[1:], 0), 0)
    known = np.flatnonzero((word > 0) & (following > 0))
    known = known[np.isin((word[known] << 32) | following[known], s.pairs)]
    if len(s.single):
        known = np.union1d(known, np.flatnonzero(np.isin(word, s.single)))
    if not len(known):
        return none, none
    # The place itself is the last part of the order, so equal suffixes stand by place.
    keys = s.keys(word, known, np.minimum(stop[known] - known, s.window), 0)
    n = keys.dtype.itemsize // 8
    columns = keys.view(">u8").reshape(-1, n).astype(U64)
    order = np.lexsort([columns[:, j] for j in reversed(range(n))])
    array, keys = known[order], keys[order]
    low, high = _search(keys, s.low, "left"), _search(keys, s.high, "right")
    count = np.maximum(high - low, 0)
    return np.repeat(np.arange(len(s.at)), count), array[ranges(low, count)]


def scan_block(s: Suffixes, column: pa.Array) -> tuple[np.ndarray, list, list]:
    """For each text: number of words, intervals covered by occurrences, and the longest verbatim match at each place and item."""
    n_words, hits, matches = [], [], []
    for w in word_chunks(column, FOLDED):
        n_words.append(np.diff(w.first))
        suffix, place = find(s, w.hash, w.first)
        size = len(w.first) - 1
        own_hits: list[list] = [[] for _ in range(size)]
        own_matches: list[list] = [[] for _ in range(size)]
        if len(place):
            doc = np.searchsorted(w.first, place, "right") - 1
            cover = np.zeros(len(w.hash) + 1, np.int64)
            np.add.at(cover, place, 1)
            np.add.at(cover, place + s.length[suffix], -1)
            covered = np.concatenate((np.cumsum(cover)[:-1] > 0, [False]))
            # A run ends where its text ends, too.
            edge = np.zeros(len(covered), bool)
            edge[w.first] = True
            begins = np.flatnonzero(covered & (edge | ~np.concatenate(([False], covered[:-1]))))
            ends = np.flatnonzero(covered[:-1] & (edge[1:] | ~covered[1:])) + 1
            run_doc = np.searchsorted(w.first, begins, "right") - 1
            for d, a, b in zip(run_doc, begins - w.first[run_doc], ends - w.first[run_doc]):
                own_hits[d].append({"start": int(a), "stop": int(b)})
            # Occurrences of following suffixes at following places are one longer match.
            item, diagonal = s.item[suffix], place - s.inside[suffix]
            order = np.lexsort((place, diagonal, item, doc))
            doc, item, diagonal, place, length, inside = doc[order], item[order], diagonal[order], place[order], s.length[suffix][order], s.inside[suffix][order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)
            head = np.flatnonzero(new)
            last = np.append(head[1:], len(doc)) - 1
            for k, e in zip(head, last):
                own_matches[doc[k]].append({"item_id": int(s.item_id[item[k]]), "item_at": int(inside[k]), "doc_at": int(place[k] - w.first[doc[k]]), "length": int(place[e] + length[e] - place[k])})
        hits += own_hits
        matches += own_matches
    return np.concatenate(n_words) if n_words else np.zeros(0, np.int64), hits, matches


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = 10, carry: Sequence[str] = ()) -> DataFrame:
    """Where benchmark text stands in documents: doc_id, n_words, hits (covered intervals of words), matches (longest verbatim
    matches with their places in item and document), and the columns `carry`.

    Method: each Arrow batch of documents is a shard; its suffixes are sorted by their first `window` words (only places where a
    benchmark suffix can begin are kept, which loses nothing), and all benchmark suffixes are found by binary search. Following
    hits are joined to longest matches. The benchmark is broadcast in blocks of BLOCK_BYTES; documents pass block by block.

    Null text or no words: no hits. Null doc_id: kept as null. Repeated rows: each gets its row. An item of fewer words than
    `window`, but not none, must occur whole. Null item_id: its hits count, and its matches have a null item_id; all such items are one. Empty tables: no
    hits, or no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    ready(spark)
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"]).where("text is not null")
    blocks = max(1, -(-text_bytes(items, "text") // BLOCK_BYTES))
    along = [f"carry{i}" for i in range(len(carry))]
    out = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], *[docs[c].alias(a) for c, a in zip(carry, along)])
    kinds = "".join(f", {a} {out.schema[a].dataType.simpleString()}" for a in along)
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect() if blocks > 1 else items.collect()
        shared = spark.sparkContext.broadcast(sorted((NAMELESS if r["item_id"] is None else r["item_id"], r["text"]) for r in rows))
        last = block == blocks - 1
        out = out.mapInArrow(_pass(shared, window, block == 0, along if last else [*along, "text"]), FOUND + kinds + ("" if last else ", text string"))
    return out.select(*[c for c in out.columns if c not in along], *[out[a].alias(c) for c, a in zip(carry, along)])


def _pass(shared, window: int, start: bool, along: list[str]):
    def run(batches):
        suffixes = Suffixes(shared.value, window)
        for batch in batches:
            n_words, hits, matches = scan_block(suffixes, batch.column("text"))
            matches = [[m | {"item_id": None} if m["item_id"] == NAMELESS else m for m in own] for own in matches]
            if not start:
                hits = [merged(a + b) for a, b in zip(batch.column("hits").to_pylist(), hits)]
                matches = [a + b for a, b in zip(batch.column("matches").to_pylist(), matches)]
            hit = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            match = pa.list_(pa.struct([("item_id", pa.int64()), ("item_at", pa.int32()), ("doc_at", pa.int32()), ("length", pa.int32())]))
            columns = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(hits, hit), pa.array(matches, match)]
            names = ["doc_id", "n_words", "hits", "matches"]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(a) for a in along], names + along)

    return run


def merged(runs: list[dict]) -> list[dict]:
    out: list[dict] = []
    for r in sorted(runs, key=lambda r: r["start"]):
        if out and r["start"] <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], r["stop"])
        else:
            out.append(dict(r))
    return out


def longest_matches(found: DataFrame) -> DataFrame:
    """One row per item that occurs: its longest verbatim match and where it stands. Ties: smaller doc_id, then place."""
    each = found.select("doc_id", F.explode("matches").alias("m"))
    best = F.max_by(F.struct("doc_id", "m.doc_at", "m.item_at", "m.length"), F.struct("m.length", -F.col("doc_id"), -F.col("m.doc_at"), -F.col("m.item_at")))
    return each.groupBy("m.item_id").agg(F.count("*").alias("n_matches"), best.alias("b")).select("item_id", "n_matches", "b.*")
