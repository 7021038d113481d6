"""Removal of long verbatim repeats across documents, found by FM-index."""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.fm_index import FMIndex
from tallywatch.llm.words import U64, UNSPACED, Words, gram_hashes, mix, ranges, raw_text, ready, run_hashes, text_bytes, words_of

GRAM = 5
SLAB_BYTES = 4 << 20
SHARD_BYTES = 8 << 20
#: A gram that stands in so many slabs has its windows dealt one by one.
HOT_SLABS = 256
LAST = np.iinfo(np.int64).max

KEYS = "shard int, slab long, keys binary"
REPEATED = "slab long, keys binary"
SEGMENTS = "shard int, slab long, number binary, doc binary, length binary, words binary"
LEAST = "slab long, number binary, least binary"
CLEANED = "doc_id long, n_words long, n_removed long, removed array<struct<start:int,stop:int>>, kept string"


class Slab:
    """The words of some documents, and for each window of `window` words the least hash of its grams, which all windows with the
    same words share. Documents of a slab are put in order, so that a slab read again is the same."""

    def __init__(self, table: pa.Table, window: int):
        self.window = window
        self.doc_id = table["doc_id"].to_numpy() if table["doc_id"].null_count == 0 else np.array([LAST if d is None else d for d in table["doc_id"].to_pylist()], np.int64)
        data, at = raw_text(table["text"])
        self.words: Words = words_of(data, at, UNSPACED)
        w = self.words
        length = np.diff(w.first)
        n = max(0, len(w.hash) - window + 1)
        grams = gram_hashes(w.hash, min(GRAM, window)) & ~U64(1)
        spread = window - min(GRAM, window) + 1
        least, done = grams, 1
        while done < spread:
            step = min(done, spread - done)
            least = np.minimum(least[:len(least) - step], least[step:])
            done += step
        self.least = least[:n]
        self.owner = np.repeat(np.arange(len(length)), length)[:n]
        self.whole = w.first[self.owner + 1] - np.arange(n) >= window
        self.head = self.whole.copy()
        if n > 1:
            self.head[1:] &= (self.least[1:] != self.least[:-1]) | (self.owner[1:] != self.owner[:-1])

    def keys(self) -> np.ndarray:
        """Each gram that is the least of some window, once; the last bit is set if it begins more than one run here."""
        value, count = np.unique(self.least[self.head], return_counts=True)
        return value | (count > 1).astype(U64)

    def segments(self, repeated: np.ndarray) -> Segments:
        return Segments(self, repeated)


class Segments:
    """Runs of windows with the same, repeated, least gram. Equal runs of a slab get one number; a hot gram's windows are runs of
    one window each, so that they are dealt by their own words."""

    def __init__(self, slab: Slab, repeated: np.ndarray):
        keys, hot = repeated & ~U64(1), repeated & U64(1) == 1
        n = len(slab.least)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, slab.least), len(keys) - 1)
            wanted = slab.whole & (keys[at] == slab.least)
            single = wanted & hot[at]
        else:
            wanted = single = np.zeros(n, bool)
        head = wanted & (slab.head | single)
        begin = np.flatnonzero(head)
        ends = np.flatnonzero(wanted & np.concatenate((head[1:] | ~wanted[1:], [True]))) + 1 if n else begin
        self.begin, self.windows = begin, ends - begin
        stop = ends + slab.window - 1
        content = run_hashes(slab.words.hash, begin, stop)
        self.doc = slab.doc_id[slab.owner[begin]] if len(begin) else np.zeros(0, np.int64)
        _, first, self.number = np.unique(content, return_index=True, return_inverse=True)
        self.route = np.where(single[begin], content, mix(slab.least[begin]))[first]
        self.least_doc = np.full(len(first), LAST)
        np.minimum.at(self.least_doc, self.number, self.doc)
        self.first, self.stop = begin[first], stop[first]
        self.unique_windows = self.windows[first]


def _by_shard(shard: np.ndarray) -> list[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.diff(shard[order])) + 1
    return [(int(shard[part[0]]), part) for part in np.split(order, cut)] if len(order) else []


def _table(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.table([pa.array(c, kind) for c, (_, kind) in zip(columns, schema)], [name for name, _ in schema])


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def remove_repeats(docs: DataFrame, window: int = 13, slab_bytes: int = SLAB_BYTES, shard_bytes: int = SHARD_BYTES, hot_slabs: int = HOT_SLABS,
                   carry: Sequence[str] = ()) -> DataFrame:
    """Removes each word that lies in a window of `window` words which also begins in a document with a smaller doc_id.

    Result: doc_id, n_words, n_removed, removed (intervals of words), kept (the other words, joined by one space), and the columns `carry`.

    Method: documents are dealt into slabs. A window's least gram (minimizer) is the same wherever the window stands, so windows
    can only repeat where their least gram does; those grams are found first. The runs of windows around them go to the shard
    of the gram, each distinct run of a slab once, and are indexed there by a compressed FM-index (a wavelet matrix over the
    Burrows-Wheeler transform). Backward search finds each window's occurrences, and the least doc_id among them goes back to
    the slab, where intervals are put together. Texts are shuffled once (the exchange by slab is used three times). Nothing is
    sent per document: slabs and shards exchange packed arrays in which equal runs are collapsed. A gram that stands in
    `hot_slabs` slabs or more has its windows dealt by their own words, so a passage that a third of all documents share is spread.

    Null text or no words: nothing removed. Repeated rows have equal doc_ids, so neither removes the other's words. A null doc_id
    counts as larger than all others. Texts shorter than a window are kept. Empty table: no rows. Words are compared by 64-bit hash. A window of more than FMIndex.DEPTH words:
    ValueError, as suffixes are sorted by so many words only.
    """
    if window > FMIndex.DEPTH:
        raise ValueError(f"window is {window} words, at most {FMIndex.DEPTH} can be searched")
    ready(docs.sparkSession)
    total = max(1, text_bytes(docs, "text"))
    slabs, shards = -(-total // slab_bytes), -(-total // shard_bytes)
    along = [f"carry{i}" for i in range(len(carry))]
    dealt = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"), *[docs[c].alias(a) for c, a in zip(carry, along)])
    dealt = dealt.withColumn("slab", F.pmod(F.xxhash64("doc_id", "text"), F.lit(slabs)))
    by_slab = dealt.groupBy("slab")

    def keys(table: pa.Table) -> pa.Table:
        own = Slab(table, window).keys()
        slab = table["slab"][0].as_py()
        rows = [(s, slab, own[part].tobytes()) for s, part in _by_shard((mix(own & ~U64(1)) % U64(shards)).astype(np.int64))]
        return _table([("shard", pa.int32()), ("slab", pa.int64()), ("keys", pa.binary())], rows)

    def repeated(table: pa.Table) -> pa.Table:
        own = _joined(table["keys"], U64)
        slab = np.repeat(table["slab"].to_numpy(), [len(k) // 8 for k in table["keys"].to_pylist()])
        order = np.argsort(own & ~U64(1), kind="stable")
        own, slab = own[order], slab[order]
        begin = np.flatnonzero(np.concatenate(([True], own[1:] >> U64(1) != own[:-1] >> U64(1)))) if len(own) else np.zeros(0, np.int64)
        count = np.diff(np.append(begin, len(own)))
        keep = np.repeat((count > 1) | (np.add.reduceat((own & U64(1)).astype(np.int64), begin) > 0 if len(begin) else count > 1), count)
        value = (own & ~U64(1)) | np.repeat(count >= hot_slabs, count).astype(U64)
        rows = [(s, value[keep][part].tobytes()) for s, part in _by_shard(slab[keep])]
        return _table([("slab", pa.int64()), ("keys", pa.binary())], rows)

    def segments(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        if len(table) and len(replies):
            slab = Slab(table, window)
            found = slab.segments(np.sort(_joined(replies["keys"], U64)))
            size = found.stop - found.first
            for s, part in _by_shard((found.route % U64(shards)).astype(np.int64)):
                words = slab.words.hash[ranges(found.first[part], size[part])]
                rows.append((s, table["slab"][0].as_py(), part.astype(np.int32).tobytes(), found.least_doc[part].tobytes(), size[part].astype(np.int32).tobytes(), words.tobytes()))
        return _table([("shard", pa.int32()), ("slab", pa.int64()), *((c, pa.binary()) for c in ("number", "doc", "length", "words"))], rows)

    def least(table: pa.Table) -> pa.Table:
        number, doc, size, words = (_joined(table[c], k) for c, k in (("number", np.int32), ("doc", np.int64), ("length", np.int32), ("words", U64)))
        slab = np.repeat(table["slab"].to_numpy(), [len(n) // 4 for n in table["number"].to_pylist()])
        size = size.astype(np.int64)
        at = np.cumsum(size) - size
        # Equal runs of different slabs are indexed once, under their least doc_id.
        _, first, same = np.unique(run_hashes(words, at, at + size), return_index=True, return_inverse=True)
        lowest = np.full(len(first), LAST)
        np.minimum.at(lowest, same, doc)
        windows = size[first] - window + 1
        result = least_docs(words[ranges(at[first], size[first])], size[first], lowest, window)
        # A slab knows the least doc_id of its own runs; it is told only of runs with a window that begins elsewhere earlier.
        offset = np.cumsum(windows) - windows
        below = np.minimum.reduceat(result, offset)[same] < doc if len(first) else np.zeros(0, bool)
        rows = []
        for s, part in _by_shard(slab[below]):
            own = np.flatnonzero(below)[part]
            rows.append((s, number[own].tobytes(), result[ranges(offset[same[own]], windows[same[own]])].tobytes()))
        return _table([("slab", pa.int64()), ("number", pa.binary()), ("least", pa.binary())], rows)

    def clean(table: pa.Table, replies: pa.Table, answers: pa.Table) -> pa.Table:
        slab = Slab(table, window)
        found = slab.segments(np.sort(_joined(replies["keys"], U64)))
        offset = np.cumsum(found.unique_windows) - found.unique_windows
        lowest = np.repeat(found.least_doc, found.unique_windows)
        number = _joined(answers["number"], np.int32)
        lowest[ranges(offset[number], found.unique_windows[number])] = _joined(answers["least"], np.int64)
        of = ranges(offset[found.number], found.windows)
        window_at = ranges(found.begin, found.windows)
        out = _cleaned(slab, window_at[lowest[of] < np.repeat(found.doc, found.windows)])
        for a in along:
            out = out.append_column(a, table[a])
        return out

    told = by_slab.applyInArrow(keys, KEYS).groupBy("shard").applyInArrow(repeated, REPEATED)
    sent = by_slab.cogroup(told.groupBy("slab")).applyInArrow(segments, SEGMENTS)
    answers = sent.groupBy("shard").applyInArrow(least, LEAST)
    empty = F.lit(None).cast("binary")
    both = told.select("slab", "keys", empty.alias("number"), empty.alias("least")).unionByName(answers.select("slab", empty.alias("keys"), "number", "least"))

    def finish(table: pa.Table, replies: pa.Table) -> pa.Table:
        known = replies["keys"].is_valid()
        return clean(table, replies.filter(known).select(["keys"]), replies.filter(replies["number"].is_valid()).select(["number", "least"]))

    kinds = "".join(f", {a} {dealt.schema[a].dataType.simpleString()}" for a in along)
    out = by_slab.cogroup(both.groupBy("slab")).applyInArrow(finish, CLEANED + kinds)
    return out.select(*[c for c in out.columns if c not in along], *[out[a].alias(c) for c, a in zip(carry, along)])


def least_docs(words: np.ndarray, size: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """For every window of every run, in order: the least doc_id of the runs in which it stands."""
    symbol = np.unique(words, return_inverse=True)[1] + 1
    n = len(size)
    begin = np.cumsum(size) - size + np.arange(n)
    text = np.zeros(len(words) + n, np.int64)
    text[ranges(begin, size)] = symbol
    run = np.repeat(np.arange(n), size + 1)
    index = FMIndex(text)
    windows = size - window + 1
    at = ranges(begin, windows)
    result = doc[run[at]]
    low, high = index.search(at, window)
    many = np.flatnonzero(high - low > 1)
    if len(many):
        # Ranges of windows of equal length are the same or apart, so each place of the suffix array is looked at once.
        value, inverse = np.unique(low[many], return_inverse=True)
        end = np.zeros(len(value), np.int64)
        end[inverse] = high[many]
        owner = doc[run[index.array]]
        inner = np.minimum.reduceat(np.append(owner, LAST), np.stack((value, end), 1).ravel())[::2]
        result[many] = inner[inverse]
    return result


def _result(doc_id, n_words, n_removed, run_at, begin, end, data, text_at) -> pa.Table:
    ids = pa.array(doc_id, pa.int64(), mask=doc_id == LAST)
    pair = pa.StructArray.from_arrays([pa.array(begin, pa.int32()), pa.array(end, pa.int32())], ["start", "stop"])
    runs = pa.ListArray.from_arrays(pa.array(run_at, pa.int32()), pair)
    text = pa.StringArray.from_buffers(len(text_at) - 1, pa.py_buffer(text_at.astype(np.int32).tobytes()), pa.py_buffer(data))
    return pa.table([ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), runs, text], ["doc_id", "n_words", "n_removed", "removed", "kept"])


def _cleaned(slab: Slab, windows: np.ndarray) -> pa.Table:
    w, n = slab.words, len(slab.words.start)
    cover = np.zeros(n + slab.window + 1, np.int64)
    cover[windows] += 1
    cover[windows + slab.window] -= 1
    gone = np.cumsum(cover)[:n] > 0
    before = np.concatenate(([0], np.cumsum(gone)))
    edge = np.zeros(n + 1, bool)
    edge[w.first] = True
    begin = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate(([False], gone[:-1])))) if n else np.zeros(0, np.int64)
    end = np.flatnonzero(gone & (edge[1:] | ~np.concatenate((gone[1:], [False])))) + 1 if n else np.zeros(0, np.int64)
    doc = np.searchsorted(w.first, begin, "right") - 1
    # Bytes of kept words, and the first byte after each but the text's last kept word as the space between.
    kept = np.flatnonzero(~gone)
    owner = np.searchsorted(w.first, kept, "right") - 1
    last = np.append(owner[1:] != owner[:-1], [True])[:len(kept)] if len(kept) else np.zeros(0, bool)
    mark = np.zeros(len(w.data) + 2, np.int8)
    mark[w.start[kept]] += 1
    stop = w.end[kept] + ~last
    mark[stop] -= 1
    inside = np.cumsum(mark[:len(w.data)], dtype=np.int8) > 0
    data = w.data.copy()
    data[w.end[kept][~last]] = 32
    text_at = np.concatenate(([0], np.cumsum(inside)))[w.at]
    return _result(slab.doc_id, np.diff(w.first), np.diff(before[w.first]), np.searchsorted(begin, w.first), begin - w.first[doc], end - w.first[doc], data[inside].tobytes(), text_at)
