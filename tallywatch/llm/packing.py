"""Packing of documents into training sequences: sum-of-squares online packing."""
from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallywatch.llm.words import ready

PIECES = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"
#: What the fast way of splitting handles: printable ASCII, tab to carriage return, and letters of Latin-1. Others go whole to the tokenizer.
SIMPLE = "[\t-\r -~À-ÖØ-öø-ÿ]*"
PARTS = "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-zß-öø-ÿ0-9]+"
#: How a tokenizer must normalize and split for SIMPLE and PARTS to do the same. Texts of any other tokenizer go whole to it.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPLITTER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
                                                  {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
MEMO_PARTS = 200_000
#: Bytes of ids that a task holds before it hands pieces on.
HELD_BYTES = 4 << 20


class Parts(dict):
    """Ids of the parts of texts, each encoded by the tokenizer's model when it is first met. The model reads bytes written as
    characters: printable ones of Latin-1 stand for themselves, the others, in order, for those from 256 on."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.written = {b: 256 + i for i, b in enumerate(hidden)}

    def __missing__(self, part: str) -> bytes:
        known = part if part.isascii() else part.encode().decode("latin-1").translate(self.written)
        ids = [t.id for t in self.tokenize(known)]
        self[part] = packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes. The tokenizer splits a text into parts and encodes each by
    itself, so parts are encoded once and remembered (at most MEMO_PARTS of them, then the memory starts anew). A tokenizer that
    normalizes, splits or marks special tokens otherwise than the known way gets whole texts."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = struct.pack("<I", end_id)
        self.simple, self.split = re.compile(SIMPLE).fullmatch, re.compile(PARTS).findall
        self.parts = Parts(self.tokenizer.model)
        self.known = self._known()

    def _known(self) -> bool:
        t = self.tokenizer
        said = [json.loads(part.__getstate__()) if part is not None else None for part in (t.normalizer, t.pre_tokenizer)]
        marked = all("<|" in token.content for token in t.get_added_tokens_decoder().values())
        return said == [NORMALIZER, SPLITTER] and marked and t.truncation is None and t.padding is None

    def ids(self, text: str) -> bytes:
        if not self.known or not self.simple(text) or "<|" in text:  # special tokens are found in the whole text
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids) + self.end
        if len(self.parts) > MEMO_PARTS:
            self.parts.clear()
        return b"".join(chain(map(self.parts.__getitem__, self.split(text.lower())), (self.end,)))


class Levels:
    """Windows of `size` tokens being filled. level[h] holds the windows filled up to h; `count` is their number, and the sum of
    its squares is what each placement keeps lowest: moving one window from level h to h + s changes it by
    2 * (count[h + s] - count[h]) + 2, a new window by 2 * count[s] + 1, and a full window leaves the array."""

    def __init__(self, size: int):
        self.size, self.count = size, np.zeros(size + 1, np.int64)
        self.level: list[list[list]] = [[] for _ in range(size)]
        self.open = 0

    def place(self, piece: tuple, length: int) -> list | None:
        """Returns the window if the piece completes it."""
        size, count = self.size, self.count
        below = count[1:size - length + 1]
        cost = np.where(below > 0, 2 * (count[1 + length:size + 1] - below) + 2, np.iinfo(np.int64).max)
        if len(cost):
            cost[-1] = 1 - 2 * below[-1] if below[-1] > 0 else cost[-1]
        h = int(np.argmin(cost)) + 1 if len(cost) else 0
        if not h or cost[h - 1] > 2 * count[length] + 1:
            window = []
            self.open += 1
        else:
            window = self.level[h].pop()
            count[h] -= 1
            length += h
        window.append(piece)
        if length == size:
            self.open -= 1
            return window
        self.level[length].append(window)
        count[length] += 1
        return None

    def drain(self) -> Iterator[tuple]:
        """All pieces of open windows, fullest first; the array is empty afterwards."""
        for windows in reversed(self.level):
            for window in windows:
                yield from window
            windows.clear()
        self.count[:] = 0
        self.open = 0


def joined(pieces: Iterator[tuple], size: int) -> Iterator[list]:
    """Pieces laid end to end and cut at every `size` tokens. What is left at the end is cut at powers of two, which need no padding."""
    window, room = [], size
    held: list[tuple] = []
    for doc, start, ids, total in pieces:
        while ids:
            take = ids[:4 * room]
            window.append((doc, start, take, total))
            start, ids, room = start + len(take) // 4, ids[len(take):], room - len(take) // 4
            if not room:
                yield window
                window, room = [], size
    held, left = window, size - room
    while left:
        part = 1 << (left.bit_length() - 1)
        window, need = [], part
        while need:
            doc, start, ids, total = held.pop(0)
            take = ids[:4 * need]
            window.append((doc, start, take, total))
            need -= len(take) // 4
            if len(take) < len(ids):
                held.insert(0, (doc, start + len(take) // 4, ids[len(take):], total))
        left -= part
        yield window


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 2, most_open: int = 1024) -> DataFrame:
    """Pieces of documents placed in sequences of at most `size` tokens. `tokenizer`: the path of any file of the tokenizers library.

    Method: each task packs its own rows online. A document gives full windows and a rest; the rest goes to the fill level that
    minimises the sum of squared counts of partially filled windows. When more than `most_open` windows are open, and at the end
    of the task, the open windows' pieces are laid end to end and cut, so a task's padding is nil: its last sequences have
    lengths that are powers of two. No row leaves its task, so no key can be hot, and a lost task is simply run again.

    Result: doc_id, start, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset. Null or empty text: the end id
    alone. Null doc_id: kept as null. Repeated rows: each is packed. Empty table: no rows. Other columns are not looked at.
    """
    ready(docs.sparkSession)

    def run(batches):
        encoder, levels = Encoder(tokenizer, end_id), Levels(size)
        number = TaskContext.get().partitionId() << 40
        out: list[tuple] = []
        held = 0

        def put(window: list) -> None:
            nonlocal number, held
            offset = 0
            for doc, start, ids, total in window:
                out.append((doc, start, ids, total, number, offset))
                offset += len(ids) // 4
                held += len(ids)
            number += 1

        def table() -> pa.RecordBatch:
            nonlocal held
            columns = list(zip(*out)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset")
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            out.clear()
            held = 0
            return batch

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encoder.ids(text.as_py() or "")
                total = len(ids) // 4
                for start in range(0, total - total % size, size):
                    put([(doc, start, ids[4 * start:4 * (start + size)], total)])
                if rest := total % size:
                    full = levels.place((doc, total - rest, ids[4 * (total - rest):], total), rest)
                    if full is not None:
                        put(full)
                    if levels.open > most_open:
                        for window in joined(levels.drain(), size):
                            put(window)
                if held >= HELD_BYTES:
                    yield table()
        for window in joined(levels.drain(), size):
            put(window)
        if out:
            yield table()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, PIECES)
