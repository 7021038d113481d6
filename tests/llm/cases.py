"""Small hard tables and plain versions of the operators, shared by these tests."""
from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UNSPACED = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {65 + i: 97 + i for i in range(26)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long, slab long, shard int, id string, host string, bucket long, content long"


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def sentence(rng, n, pool=400):
    return " ".join(f"w{rng.randint(0, pool)}" for _ in range(n))


def doc(i, text, lang="en", source="s0"):
    return (i, text, lang, source, None if text is None else len(text), 7, 8, "x", "y", 9, 10)


def hard_documents(seed=0):
    """Null and empty texts, null ids and columns, repeated rows, ties, very long texts, shared passages, exact and near copies."""
    rng = random.Random(seed)
    passage, long_text = sentence(rng, 60), sentence(rng, 6000, 100_000)
    near = [sentence(rng, 150) for _ in range(3)]
    rows = [doc(1, None), doc(2, ""), doc(3, "   \n\t "), doc(4, "!!! ??? 12"), doc(5, "one"), doc(6, "one"), doc(7, long_text), doc(8, long_text + " tail"),
            doc(9, "Ünïcode Straße ÉCOLE naïve " * 5, None, None), (10, sentence(rng, 30), "en", "s0", None, None, None, None, None, None, None),
            doc(11, "a b c"), doc(11, "a b c"), doc(12, sentence(rng, 14)), doc(None, sentence(rng, 40)), doc(None, None)]
    for i in range(20, 60):
        rows.append(doc(i, sentence(rng, rng.randint(1, 80)) + " " + passage * rng.randint(0, 1) + " " + sentence(rng, rng.randint(1, 80)), source=f"s{i % 3}"))
    for i in range(60, 90):
        base = near[i % 3].split()
        base[rng.randrange(150)] = f"x{i}"
        rows.append(doc(i, " ".join(base)))
    rows += [doc(i, near[0], source="hot") for i in range(90, 110)]
    rng.shuffle(rows)
    return rows
