"""Spelling variants against a plain version."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import DOCS, FOLD, doc, hard_documents

from tallywatch.llm import spelling


def plain_occurrences(rows, least=7):
    out = Counter()
    for d, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                out[run] += 1
    return out


def edits(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(count, least=2, factor=10):
    words = {w: n for w, n in count.items() if n >= least}
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and edits(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= factor * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def typo(rng, w):
    i, kind = rng.randrange(len(w)), rng.randrange(4)
    c = rng.choice("abcdeéÀzß")
    return [w[:i] + w[i + 1:], w[:i] + c + w[i + 1:], w[:i] + c + w[i:], w[:i] + w[i + 1:i + 2] + w[i:i + 1] + w[i + 2:]][kind]


def counted(seed):
    """Words with many variants, chains of forms, anagrams, doubled letters, long words."""
    rng = random.Random(seed)
    count = Counter({"abandon": 4000, "abandons": 300, "abandonsé": 20, "abandnsé": 2, "aaaaaaa": 50, "aaaaaaaa": 5, "aaaaaaaaa": 2, "z" * 300: 40, "z" * 301: 3, "z" * 299 + "y": 4,
                     "tie" * 3: 3, "once" * 2: 1})
    base = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(7, 12))) for _ in range(60)]
    for w in base:
        count[w] += rng.randint(1, 500)
        for _ in range(rng.randint(0, 12)):
            count[typo(rng, w)] += rng.randint(1, 5)
            count[typo(rng, typo(rng, w))] += rng.randint(1, 3)
    for _ in range(80):
        count["".join(rng.sample("abandon", 7))] += 2
    return count


@pytest.mark.parametrize("tree_words", [spelling.TREE_WORDS, 30])
@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_a_plain_version(spark, seed, tree_words):
    count = counted(seed)
    rows = spark.createDataFrame([(w, n) for w, n in count.items()], "word string, n long").selectExpr("explode(array_repeat(word, cast(n as int))) as word")
    got = {tuple(r) for r in spelling.variants(rows, tree_words=tree_words).collect()}
    want = plain_variants(count)
    assert got == want and ("abandnsé", "abandonsé", "abandon", 2, 1, 20) in want


def test_occurrences_equal_a_plain_version(spark):
    rows = hard_documents() + [doc(i, "Extraordinary ÉCOLEFRANÇAISE naïveté×÷ş façade_underscore abcdefg" + "x" * i) for i in range(200)] + [doc(900, "y" * 3_000_000)]
    got = Counter(r.word for r in spelling.occurrences(spark.createDataFrame(rows, DOCS)).collect())
    assert got == plain_occurrences(rows) and len(got) > 100


def test_edits_and_trees():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(7)) for _ in range(900)})
    longer = sorted({"".join(rng.choice("abc") for _ in range(8)) for _ in range(400)})
    tree = spelling.LetterTree(spelling.letters_of(longer))
    for asked, radius in ((longer, 2), (words, 1)):
        letters = spelling.letters_of(asked)
        q, w = tree.near(letters, radius)
        ok = spelling.one_edit(letters[q], tree.letters[w])
        assert {(asked[i], longer[j]) for i, j in zip(q[ok], w[ok])} == {(a, b) for a in asked for b in longer if edits(a, b)}
    assert len(tree.near(spelling.letters_of(["zzzzzzzz"]), 2)[0]) == 0
    assert isinstance(tree.order, np.ndarray) and sorted(tree.order) == list(range(len(longer)))


def test_empty_and_null(spark):
    none = spark.createDataFrame([], "word string")
    assert spelling.variants(none).count() == 0
    assert spelling.occurrences(spark.createDataFrame([doc(1, None), doc(2, "")], DOCS)).count() == 0
    some = spark.createDataFrame([(None,), (None,), ("abcdefg",), ("abcdefg",)], "word string")
    assert [tuple(r) for r in spelling.variants(some).collect()] == [("abcdefg", None, "abcdefg", 2, 0, None)]
