"""Spelling variants: K-d trees over the letter counts of words find those one edit away, an edit changing counts by two at most."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.words import ready
from tallywatch.session import settle

RUN = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of one tree, and their letters, about.
TREE_WORDS, TREE_LETTERS = 32_768, 4 << 20
LEAF = 128
#: Words that walk through a tree together.
WALK = 4096
#: Letters are counted in so many classes, up to so many each: folding and capping never add to a distance.
CLASSES, MOST = 128, 4
#: Trees are split by the presence of at most so many letters; what these can't split is split by hash.
SPLITS = 12
COPIES = 16
FOUND = "word string, n_near long, best struct<less: long, form: string>"


def occurrences(docs: DataFrame, least: int = 7, every: int = 31) -> DataFrame:
    """word: one row for each place. Maximal runs of letters are lower-cased (A-Z only); where `every` divides the crc32 h of
    `<doc_id>:<run>`, the run loses its code point h % length. Runs and results of under `least` code points are left out.

    Null text: no words; null doc_id: as an empty string. Repeated rows: each counts. Empty table: no rows."""
    runs = F.regexp_extract_all(F.coalesce(docs["text"], F.lit("")), F.lit(f"({RUN}{{{least},}})"), F.lit(1))
    rows = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("run"))
    rows = rows.select("d", F.translate("run", UPPER, LOWER).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("d", F.lit(":"), "run").cast("binary")))
    cut = F.expr("concat(substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))")
    return rows.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least)


class LetterTree:
    """Words of one length under median splits of their letter counts; each node has its tight box.

    Counts up to MOST are written in unary, so that the distance of a word to a box, and to a word, is linear in the word's digits."""

    def __init__(self, letters: np.ndarray):
        self.letters = letters
        counts = counts_of(letters)
        order, todo = np.arange(len(letters)), [(0, len(letters), -1, 0)]
        self.child, self.span, low, high = [], [], [], []
        while todo:
            start, stop, parent, side = todo.pop()
            me = len(self.child)
            if parent >= 0:
                self.child[parent][side] = me
            here = counts[order[start:stop]]
            low.append(here.min(axis=0)), high.append(here.max(axis=0))
            self.child.append([0, 0]), self.span.append((start, stop))
            widest = int(np.argmax(here.std(axis=0))) if stop - start > LEAF else 0
            if stop - start <= LEAF or low[-1][widest] == high[-1][widest]:
                self.child[me] = None
                continue
            column = here[:, widest]
            at = np.median(column)
            left = column <= at if (column <= at).sum() < len(column) else column < at
            order[start:stop] = np.concatenate((order[start:stop][left], order[start:stop][~left]))
            middle = start + int(left.sum())
            todo += [(middle, stop, me, 1), (start, middle, me, 0)]
        self.order, digits = order, unary(counts[order])
        self.digits, self.total = digits, digits.sum(axis=1)
        below, above = unary(np.array(low)), unary(np.array(high))
        # Digits beyond the box's upper corner, and those of its lower corner that are missing.
        self.slope, self.base = 1 - above - below, below.sum(axis=1)

    def near(self, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in `asked`, place in the tree's words) whose counts differ by at most `radius`."""
        digits = unary(counts_of(asked))
        total, pairs = digits.sum(axis=1), []
        todo = [(0, np.flatnonzero(digits @ self.slope[0] + self.base[0] <= radius))]
        while todo:
            node, who = todo.pop()
            if not len(who):
                continue
            mine = digits[who]
            if self.child[node] is None:
                start, stop = self.span[node]
                distance = total[who][:, None] + self.total[start:stop] - 2 * (mine @ self.digits[start:stop].T)
                q, w = np.nonzero(distance <= radius)
                pairs.append((who[q], self.order[start + w]))
                continue
            both = mine @ self.slope[self.child[node]].T + self.base[self.child[node]]
            todo += [(c, who[both[:, j] <= radius]) for j, c in enumerate(self.child[node])]
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(side) for side in zip(*pairs))


def letters_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row for each word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def counts_of(letters: np.ndarray) -> np.ndarray:
    out = np.zeros((len(letters), CLASSES), np.int32)
    rows = np.arange(len(letters))
    for column in letters.T if letters.shape[1] <= 64 else ():
        out[rows, column % CLASSES] += 1
    if letters.shape[1] > 64:
        for row, word in zip(out, letters):
            row[:] = np.bincount(word % CLASSES, minlength=CLASSES)
    return out


def unary(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([counts > level for level in range(MOST)], axis=1).astype(np.float32)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows differ by one replaced code point, or by one that only b's, longer by one, has."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    before = np.cumprod(a == b[:, :-1], axis=1, dtype=bool)
    after = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=bool)[:, ::-1]
    return before.sum(axis=1) + after.sum(axis=1) >= a.shape[1]


def _search(tree_words: pa.Table, asked: pa.Table) -> pa.Table:
    """For every word of a tree and every word that asks: how many near words it has in this meeting, and the best of them."""
    best: dict[str, list] = {}

    def note(word: str, n: int, form: str) -> None:
        old = best.get(word)
        if old is None:
            best[word] = [1, (-n, form)]
        else:
            old[0] += 1
            old[1] = min(old[1], (-n, form))

    if len(tree_words) and len(asked):
        words, n = tree_words["word"].to_pylist(), tree_words["n"].to_pylist()
        tree = LetterTree(letters_of(words))
        longer = np.array(asked["longer"].to_pylist(), bool)
        all_asking, all_n = np.array(asked["asking"].to_pylist(), object), asked["times"].to_pylist()
        for radius, which in ((2, np.flatnonzero(~longer)), (1, np.flatnonzero(longer))):
            step = max(1, min(WALK, TREE_LETTERS // max(1, tree.letters.shape[1])))
            for low in range(0, len(which), step):
                here = which[low:low + step]
                letters = letters_of(list(all_asking[here]))
                q, w = tree.near(letters, radius)
                size = max(1, TREE_LETTERS // tree.letters.shape[1])
                for part in range(0, len(q), size):
                    qs, ws = q[part:part + size], w[part:part + size]
                    ok = one_edit(letters[qs], tree.letters[ws])
                    for i, j in zip(here[qs[ok]].tolist(), ws[ok].tolist()):
                        note(all_asking[i], n[j], words[j])
                        if radius == 1:
                            note(words[j], all_n[i], all_asking[i])
    found = pa.array([{"less": less, "form": form} for _, (less, form) in best.values()], pa.struct([("less", pa.int64()), ("form", pa.string())]))
    return pa.table([pa.array(list(best), pa.string()), pa.array([x[0] for x in best.values()], pa.int64()), found], ["word", "n_near", "best"])


def near_words(words: DataFrame, tree_words: int = TREE_WORDS) -> DataFrame:
    """word, n_near, best (less: minus its n, form): for every word with near words how many there are, and the one of the largest n,
    ties to the smallest in code-point order. `words`: word, n, each word once.

    Words lie in trees by length and by the presence of the letters that split them most evenly (all words are counted for that). A word
    asks the trees of its length and of the next that one edit can reach: one letter may vanish, one may come. Trees of more than
    `tree_words` words that letters don't split are split by hash, and asked in as many turns; so a task holds a bounded part. Counts and
    best words are gathered per meeting, pairs are not sent.

    Null or empty words: take no part. Very long words: fewer share a tree. Empty table: no rows."""
    ready(words.sparkSession)
    words = words.where("word is not null and word <> ''").select("word", "n", F.length("word").alias("len"))
    present = words.agg(F.max("len"), *[F.avg(F.contains("word", F.lit(c)).cast("double")).alias(c) for c in LOWER]).first()
    shares = sorted((abs((present[c] or 0) - 0.5), c) for c in LOWER)
    largest = words.groupBy("len").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
    need = max(0, -(-largest // tree_words) - 1).bit_length()
    split = [c for _, c in shares[:min(SPLITS, need)]]
    count = lambda c: F.length("word") - F.length(F.replace("word", F.lit(c), F.lit("")))
    bits = [F.when(F.contains("word", F.lit(c)), 1 << j).otherwise(0) for j, c in enumerate(split)]
    cell = sum(bits, F.lit(0)).cast("int")
    none = F.array().cast("array<int>")
    pick = lambda tests: F.array_compact(F.array(*[F.when(t, 1 << j) for j, t in enumerate(tests)])).cast("array<int>") if tests else none
    words = words.withColumns({"cell": cell, "come": pick([~F.contains("word", F.lit(c)) for c in split]), "go": pick([count(c) == 1 for c in split])})
    cap = F.greatest(F.lit(1), F.least(F.lit(tree_words), F.floor(F.lit(TREE_LETTERS) / F.col("len"))))
    sizes = settle(words.groupBy("len", "cell").agg(F.ceil(F.count("*") / F.min(cap)).cast("int").alias("parts")))
    key = ["len", "cell"]
    number = lambda word, seed: F.pmod(F.xxhash64(word, F.lit(seed)), F.col("parts")).cast("int")
    trees = words.select("word", "n", *key).join(sizes, key)
    trees = trees.select("word", "n", *key, number("word", 1).alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("turn"))
    same = F.expr("concat(array(cell), transform(come, u -> cell + u), transform(go, d -> cell - d), flatten(transform(go, d -> transform(come, u -> cell - d + u))))")
    more = F.expr("concat(array(cell), transform(come, u -> cell + u))")
    ways = F.array(F.struct(F.col("len"), same.alias("cells"), F.lit(False).alias("longer")), F.struct((F.col("len") + 1).alias("len"), more.alias("cells"), F.lit(True).alias("longer")))
    asked = words.select("word", "n", F.inline(ways)).select(F.col("word").alias("asking"), F.col("n").alias("times"), "len", "longer", F.explode("cells").alias("cell"))
    asked = asked.join(sizes, key).select("asking", "times", "longer", *key, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), number("asking", 2).alias("turn"))
    groups = [*key, "part", "turn"]
    met = trees.groupBy(*groups).cogroup(asked.groupBy(*groups)).applyInArrow(_search, FOUND)
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _roots(linked: DataFrame) -> DataFrame:
    """head, root: for every word that is another's form, the end of its chain of forms. `linked`: word, form (or null). n grows
    along a chain by a factor, so chains are short; each round doubles the steps made."""
    heads = linked.where("form is not null").select(F.col("form").alias("head")).distinct()
    roots = settle(heads.join(linked, heads["head"] == linked["word"]).select("head", F.coalesce("form", "head").alias("root")))
    while True:
        further = roots.select(F.col("head").alias("root"), F.col("root").alias("further"))
        stepped = settle(roots.join(further, "root").select("head", "root", "further"))
        if stepped.where("root <> further").isEmpty():
            return roots
        roots = stepped.select("head", F.col("further").alias("root"))


def variants(occurring: DataFrame, least: int = 2, factor: int = 10, tree_words: int = TREE_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of at least `least` rows of `occurring` (word, one row for each place).

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its near word of the largest n (ties: the
    smallest in code-point order), if that n is at least `factor` times the word's; else null. root: the end of the chain of forms, the
    word itself if it has none. Null words: left out. Empty table: no rows."""
    words = occurring.where("word is not null").groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    words = settle(words)
    near = near_words(words, tree_words)
    fits = F.col("best.less") * -1 >= F.col("n") * factor
    linked = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                     F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"))
    linked = settle(linked)
    # A form may have very many variants: its row is copied, and they are dealt over the copies.
    roots = _roots(linked.select("word", "form")).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    copy: Column = F.pmod(F.xxhash64(linked["word"]), F.lit(COPIES)).cast("int")
    out = linked.join(roots, (linked["form"] == roots["head"]) & (copy == roots["copy"]), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
