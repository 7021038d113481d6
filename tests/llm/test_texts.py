"""Substring dedup, decontamination, packing and near duplicates against plain versions."""
import math
import random
import struct
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import DOCS, UNSPACED, doc, hard_documents, sentence, words
from tokenizers import Tokenizer

from tallywatch.llm import contamination, neardup, packing, substrings
from tallywatch.llm.fm_index import FMIndex

BENCH = "item_id long, text string, window long"


def plain_repeats(rows, k=13):
    least = {}
    for r in rows:
        w = UNSPACED.findall(r[1] or "")
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            least[g] = min(least.get(g, math.inf), math.inf if r[0] is None else r[0])
    out = []
    for r in rows:
        w = UNSPACED.findall(r[1] or "")
        gone = {j for i in range(len(w) - k + 1) if least[tuple(w[i:i + k])] < (math.inf if r[0] is None else r[0]) for j in range(i, i + k)}
        out.append((r[0], len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return Counter(out)


@pytest.mark.parametrize("slab_bytes, hot", [(4 << 20, 256), (3000, 256), (3000, 2)])
def test_repeats(spark, slab_bytes, hot):
    rows = hard_documents(3) + [doc(300, "q " * 40), doc(301, "q " * 30)]
    out = substrings.remove_repeats(spark.createDataFrame(rows, DOCS), slab_bytes=slab_bytes, shard_bytes=slab_bytes, hot_slabs=hot, carry=["slab", "shard"]).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out) == plain_repeats(rows)
    for r in out:
        assert sum(x.stop - x.start for x in r.removed) == r.n_removed
    assert Counter(r.slab for r in out) == Counter(r[5] for r in rows)


def test_no_repeats_without_documents(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_windows_beyond_the_sorted_depth_are_refused(spark):
    with pytest.raises(ValueError):
        substrings.remove_repeats(spark.createDataFrame([doc(1, "a")], DOCS), window=FMIndex.DEPTH + 1)


def test_index_counts_like_a_scan():
    rng = np.random.RandomState(0)
    for sigma in (2, 5, 300):
        text = np.concatenate([np.append(rng.randint(1, sigma + 1, rng.randint(13, 40)), 0) for _ in range(60)]).astype(np.int64)
        index = FMIndex(text)
        at = np.array([p for p in range(len(text) - 13) if (text[p:p + 13] > 0).all()])
        low, high = index.search(at, 13)
        grams = Counter(tuple(text[p:p + 13]) for p in at)
        assert [grams[tuple(text[p:p + 13])] for p in at] == (high - low).tolist()
        many = high - low > 1
        assert all(tuple(text[index.array[x]:index.array[x] + 13]) == tuple(text[p:p + 13]) for p, a, b in zip(at[many], low[many], high[many]) for x in range(a, b))


def plain_hits(rows, items, k=10):
    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        for g in ([tuple(w[j:j + k]) for j in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] if w else []):
            grams[g].add(i)
    out = []
    for r in rows:
        w, hit, ids = words(r[1]), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if own := grams.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    ids |= own
        out.append((r[0], len(w), len(hit), tuple(sorted(ids))))
    return Counter(out)


@pytest.mark.parametrize("block", [16 << 20, 100])
def test_contamination(spark, monkeypatch, block):
    monkeypatch.setattr(contamination, "BLOCK_BYTES", block)
    rng = random.Random(5)
    items = [(i, sentence(rng, rng.randint(10, 30), 60)) for i in range(12)] + [(20, "Zeta"), (21, "two words"), (22, None), (23, ""), (24, "!!"), (25, "a a a a a a a a a a a a")]
    items.append(items[0])
    rows = hard_documents(4) + [doc(500 + i, " ".join([sentence(rng, rng.randint(0, 9), 60), items[i % 12][1], sentence(rng, 5, 60), "two, words zeta"[:rng.randint(1, 15)]])) for i in range(40)]
    rows += [doc(600, "a " * 30), doc(601, " ".join(words(items[1][1])[:9])), doc(602, items[2][1] + " " + items[3][1])]
    out = contamination.occurrences(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(*x, 1) for x in items], BENCH), carry=["lang"]).collect()
    got = Counter((r.doc_id, r.n_words, sum(h.stop - h.start for h in r.hits), tuple(sorted({m.item_id for m in r.matches}))) for r in out)
    assert got == plain_hits(rows, items)
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(words(r[1]))
    by_item = dict(items)
    for r in out:
        for m in r.matches:
            assert any(w[m.doc_at:m.doc_at + m.length] == words(by_item[m.item_id])[m.item_at:m.item_at + m.length] for w in texts[r.doc_id])


def test_items_without_id_count_as_one(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(12)) for c in "xy")
    docs = spark.createDataFrame([doc(1, a + " " + b), doc(2, "none of it"), doc(3, b)], DOCS)
    out = contamination.occurrences(docs, spark.createDataFrame([(None, a, 1), (None, b, 1), (4, b, 1)], BENCH)).collect()
    got = {r.doc_id: (sum(h.stop - h.start for h in r.hits), {m.item_id for m in r.matches}) for r in out}
    assert got == {1: (24, {None, 4}), 2: (0, set()), 3: (12, {None, 4})}


def test_contamination_of_nothing(spark):
    docs, none = spark.createDataFrame(hard_documents(), DOCS), spark.createDataFrame([], BENCH)
    assert all(not r.hits for r in contamination.occurrences(docs, none).collect())
    assert contamination.occurrences(spark.createDataFrame([], DOCS), none).count() == 0


def test_longest_match(spark):
    item = sentence(random.Random(2), 40)
    docs = spark.createDataFrame([doc(1, "x " + item[:120]), doc(2, "y z " + item)], DOCS)
    best = contamination.longest_matches(contamination.occurrences(docs, spark.createDataFrame([(7, item, 0)], BENCH))).first()
    assert (best.item_id, best.doc_id, best.doc_at, best.item_at, best.length) == (7, 2, 2, 0, 40)


@pytest.mark.parametrize("name, known", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_ids_are_those_of_any_tokenizer(name, known):
    path = public_tokenizers.path(name)
    encoder, tok = packing.Encoder(path, 2), Tokenizer.from_file(path)
    assert encoder.known == known
    for text in ("Hello World, don't stop 123 times.", "", " a\t\nB ", "'S we'LL", "Ωmega é", "x <|endoftext|> y"):
        ids = tok.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text) == struct.pack(f"<{len(ids) + 1}I", *ids, 2)


@pytest.mark.parametrize("size, most_open", [(4096, 1024), (64, 8)])
def test_packing_round_trip(spark, size, most_open):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = hard_documents(6) + [doc(700, "don't 'tis we'LL !'s a''s ÀÉ ß ÿ 12 3a-b\x0bc\t\n <|endoftext|> Ω € ²")]
    out = packing.pack(spark.createDataFrame(rows, DOCS), path, size, most_open=most_open).collect()
    tok = Tokenizer.from_file(path)
    want = Counter((r[0], struct.pack(f"<{len(x) + 1}I", *x, 2)) for r in rows for x in [tok.encode(r[1] or "", add_special_tokens=False).ids])
    pieces = defaultdict(list)
    for r in out:
        pieces[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
    got = Counter()
    for (d, total), own in pieces.items():
        # Rows of one id and length may interleave; each start occurs once per row.
        by_start = defaultdict(list)
        for s, ids in own:
            by_start[s].append(ids)
        for _ in by_start[0]:
            pass
        if all(len(v) == 1 for v in by_start.values()):
            got[d, b"".join(ids for _, ids in sorted(own))] += 1
            assert sum(len(ids) // 4 for _, ids in own) == total
    single = {k: v for k, v in want.items() if sum(n for (d, _), n in want.items() if d == k[0]) == 1}
    assert all(got[k] == v for k, v in single.items()) and sum(len(bytes(r.ids)) for r in out) == sum(len(k[1]) * v for k, v in want.items())
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, len(bytes(r.ids)) // 4))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at and n > 0
            at += n
        assert at == size or at < size and at & (at - 1) == 0


def test_placement_keeps_the_sum_of_squares_least():
    rng, size = random.Random(0), 20
    levels = packing.Levels(size)
    for _ in range(400):
        n = rng.randint(1, size - 1)
        counts = levels.count.copy()
        options = []
        for h in [0, *[h for h in range(1, size - n + 1) if counts[h]]]:
            c = counts.copy()
            if h:
                c[h] -= 1
            if h + n < size:
                c[h + n] += 1
            options.append(int((c * c).sum()))
        levels.place((0, 0, b"", 0), n)
        assert int((levels.count ** 2).sum()) == min(options)


def plain_classes(rows, similarity=0.8):
    grams = {}
    df = Counter()
    for k, r in enumerate(rows):
        w = words(r[1])
        grams[k] = Counter(tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))) if w else Counter()
        df.update(grams[k].keys())
    n = sum(1 for g in grams.values() if g)
    full = math.log(1 / neardup.SHARE)
    weight = {g: full if c < n * neardup.SHARE else max(0.05, min(full, math.log(n / c))) for g, c in df.items()}
    weighed = {k: {x: c * weight[x] for x, c in g.items()} for k, g in grams.items()}
    parent = {k: k for k in grams}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in grams:
        for b in range(a):
            common = sum(min(v, weighed[b].get(x, 0)) for x, v in weighed[a].items())
            if common and common / (sum(weighed[a].values()) + sum(weighed[b].values()) - common) >= similarity:
                parent[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), math.inf), r[0])
    return Counter((r[0], least.get(find(k))) for k, r in enumerate(rows))


def test_near_duplicate_classes(spark):
    rng = random.Random(8)
    rows = hard_documents(7)
    chain = sentence(rng, 120, 5000).split()
    for i in range(12):  # each like the next, the ends unlike
        chain = [*chain[2:], f"c{i}", f"d{i}"]
        rows.append(doc(800 + i, " ".join(chain)))
    out = neardup.classes(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter((r.doc_id, r.class_id) for r in out) == plain_classes(rows)


def test_near_duplicates_of_nothing(spark):
    assert neardup.classes(spark.createDataFrame([], DOCS)).count() == 0
    only = neardup.classes(spark.createDataFrame([doc(1, None), doc(2, "")], DOCS)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in only) == [(1, 1, 0), (2, 2, 0)]


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.RandomState(1)
    agree = []
    for _ in range(150):
        u = rng.randint(0, 2**62, 100, dtype=np.int64).astype(np.uint64)
        a, b = np.sort(u[:90]), np.sort(np.concatenate((u[:80], u[90:])))
        x, y = (neardup.samples(np.zeros(len(v), int), v, np.full(len(v), 2.0), np.array([0]))[:, 0] for v in (a, b))
        agree.append((x == y).mean())
    assert abs(np.mean(agree) - 0.8) < 0.03
