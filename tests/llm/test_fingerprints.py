"""Closed syncmers against a plain version."""
import hashlib
import zlib
from collections import Counter

import pytest
from cases import DOCS, doc, hard_documents, sentence

from tallywatch.llm import fingerprints
from tallywatch.llm.fingerprints import K, S


def plain_anchors(t, k=K, s=S):
    h = [zlib.crc32(t[i:i + s].encode()) for i in range(len(t) - s + 1)]
    w = k - s + 1
    return [i for i in range(len(h) - w + 1) if min(h[i:i + w]) in (h[i], h[i + w - 1])]


def plain_print(t, k=K, s=S):
    at = plain_anchors(t, k, s)
    if not at:
        return [f"{zlib.crc32(t.encode()):08X}0"] if t else []
    return [f"{zlib.crc32(t[p:p + k].encode()):08X}{p - (at[j - 1] if j else 0):X}" for j, p in enumerate(at)]


def plain_likeness(a, b):
    a, b = set(a), set(b)
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def hard_rows():
    rows = hard_documents() + [doc(500, "a" * 300), doc(501, "😀é" * 5000), doc(501, "😀é" * 50), doc(None, "x"), doc(502, "0123456789" * 410)]
    return rows + [doc(503, "the same row " * 4)] * 5


@pytest.mark.parametrize("group_bytes,order_rows", [(fingerprints.GROUP_BYTES, fingerprints.ORDER_ROWS), (3000, 20)])
def test_rows_equal_a_plain_version(spark, group_bytes, order_rows):
    rows = hard_rows()
    order = sorted((r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest(), r[1] or "") for r in rows)
    want = Counter()
    for i, (null, d, _, t) in enumerate(order):
        follows, m = order[(i + 1) % len(order)][3], len(t) // 4
        edited = t[:len(t) - m] + follows[:m]
        f, g = plain_print(t), plain_print(edited)
        want[(None if null else d, len(t), edited, "".join(f), "".join(g), plain_likeness(f, g), plain_likeness(f, plain_print(follows)))] += 1
    out = fingerprints.compare_edited(spark.createDataFrame(rows, DOCS), group_bytes=group_bytes, order_rows=order_rows)
    assert Counter(map(tuple, out.collect())) == want


@pytest.mark.parametrize("k,s", [(K, S), (9, 8), (12, 3)])
def test_anchors_and_their_gaps(spark, k, s):
    rows = hard_rows()
    got = Counter((r.doc_id, tuple(tuple(a) for a in r.anchors), r.fingerprint) for r in fingerprints.fingerprints(spark.createDataFrame(rows, DOCS), k, s).collect())
    assert got == Counter((r[0], tuple((p, zlib.crc32((r[1] or "")[p:p + k].encode())) for p in plain_anchors(r[1] or "", k, s)), "".join(plain_print(r[1] or "", k, s))) for r in rows)
    # Any k - s consecutive k-mers hold an anchor.
    for _, anchors, _ in got:
        places = [-1] + [p for p, _ in anchors]
        assert all(b - a <= k - s for a, b in zip(places, places[1:]))


def test_likeness_follows_what_is_shared(spark):
    import random
    rng = random.Random(3)
    rows = [doc(i, sentence(rng, 300, 10**6)) for i in range(60)]
    out = fingerprints.compare_edited(spark.createDataFrame(rows, DOCS)).collect()
    assert all(0.6 < r.near_edited < 0.9 and r.near_next < 0.1 for r in out)
    moved = [doc(1, rows[0][1]), doc(2, rows[1][1] + " " + rows[0][1])]
    assert fingerprints.compare_edited(spark.createDataFrame(moved, DOCS)).where("doc_id = 1").first().near_next > 0.6


def test_one_none_and_several_megabytes(spark):
    assert fingerprints.compare_edited(spark.createDataFrame([], DOCS)).count() == 0
    assert fingerprints.fingerprints(spark.createDataFrame([], DOCS)).count() == 0
    one = fingerprints.compare_edited(spark.createDataFrame([doc(1, "abcdefgh")], DOCS)).first()
    assert (one.edited, one.near_next) == ("abcdefab", 1.0)
    text = "".join(f"{i:x} " for i in range(500_000))
    long = fingerprints.compare_edited(spark.createDataFrame([doc(1, text), doc(2, "short")], DOCS)).where("doc_id = 1").first()
    assert long.n_chars == len(text) and long.edited == text[:len(text) - len(text) // 4] + "short" and 0.8 < long.near_edited < 1


def test_wrong_sizes_and_plan(spark):
    docs = spark.createDataFrame([doc(1, "x")], DOCS)
    for k, s in ((5, 5), (30, 6), (5, 0)):
        with pytest.raises(ValueError):
            fingerprints.fingerprints(docs, k, s)
    plan = fingerprints.compare_edited(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
