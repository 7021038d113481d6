"""License scans and sharding."""
import random
import zlib
from collections import Counter

from cases import DOCS, FOLD, doc, hard_documents, words
from pyspark.sql import functions as F

from tallywatch.llm import licenses, sharding

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def plain_places(text):
    w = words(text)
    return sorted((label, i) for phrase, label in BASE.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split())


def test_base_phrases_at_every_place(spark):
    rng = random.Random(1)
    bits = [*BASE, "mit", "license", "under the", "apache license version", "CC BY-NC", "Under The MIT  License", "cc", "by", "nc", "2", "x"]
    rows = hard_documents() + [doc(1000 + i, rng.choice([" ", ". ", "\n"]).join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    found = licenses.scan(spark.createDataFrame(rows, DOCS)).collect()
    got = Counter((r.doc_id, r.n_words, tuple(sorted((p.label, p.start) for p in r.places if p.base))) for r in found)
    assert got == Counter((r[0], len(words(r[1])), tuple(plain_places(r[1]))) for r in rows)


def test_notices_need_their_key_phrases(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
    rows = [doc(1, f"x y {notice}"), doc(2, notice.replace("without restriction", "with limits")), doc(3, notice.replace("any person", "any other person")),
            doc(4, "This work is licensed under the GNU General Public License, version 3.")]
    got = {r.doc_id: [(p.label, p.start, round(p.share, 2)) for p in r.places] for r in licenses.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1] == [("mit", 2, 1.0)] and got[2] == [] and got[4] == [("gpl-3", 6, 1.0)]
    assert got[3][0][:2] == ("mit", 0) and 0.3 < got[3][0][2] < 1


def test_no_documents(spark):
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0
    assert sharding.shard_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_shards_are_even_and_keep_the_mixture(spark):
    rows = hard_documents() + [doc(2000 + i, f"t{i}", source="hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS)
    out = sharding.shard_documents(docs, 24).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    count = Counter(r.shard for r in out)
    assert set(count) == set(range(24)) and max(count.values()) - min(count.values()) <= 1
    assert all(sorted(r.slot for r in out if r.shard == s) == list(range(count[s])) for s in count)
    hot = Counter(r.shard for r in out if r.source == "hot")
    # Within rounding of each of the other nine strata.
    assert max(hot.values()) - min(hot.get(s, 0) for s in range(24)) <= 9


def test_buckets_do_not_change_the_order(spark):
    slim = spark.createDataFrame([doc(i, f"t{i}", source=f"s{i % 5 % 3}") for i in range(300)], DOCS).select("doc_id", "source")
    one, many = (sorted(map(tuple, sharding.interleave(slim, 7, task_rows=n).collect())) for n in (10_000, 10))
    assert one == many


def test_plans_have_no_python(spark):
    for df in (licenses.scan(spark.createDataFrame([doc(1, "x")], DOCS)), sharding.shard_documents(spark.createDataFrame([doc(1, "x")], DOCS))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_translate_is_ascii_only(spark):
    assert "K".translate(FOLD) == "K"
    row = spark.createDataFrame([("KA b",)], "text string").select(licenses.words_of(F.col("text")).alias("w")).first()
    assert row.w == ["Ka", "b"]
