"""Exact top-k search, and the pipeline's stages on hard tables."""
import math
import random
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from cases import DOCS, doc, hard_documents, words
from test_texts import BENCH, plain_classes, plain_hits, plain_repeats

from tallywatch.llm import kdtree, neardup

VECTORS = "vec_id long, embedding array<float>, label int, shard int, query_id long"


def plain_top(rows, k=5):
    ints = [(i, [float(math.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in ints:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        best = sorted((-int(sum(a * b for a, b in zip(v, u))), i) for i, u in ints if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return Counter(out)


@pytest.mark.parametrize("shard_rows", [10_000, 90])
def test_top_k(spark, shard_rows):
    rng = random.Random(2)
    vector = lambda: [rng.randint(-64, 64) / 64 for _ in range(6)]
    same = vector()
    rows = [(i, vector()) for i in range(500)] + [(i, same) for i in range(500, 900)]
    rows += [(1000, None), (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1100, [float("nan")] * 6), (1150, [float("inf")] + [0.0] * 5), (None, vector()), (1200, [0.0] * 6), rows[3], (100, vector())]
    rng.shuffle(rows)
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS)
    v = table.select("vec_id", kdtree.integers().alias("v"))
    out = kdtree.top_k(v, v.where("vec_id % 50 = 0"), 5, shard_rows).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == plain_top(rows)


def test_top_k_in_blocks_of_queries(spark, monkeypatch):
    """Queries meet the other shards in blocks, and the hits are those of plain search."""
    rng = random.Random(5)
    rows = [(i, [rng.randint(-64, 64) / 64 for _ in range(4)]) for i in range(3000)]
    v = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS).select("vec_id", kdtree.integers().alias("v"))
    kept, search = [], kdtree._search
    monkeypatch.setattr(kdtree, "_search", lambda dealt, asked, k, blocks=1: kept.append((asked, blocks)) or search(dealt, asked, k, blocks))
    out = kdtree.top_k(v, v.where("vec_id % 50 = 0"), 5, 1000, asked_rows=10).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == plain_top(rows)
    assert [b for _, b in kept] == [1, 6]


def test_top_k_of_large_components_is_exact(spark):
    """Scores beyond 2**53 differ by less than doubles tell apart."""
    rng = random.Random(8)
    rows = [(i, [float(rng.randint(750_000_000, 770_000_000)) for _ in range(4)]) for i in range(400)]
    v = spark.createDataFrame(rows, "vec_id long, v array<double>")
    for shard_rows in (10_000, 90):
        out = kdtree.top_k(v, v.where("vec_id % 50 = 0"), 5, shard_rows).collect()
        want = Counter()
        for q, a in rows[::50]:
            best = sorted((-sum(int(x) * int(y) for x, y in zip(a, b)), i) for i, b in rows if i != q)[:5]
            want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(best))
        assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == want


def test_top_k_of_few(spark):
    for rows in ([], [(0, [1.0])], [(0, [1.0]), (7, [0.5])]):
        v = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], VECTORS).select("vec_id", kdtree.integers().alias("v"))
        assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in kdtree.top_k(v, v.where("vec_id % 50 = 0")).collect()) == plain_top(rows)


def as_rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(9)
    item = " ".join(f"b{rng.randint(0, 99)}" for _ in range(25))
    rows = hard_documents(11) + [doc(400 + i, " ".join(f"w{rng.randint(0, 300)}" for _ in range(30)) + " " + item, "de", "bench") for i in range(4)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item, 0), (2, None, 0)], BENCH).write.parquet(f"{folder}/benchmark.parquet")
    return folder, item


def test_stages_against_plain_versions(spark, tables, tmp_path):
    folder, item = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, out = as_rows(docs), stage(spark, docs, folder)
        if name == "packing":
            tokens = defaultdict(int)
            for r in out.collect():
                tokens[r.doc_id] += r.length
            assert set(tokens) == {r[0] for r in before}
            break
        out.write.parquet(path := str(tmp_path / name))
        after = spark.read.parquet(path)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        rows = as_rows(after)
        if name == "language":
            gone = Counter(before) - Counter(rows)
            assert not Counter(rows) - Counter(before) and all(not any(c.isalpha() for c in r[1] or "") for r in gone)
        elif name == "near_duplicates":
            classes = {i for i, c in plain_classes(before) if i is not None and i == c}
            assert Counter(r[0] for r in rows if r[0] is not None) == Counter(classes)
        elif name == "substring_dedup":
            assert Counter((r[0], r[1]) for r in rows) == Counter((i, kept) for (i, _, _, kept), n in plain_repeats(before).items() for _ in range(n))
            assert all(r[4] == len(r[1]) for r in rows)
        else:
            hit = {i for i, _, n, _ in plain_hits(before, [(1, item)]) if n}
            assert hit and Counter(rows) == Counter(r for r in before if r[0] not in hit)
        docs = after


def test_near_copies_without_ids_and_unlike_texts_of_one_id(spark):
    rng = random.Random(13)
    text = lambda: [f"w{rng.randint(0, 100_000)}" for _ in range(150)]
    rows, want = [], Counter()
    for i in range(12):  # three near copies, one of them without id
        base = text()
        for j in range(3):
            base[10 + 50 * j] = f"own{j}"
            rows.append(doc(None if j == 1 else 10 * i + j, " ".join(base)))
        want[10 * i] += 1
    a, b = text(), text()
    rows += [doc(900, " ".join(a)), doc(900, " ".join(b)), doc(901, " ".join([*a[:-1], "x"])), doc(902, " ".join([*b[:-1], "x"])), doc(900, ""), doc(900, " ".join(a)), doc(900, ", ".join(a))]
    got = {(r.doc_id, r.class_id) for r in neardup.classes(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(k, 10 * i) for i in range(12) for k in (10 * i, None, 10 * i + 2)} | {(900, 900), (901, 900), (902, 900)}
    kept = [(r.doc_id, tuple(words(r.text))) for r in corpus_pipeline.without_copies(spark, spark.createDataFrame(rows, DOCS), "").collect() if r.doc_id is not None]
    assert Counter(i for i, _ in kept) == want + Counter({900: 3}) and {w for i, w in kept if i == 900} == {tuple(a), tuple(b), ()}


def test_run_gives_what_the_stages_give(spark, tables):
    out = corpus_pipeline.run(spark, tables[0]).collect()
    assert out and {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(out[0].asDict())


def test_stages_on_no_documents(spark, tables):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], DOCS), tables[0]).count() == 0


def test_columns_named_like_results_go_along(spark, tables):
    own = "doc_id long, text string, lang string, source string, n_chars long, n_words long, removed string, kept string, n_removed long, hits string, matches string, carry0 string, `a.b` string"
    rows = [(i, f"one two three {i}", "en", "s", 3, 4, "r", "k", 5, "h", "m", "c", "d") for i in range(4)]
    docs = spark.createDataFrame(rows, own)
    for name, stage in corpus_pipeline.STAGES[2:4]:
        out = stage(spark, docs, tables[0])
        assert out.columns == docs.columns, name
        assert sorted(tuple(r)[5:] for r in out.collect()) == sorted(r[5:] for r in rows)


def test_workers_need_no_installation():
    """A session of its own, from a folder without the package: executors get the code before the first function runs there."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from tallywatch import session
spark = session.build("local[2]", 2, **{{"spark.ui.enabled": "false", "spark.log.level": "ERROR"}})
from tallywatch.llm import language
docs = spark.createDataFrame([(f"the house number {{i}} is old", "en") for i in range(5)], "text string, lang string")
print("languages", language.fit(docs).languages)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd="/", env=env, capture_output=True, text=True, timeout=120)
    assert "languages ['en']" in done.stdout, done.stderr[-2000:]


def test_words_are_those_of_the_pattern():
    import pyarrow as pa
    from cases import UNSPACED

    from tallywatch.llm.words import FOLDED, UNSPACED as SPACES, hash_words, word_chunks
    texts = [r[1] for r in hard_documents(12)] + ["é x\x1cy", " a b", "a\x0bb"]
    for kind, plain in ((FOLDED, words), (SPACES, lambda t: UNSPACED.findall(t or ""))):
        got = []
        for w in word_chunks(pa.array(texts, pa.string()), kind, 500):
            for d in range(w.high - w.low):
                part = slice(w.first[d], w.first[d + 1])
                own = [bytes(w.data[a:b]).decode() for a, b in zip(w.start[part], w.end[part])]
                assert not own or (hash_words(own, kind) == w.hash[part]).all()
                got.append([x.translate({65 + i: 97 + i for i in range(26)}) if kind == FOLDED else x for x in own])
        assert got == [plain(t) for t in texts]
