"""Near-duplicate classes: consistent weighted sampling over TF-IDF word shingles, banded, verified by weighted Jaccard similarity."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.words import FOLDED, U64, gram_hashes, mix, ranges, ready, run_hashes, word_chunks
from tallywatch.session import settle

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 9, 3
#: Shingles in more than this share of all documents weigh less; the others have the full weight log(1 / SHARE).
SHARE = 0.01
TABLE_BITS = 14
#: Leftover texts of a bucket that one task compares with as many others.
GROUP = 1000
#: Texts beside its centre that a bucket's unconnected texts are compared with.
PIVOTS = 4
#: Bits of the bitmap that rows pass before they are sent: 8 MB.
SIEVE_BITS = 1 << 26

_random = np.random.RandomState(7)
_GAMMA_R = _random.gamma(2.0, 1.0, 1 << TABLE_BITS)
_LOG_C = np.log(_random.gamma(2.0, 1.0, 1 << TABLE_BITS))
_HASHES = _random.randint(0, 1 << 62, (BANDS * ROWS, 2), dtype=np.int64).astype(U64) * U64(2) + U64(1)


def shingles(w) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a chunk's texts: text, hash (ascending within a text), times. A text of fewer than five words, but not
    none, is one shingle."""
    n_texts = len(w.first) - 1
    length = np.diff(w.first)
    grams = gram_hashes(w.hash, SHINGLE)
    at = np.arange(len(grams))
    owner = np.repeat(np.arange(n_texts), length)
    whole = owner[:len(grams)] == owner[SHINGLE - 1:] if len(grams) else np.zeros(0, bool)
    text, value = owner[at[whole]], grams[whole]
    short = np.flatnonzero((length > 0) & (length < SHINGLE))
    if len(short):
        spare = []
        for d in short:
            h = w.hash[w.first[d]:w.first[d + 1]]
            spare.append(gram_hashes(np.concatenate((h, np.zeros(SHINGLE - len(h), U64))), SHINGLE)[0])
        text, value = np.concatenate((text, short)), np.concatenate((value, np.array(spare, U64)))
        order = np.argsort(text, kind="stable")
        text, value = text[order], value[order]
    # Sorted text by text: the sort of one text's hashes is the fast kind.
    bound = np.searchsorted(text, np.arange(n_texts + 1))
    value = value.copy()
    for d in range(n_texts):
        value[bound[d]:bound[d + 1]].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return text[first], value[first], np.diff(np.append(first, len(value)))


class Weights:
    """log(documents / documents with the shingle), at most log(1 / SHARE): exact counts for the frequent shingles, the full
    weight for the rest. At most (mean shingles of a document) / SHARE shingles can be frequent, however many documents there are."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, n: int):
        order = np.argsort(hashes)
        self.full = float(np.log(1 / SHARE))
        self.hash = hashes[order]
        # Never nought: a shingle that all documents share still tells something of two short texts.
        self.weight = np.clip(np.log(n / np.maximum(counts[order], 1)), 0.05, self.full) if n else np.zeros(0)

    def of(self, value: np.ndarray, times: np.ndarray) -> np.ndarray:
        out = np.full(len(value), self.full)
        if len(self.hash):
            at = np.minimum(np.searchsorted(self.hash, value), len(self.hash) - 1)
            known = self.hash[at] == value
            out[known] = self.weight[at[known]]
        return out * times


def weights(docs: DataFrame) -> Weights:
    """Two passes over all texts. First each Arrow batch reports the shingles in at least SHARE / 4 of its documents; a shingle whose
    reported and possible unreported documents together fall short of SHARE can't be frequent. What is left stands in at least
    3/4 of SHARE of all documents, so it is at most (mean shingles of a document) / (0.75 * SHARE) shingles, however many
    documents there are. The second pass counts these exactly."""

    least = SHARE / 4

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, n = [], 0
            for w in word_chunks(batch.column("text"), FOLDED):
                parts.append(shingles(w)[1])
                n += int((np.diff(w.first) > 0).sum())
            value, count = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, U64), np.zeros(0, np.int64))
            keep = count >= least * n
            # h = 0 carries the number of documents that have words.
            h, c = np.append(value[keep].astype(np.int64), 0), np.append(count[keep], 0)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(c, pa.int64()), pa.array(np.full(len(h), n), pa.int64())], ["h", "n", "of"])

    def count(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(shared.value), np.int64)
            for batch in batches:
                for w in word_chunks(batch.column("text"), FOLDED, 4 << 20):
                    value = shingles(w)[1]
                    at = np.minimum(np.searchsorted(shared.value, value), len(shared.value) - 1)
                    total += np.bincount(at[shared.value[at] == value], minlength=len(total))
            keep = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(shared.value[keep].astype(np.int64), pa.int64()), pa.array(total[keep], pa.int64())], ["h", "n"])

        return run

    text = docs.select("text")
    local = settle(text.mapInArrow(frequent, "h long, n long, of long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("of").alias("of")))
    n = (local.where("h = 0").agg(F.sum("of")).first() or [0])[0] or 0
    # Where a chunk did not report a shingle, it stands in fewer than `least` of the documents.
    possible = F.col("n") + least * (n - F.col("of")) >= SHARE * n
    candidates = np.sort(local.where(possible & (F.col("h") != 0)).select("h").toArrow()["h"].to_numpy().astype(U64))
    if not len(candidates):
        return Weights(candidates, np.zeros(0, np.int64), n)
    counted = text.mapInArrow(count(docs.sparkSession.sparkContext.broadcast(candidates)), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    kept = counted.where(F.col("n") >= F.lit(n * SHARE)).toArrow()
    return Weights(kept["h"].to_numpy().astype(U64), kept["n"].to_numpy(), n)


def samples(text: np.ndarray, value: np.ndarray, weight: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Improved consistent weighted sampling: for each text with shingles (bound: where each begins) BANDS * ROWS samples, hashes
    of (shingle, level). The gamma and uniform variates of a shingle are drawn from tables by its hash."""
    log_w = np.log(weight)
    out = np.empty((BANDS * ROWS, len(bound)), U64)
    own = np.repeat(np.arange(len(bound)), np.diff(np.append(bound, len(value))))
    low = U64((1 << TABLE_BITS) - 1)
    for k, (a, b) in enumerate(_HASHES):
        h = value * a + b
        h ^= h >> U64(31)
        h *= U64(0xBF58476D1CE4E5B9)
        r = _GAMMA_R[(h >> U64(64 - TABLE_BITS)).astype(np.int64)]
        beta = ((h >> U64(18)) & U64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32
        level = np.floor(log_w / r + beta)
        score = _LOG_C[(h & low).astype(np.int64)] - r * (level - beta + 1)
        best = np.minimum.reduceat(score, bound)
        at = np.flatnonzero(score == best[own])
        # Equal scores: the least hash, so that the choice depends on the shingles alone.
        pick = value[at] + level[at].astype(np.int64).astype(U64) * U64(0x9E3779B97F4A7C15)
        chosen = own[at]
        begin = np.flatnonzero(np.append([True], chosen[1:] != chosen[:-1]))
        out[k] = np.minimum.reduceat(pick, begin)
    return out


def signatures(docs: DataFrame, w: Weights, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_key, content (hash of the words; null without words), bands (array of long). A band's key holds the text's weight class,
    too: weights of similar texts differ by the factor 1 / similarity at most, so their classes are the same or next to each
    other. Each text has a key for its own class and one for the class above, and so shares a key with both kinds."""
    shared = docs.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text_keys = batch.column("doc_id"), batch.column("text_key")
            for c in word_chunks(batch.column("text"), FOLDED, 1 << 20):
                text, value, times = shingles(c)
                n = c.high - c.low
                bound = np.searchsorted(text, np.arange(n))
                some = np.flatnonzero(np.diff(np.append(bound, len(text))) > 0)
                content = run_hashes(c.hash, c.first[:-1], c.first[1:]).astype(np.int64)
                keys = np.zeros((n, 2 * BANDS), np.int64)
                if len(some):
                    weight = shared.value.of(value, times)
                    sample = samples(text, value, weight, bound[some])
                    level = np.floor(np.log(np.add.reduceat(weight, bound[some])) / -np.log(similarity)).astype(np.int64).astype(U64)
                    for band in range(BANDS):
                        key = np.full(len(some), U64(band + 1))
                        for row in range(ROWS):
                            key = mix(key * U64(0x9E3779B97F4A7C15) + sample[band * ROWS + row])
                        keys[some, 2 * band] = mix(key + level).astype(np.int64)
                        keys[some, 2 * band + 1] = mix(key + level + U64(1)).astype(np.int64)
                present = np.zeros(n, bool)
                present[some] = True
                at = np.concatenate(([0], np.cumsum(np.where(present, 2 * BANDS, 0)))).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys[present].ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays([ids.slice(c.low, n), text_keys.slice(c.low, n), pa.array(content, pa.int64(), mask=~present), bands], ["doc_id", "text_key", "content", "bands"])

    return docs.select("doc_id", text_key(docs).alias("text_key"), "text").mapInArrow(run, "doc_id long, text_key long, content long, bands array<long>")


def possible(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Adds `key may match`: whether the row's key may be among the keys, told by a bitmap of SIEVE_BITS bits, whatever the number of keys; so what
    is broadcast has a fixed size. Rows let through by chance do no harm where an exact join follows; the more keys there are, the more pass."""
    place = F.pmod(F.col(key), F.lit(SIEVE_BITS))
    pages = keys.select(place.alias("place")).groupBy(F.floor(F.col("place") / 32768).alias("_page")).agg(F.bitmap_construct_agg(F.col("place") % 32768).alias("_bits"))
    at = f"pmod(`{key}`, {SIEVE_BITS}L)"
    bit = f"shiftright(cast(conv(hex(substring(_bits, cast(({at} % 32768) div 8 as int) + 1, 1)), 16, 10) as int), cast({at} % 8 as int)) & 1"
    return rows.join(F.broadcast(pages), F.floor(place / 32768) == F.col("_page"), "left").withColumn("key may match", F.expr(f"coalesce({bit}, 0) = 1")).drop("_page", "_bits")


def _sifted(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    return possible(rows, key, keys).where("`key may match`").drop("key may match")


def vectors(docs: DataFrame) -> DataFrame:
    """content, shingles (ascending 64-bit hashes) and times (32-bit; empty if all are 1) as packed bytes, for texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in word_chunks(batch.column("text"), FOLDED, 1 << 20):
                text, value, times = shingles(c)
                content = run_hashes(c.hash, c.first[:-1], c.first[1:]).astype(np.int64)
                bound = np.searchsorted(text, np.arange(c.high - c.low + 1))
                own = [(k, a, b) for k, a, b in zip(content, bound[:-1], bound[1:]) if a < b]
                packed = [times[a:b].astype(np.int32).tobytes() if times[a:b].max() > 1 else b"" for _, a, b in own]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in own], pa.int64()), pa.array([value[a:b].tobytes() for _, a, b in own], pa.binary()), pa.array(packed, pa.binary())], ["content", "shingles", "times"])

    return docs.select("text").mapInArrow(run, "content long, shingles binary, times binary")


def verified(pairs: DataFrame, vec: DataFrame, w: Weights) -> DataFrame:
    """a, b, similarity: weighted Jaccard similarity of each pair's whole texts."""
    shared = pairs.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for sa, ta, sb, tb in zip(*(batch.column(c) for c in ("sa", "ta", "sb", "tb"))):
                a, b = np.frombuffer(sa.as_buffer(), U64), np.frombuffer(sb.as_buffer(), U64)
                wa, wb = (shared.value.of(x, np.frombuffer(t.as_buffer(), np.int32) if len(t.as_buffer()) else 1) for x, t in ((a, ta), (b, tb)))
                at = np.minimum(np.searchsorted(a, b), max(0, len(a) - 1))
                same = a[at] == b
                common = np.minimum(wa[at[same]], wb[same]).sum()
                out.append(common / (wa.sum() + wb.sum() - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], ["a", "b", "similarity"])

    vec = _sifted(vec, "content", pairs.select(F.explode(F.array("a", "b")).alias("content")))
    left = vec.select(F.col("content").alias("a"), F.col("shingles").alias("sa"), F.col("times").alias("ta"))
    right = vec.select(F.col("content").alias("b"), F.col("shingles").alias("sb"), F.col("times").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "ta", "sb", "tb").mapInArrow(run, "a long, b long, similarity double")


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node of its connected component. Least labels spread along links and by jumps to the label's own
    label until nothing changes; links and labels stay distributed."""
    edges = settle(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    labels = settle(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")))
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        moved = settle(step.join(jump, "next", "left").select("node", "label", F.least("next", F.coalesce("further", "next")).alias("next")))
        labels = moved.select("node", F.col("next").alias("label"))
        if not moved.where("label <> next").limit(1).count():
            return labels


def text_key(docs: DataFrame) -> Column:
    """Tells the texts of rows with the same doc_id, or with none, apart."""
    return F.xxhash64(docs["text"])


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), n_links (links verified between this document's text and other texts).

    Method: shingles of five words weigh times * log inverse document frequency; consistent weighted sampling (ICWS) makes
    signatures, cut into BANDS bands. Documents with the same words are one text from then on. Texts that share a band key form a
    bucket, and classes are the connected components of the links verified within buckets; see `_links` for how a bucket's
    links are found without comparing all its pairs.

    Null doc_id: takes part, but its row has the class of its text, or null if there is no other. Null text or no words: a class
    of its own. Repeated rows: each row is returned, with the same class. Texts of fewer than five words are one shingle. Empty
    table: no rows. Other columns are not looked at.
    """
    return placed(docs, similarity).select("doc_id", "class_id", "n_links")


def placed(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """What `classes` returns, and of each row text_key, content (null without words) and keeper: the content, among those of the
    class, that has class_id (the least if several have it, or if none has a doc_id). Classes may share a class_id where unlike texts
    share a doc_id; their keepers differ."""
    ready(docs.sparkSession)
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    w = weights(slim)
    sig = settle(signatures(slim, w, similarity))
    # One row stands for each content, found again by doc_id and text_key; one without doc_id only where all are.
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    texts = sig.where("content is not null").groupBy("content").agg(F.min(row).alias("row"), F.min("bands").alias("bands"))
    texts = settle(texts.select("content", F.col("row.doc_id").alias("text_id"), F.col("row.text_key").alias("text_key"), "bands"))
    keyed = settle(texts.select("content", "text_id", "text_key", F.explode("bands").alias("bucket")))
    crowded = keyed.groupBy("bucket").agg(F.count("*").alias("m"), F.min("content").alias("centre")).where("m > 1")
    members = settle(keyed.join(crowded, "bucket").select("bucket", "content", "text_id", "text_key", "centre"))
    # Texts stay where they are: vectors are made of rows that a bitmap lets through. Rows repeated with id and text are one.
    key = lambda i: F.xxhash64(i, "text_key").alias("row_key")
    own = slim.withColumn("text_key", text_key(slim)).select(key("doc_id"), "text")
    vec = vectors(_sifted(own, "row_key", members.select(key("text_id"))))
    vec = settle(vec.groupBy("content").agg(F.first(F.struct("shingles", "times")).alias("v")).select("content", "v.*"))
    links = _links(members.select("bucket", "content", "centre"), vec, w, similarity)
    label = components(links).withColumnRenamed("node", "content")
    degree = links.select(F.col("a").alias("content")).union(links.select("b")).groupBy("content").agg(F.count("*").alias("n_links"))
    linked = settle(label.join(degree, "content").join(texts.select("content", "text_id"), "content"))
    first = F.min(F.struct(F.col("text_id").isNull().alias("nameless"), "text_id", "content")).alias("first")
    named = linked.join(linked.groupBy("label").agg(first), "label").select("content", F.col("first.text_id").alias("class_id"), F.col("first.content").alias("keeper"), "n_links")
    known = texts.select("content", "text_id").join(named, "content", "left")
    known = known.select("content", F.coalesce("class_id", "text_id").alias("class_id"), F.coalesce("keeper", "content").alias("keeper"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return sig.join(known, "content", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                                     "text_key", "content", "keeper")


def _pairs(df: DataFrame, u: str, v: str) -> DataFrame:
    return df.select(F.least(u, v).alias("a"), F.greatest(u, v).alias("b")).where("a <> b").distinct()


def _links(members: DataFrame, vec: DataFrame, w: Weights, similarity: float) -> DataFrame:
    """Links a, b (contents) from members (bucket, content, centre), enough to connect all texts of a bucket that are similar.

    1. Each text is compared with the least centre of its buckets; the texts of a group of near copies are compared about once.
    2. What is not connected to its bucket's centre then is compared with the centre, and in larger buckets with PIVOTS more texts.
    3. Few are left. A text apart from the centre may still be similar to one connected to it; by the triangle inequality of
       weighted Jaccard distance that one's distance from the centre is at most 1 - similarity less. Those texts and the ones
       apart are compared in blocks of GROUP, within tasks; only links leave a task.
    """
    near = 1 - similarity
    links: list[DataFrame] = []
    compared = None

    def all_links() -> DataFrame:
        out = links[0]
        for part in links[1:]:
            out = out.unionByName(part)
        return out.distinct()

    def compare(pairs: DataFrame) -> None:
        nonlocal compared
        new = settle(verified(settle(pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti")), vec, w))
        links.append(new.where(F.col("similarity") >= similarity).select("a", "b"))
        compared = new if compared is None else compared.unionByName(new)

    def connected(rows: DataFrame) -> DataFrame:
        """Adds `label` and `centre_label`."""
        label = components(all_links())
        own = label.select(F.col("node").alias("content"), "label")
        centre = label.select(F.col("node").alias("centre"), F.col("label").alias("centre_label"))
        out = rows.join(own, "content", "left").join(centre, "centre", "left")
        return settle(out.withColumns({"label": F.coalesce("label", "content"), "centre_label": F.coalesce("centre_label", "centre")}))

    others = members.where("content <> centre")
    compare(_pairs(others.groupBy("content").agg(F.min("centre").alias("centre")), "centre", "content"))
    loose = connected(others).where("label <> centre_label")
    chosen = [F.min_by("content", F.xxhash64("content", F.lit(k))).alias(f"p{k}") for k in range(PIVOTS)]
    pivots = members.groupBy("bucket").agg(F.count("*").alias("m"), *chosen).where(F.col("m") >= 5 * PIVOTS)
    pivots = pivots.select("bucket", F.explode(F.array(*[f"p{k}" for k in range(PIVOTS)])).alias("pivot"))
    tried = loose.select("centre", "content").union(loose.join(pivots, "bucket").select("pivot", "content"))
    compare(_pairs(tried, "centre", "content"))
    judged = connected(others)
    unsettled = settle(judged.where("label <> centre_label").select("bucket").distinct())
    judged = settle(judged.join(unsettled, "bucket"))
    # Distances from the centre of texts that were connected another way.
    compare(_pairs(judged.where("label = centre_label"), "centre", "content"))
    judged = judged.withColumns({"a": F.least("centre", "content"), "b": F.greatest("centre", "content"), "apart": F.col("label") != F.col("centre_label")})
    judged = settle(judged.join(compared, ["a", "b"]).select("bucket", "content", "label", "apart", (1 - F.col("similarity")).alias("d")))
    least = judged.where("apart").groupBy("bucket").agg(F.min("d").alias("least"))
    judged = judged.join(least, "bucket").where(F.col("apart") | (F.col("d") >= F.col("least") - near))
    links.append(settle(_within(judged.select("bucket", "content", "label", "apart"), vec, w, similarity)))
    return settle(all_links())


def _within(rows: DataFrame, vec: DataFrame, w: Weights, similarity: float) -> DataFrame:
    """Links a, b between the texts apart and all other texts of each bucket (bucket, content, label, apart), enough to connect
    what is similar. A task gets a block of GROUP texts apart with GROUP others; buckets that bands have in common are done once."""
    shared = rows.sparkSession.sparkContext.broadcast(w)
    count = lambda c: F.greatest(F.lit(1), F.ceil(F.count_if(c) / GROUP)).cast("int")
    sizes = rows.groupBy("bucket").agg(count(F.col("apart")).alias("rows"), count(~F.col("apart")).alias("columns"), F.count("*").alias("m"), F.min("label").alias("l"),
                                       F.max("label").alias("h"), F.count_if(~F.col("apart")).alias("n_in"), F.sum(F.xxhash64("content", "apart").cast("decimal(38,0)")).alias("all"))
    sizes = sizes.where("l <> h or n_in > 0").groupBy("m", "all", "n_in").agg(F.min_by(F.struct("bucket", "rows", "columns"), "bucket").alias("s")).select("s.*")
    at = F.struct(F.pmod(F.xxhash64("content", F.lit(0)), F.col("rows")).alias("row"), F.pmod(F.xxhash64("content", F.lit(1)), F.col("columns")).alias("column"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), (F.col(n) - 1).cast("long"))
    apart = F.concat(F.transform(upto("columns"), lambda c: F.struct(F.lit("in").alias("kind"), F.col("at.row").alias("i"), c.alias("j"))),
                     F.transform(upto("rows"), lambda r: F.struct(F.lit("apart").alias("kind"), F.least(r, "at.row").alias("i"), F.greatest(r, "at.row").alias("j"))))
    inside = F.transform(upto("rows"), lambda r: F.struct(F.lit("in").alias("kind"), r.alias("i"), F.col("at.column").alias("j")))
    blocks = rows.join(sizes, "bucket").withColumn("at", at).select("bucket", "content", "label", "apart", F.explode(F.when(F.col("apart"), apart).otherwise(inside)).alias("block"))

    def run(table: pa.Table) -> pa.Table:
        content, first = np.unique(table["content"].to_numpy(), return_index=True)
        rows = table.take(pa.array(first))
        label, m = rows["label"].to_numpy().copy(), len(content)
        columns: list = [(), ()]
        if (label != label[0]).any():
            value = [np.frombuffer(x.as_buffer(), U64) for x in rows["shingles"]]
            weight = [shared.value.of(v, np.frombuffer(t.as_buffer(), np.int32) if len(t.as_buffer()) else 1) for v, t in zip(value, rows["times"])]
            total = np.array([x.sum() for x in weight])
            every, owner, weighed = np.concatenate(value), np.repeat(np.arange(m), [len(v) for v in value]), np.concatenate(weight)
            order = np.argsort(every)
            every, owner, weighed = every[order], owner[order], weighed[order]
            out = []
            for i in np.flatnonzero(rows["apart"].to_numpy(zero_copy_only=False)):
                if (label == label[i]).all():
                    break
                low, high = np.searchsorted(every, value[i], "left"), np.searchsorted(every, value[i], "right")
                at = ranges(low, high - low)
                common = np.bincount(owner[at], np.minimum(weighed[at], np.repeat(weight[i], high - low)), m)
                for j in np.flatnonzero(common >= similarity * (total + total[i] - common)):
                    if label[j] != label[i]:
                        out.append((min(content[i], content[j]), max(content[i], content[j])))
                        label[label == label[j]] = label[i]
            columns = list(zip(*out)) or columns
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    blocks = settle(blocks)
    ready_rows = blocks.join(_sifted(vec, "content", blocks.select("content")), "content").select("bucket", "block", "content", "label", "apart", "shingles", "times")
    return ready_rows.groupBy("bucket", "block").applyInArrow(run, "a long, b long").distinct()
