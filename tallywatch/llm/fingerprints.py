"""Document fingerprints from closed syncmers, in DataFrame functions only.

A k-mer (k consecutive code points) is an anchor where the least hash of its inner s-mers stands at its first or last s-mer. Whether a
k-mer is an anchor depends on nothing outside it, so equal passages have equal anchors wherever they stand, and the anchors of a text put
together from parts are those of the parts and of the places where they meet. Among any k - s consecutive k-mers there is an anchor.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywatch.session import settle

K, S = 21, 6
#: Code points of a text that are worked on at once; blocks overlap by K - 1, so that no k-mer is lost or seen twice.
BLOCK = 4096
#: An anchor is one number: its hash times this, plus its place.
PLACE = 1 << 31
#: Bytes of consecutive texts that are paired in one group, and keys that are put in order in one task, about.
GROUP_BYTES, ORDER_ROWS = 2 << 20, 200_000


def _let(value: str, name: str, body: str) -> str:
    """The body with a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _pairwise_least(hashes: str, distance: int) -> str:
    return f"zip_with({hashes}, slice({hashes}, {distance + 1}, size({hashes})), (p, q) -> if(q < p, q, p))"


def anchors(text: str, k: int = K, s: int = S) -> str:
    """SQL: all anchors of a text in order, as array<bigint> of crc32(k-mer) * PLACE + place (from 0). No text: no anchors.

    The minimum over the w = k - s + 1 s-mers of each k-mer comes from minima over 2, 4, 8, ... s-mers, so a text costs its length
    times log w. Only a block's s-mers are held at once."""
    w = k - s + 1
    grams = lambda n, of: f"regexp_extract_all({of}, '(?s)(?=(.{{{n}}})).', 1)"
    body = (f"filter(transform(least, (m, i) -> if(i + {w} <= size(h) and (m = get(h, i) or m = get(h, i + {w - 1})), "
            f"cast(i as bigint), null)), i -> i is not null)")
    steps, span = [], 1
    while span < w:
        step = min(span, w - span)
        steps.append(step)
        span += step
    for n, step in reversed(list(enumerate(steps))):
        name = "least" if n == len(steps) - 1 else f"m{n + 1}"
        body = _let(_pairwise_least("h" if n == 0 else f"m{n}", step), name, body)
    if not steps:
        body = _let("h", "least", body)
    places = _let(f"transform({grams(s, 'b')}, g -> crc32(g))", "h", body)
    # A k-mer's hash is taken only where it is an anchor.
    kept = _let(grams(k, "b"), "g", f"transform({places}, i -> crc32(get(g, cast(i as int))) * {PLACE}L + i + n * {BLOCK}L)")
    blocks = f"regexp_extract_all({text}, '(?s)(?=(.{{1,{BLOCK + k - 1}}})).{{1,{BLOCK}}}', 1)"
    return f"flatten(transform({blocks}, (b, n) -> if(char_length(b) < {k}, cast(array() as array<bigint>), {kept})))"


def features(anchored: str, text: str) -> str:
    """SQL: one number for each anchor: its hash and the distance from the anchor before (the first one's: from the text's start).
    A text without anchors, but not empty, is its own anchor."""
    each = f"transform({anchored}, (x, i) -> (x div {PLACE}) * 16L + x % {PLACE} - if(i = 0, 0L, get({anchored}, i - 1) % {PLACE}))"
    return f"if(size({anchored}) > 0, {each}, if({text} = '', cast(array() as array<bigint>), array(crc32({text}) * 16L)))"


def written(feature: str) -> str:
    """SQL: the fingerprint: nine hexadecimal digits for each anchor, eight of its hash and one of its distance."""
    return f"array_join(transform({feature}, x -> lpad(hex(x), 9, '0')), '')"


def likeness(a: str, b: str) -> str:
    """SQL: twice the anchors that two texts share at the same distance from the anchor before, over the anchors of both; repeated ones
    count once. Two empty texts: 1. Passages that moved as a whole keep all but their first anchor."""
    n = f"(size(array_distinct({a})) + size(array_distinct({b})))"
    return f"if({n} = 0, 1D, cast(2 * size(array_intersect({a}, {b})) as double) / {n})"


def fingerprints(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """doc_id, anchors: array of (place, hash) in order, fingerprint; one row for each document, without a shuffle.

    Null text: as empty, no anchors and the empty fingerprint. Texts without an anchor (shorter than k, at times up to 2k): no anchors,
    the fingerprint is that of the whole text. Repeated rows: each has its row. Null doc_id: stays null. Empty table: no rows. Other
    columns are not looked at."""
    _checked(k, s)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("t"))
    rows = rows.withColumn("a", F.expr(anchors("t", k, s)))
    shown = F.expr(f"transform(a, x -> struct(x % {PLACE} as place, x div {PLACE} as hash))")
    return rows.select("doc_id", shown.alias("anchors"), F.expr(written(features("a", "t"))).alias("fingerprint"))


def _checked(k: int, s: int) -> None:
    if not 1 <= s < k <= s + 15 or k >= BLOCK:
        raise ValueError("s must lie below k by 1 to 15: a distance is written as one digit")


def followers(docs: DataFrame, group_bytes: int = GROUP_BYTES, order_rows: int = ORDER_ROWS) -> DataFrame:
    """doc_id, text, copies, next_text: each unlike (doc_id, text) once, with the text that comes next in ascending doc_id; after the
    last comes the first. Equal ids are ordered by the text's MD5, null ids come last; `copies` equal rows stand next to each other, so
    all of them but the last are followed by their own text.

    Ids (without texts) are put in order in ranges; running sizes cut the ranges into groups of about `group_bytes`. Texts are sent
    once to have copies folded and once to their group; the first text of a group goes to the group before, too. So no task sorts
    all texts and a group stays small whatever the ids are; a hot id or a hot text is folded before it is sent."""
    return _followed(docs, group_bytes, order_rows, lambda df: df).select(_doc_id(), "text", "copies", "next_text")


def _doc_id():
    return F.when(~F.col("nul"), F.col("id")).alias("doc_id")


def _followed(docs: DataFrame, group_bytes: int, order_rows: int, extend) -> DataFrame:
    key = ["nul", "id", "digest"]
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].isNull().alias("nul"), F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("id"), F.md5(text).alias("digest"), text.alias("text"))
    slim = settle(rows.groupBy(*key).agg(F.max(F.octet_length("text")).cast("long").alias("bytes")))
    ranges = max(1, -(-slim.count() // order_rows))
    slim = settle(slim.repartitionByRange(ranges, *key).withColumn("range", F.spark_partition_id()))
    within = W.partitionBy("range").orderBy(*key)
    before = F.sum("bytes").over(within.rowsBetween(W.unboundedPreceding, -1))
    slim = slim.withColumn("group", F.floor(F.coalesce(before, F.lit(0)) / F.lit(group_bytes)))
    slim = slim.withColumn("at", F.row_number().over(within)).withColumn("group_before", F.lag("group").over(within))
    # One row for each range of ids: how the range before ends.
    ends = slim.groupBy("range").agg(F.max("group").alias("last"))
    last = F.max(F.struct("range", "last")).over(W.orderBy("range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    ends = ends.select(F.col("range").alias("r"), F.coalesce(F.lag(F.struct("range", "last")).over(W.orderBy("range")), last).alias("end"))
    slim = slim.join(ends, slim["range"] == ends["r"])
    home = F.struct("range", "group", F.lit(False).alias("guest"))
    guest = F.when(F.col("group_before").isNull(), F.struct(F.col("end.range"), F.col("end.last").alias("group"), F.lit(True).alias("guest")))
    guest = guest.when(F.col("group_before") != F.col("group"), F.struct("range", F.col("group_before").alias("group"), F.lit(True).alias("guest")))
    places = slim.select(*key, "at", F.array_compact(F.array(home, guest)).alias("places"))
    texts = rows.groupBy(*key).agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    placed = texts.join(places, key).select("nul", "id", "copies", "text", "at", F.inline("places"))
    placed = extend(placed.repartition("range", "group"))
    order = W.partitionBy("range", "group").orderBy("guest", "at")
    follow = {f"next_{c}": F.lead(c).over(order) for c in placed.columns if c in ("text", "a")}
    return placed.withColumns(follow).where("not guest").drop("guest", "range", "group", "at")


def compare_edited(docs: DataFrame, k: int = K, s: int = S, group_bytes: int = GROUP_BYTES, order_rows: int = ORDER_ROWS) -> DataFrame:
    """Every document's fingerprint, and that of its text edited: its last floor(n / 4) code points replaced by the first as many (all,
    if there are fewer) of the document that follows (`followers`). doc_id, n_chars, edited (the text), fingerprint,
    edited_fingerprint, near_edited, near_next; one row for each row of the table.

    The edited text's anchors are those of the part that stays and of the rest from k - 1 code points before the cut; so each text is
    worked through once and its end once more. Null text: as empty. One document: it follows itself. Null and repeated ids: as in
    `followers`. Empty table: no rows. Other columns are not looked at."""
    _checked(k, s)
    rows = _followed(docs, group_bytes, order_rows, lambda df: df.withColumn("a", F.expr(anchors("text", k, s))))
    # All copies of a row but one are followed by their own text.
    own = F.explode(F.when(F.col("copies") > 1, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    rows = rows.select("*", own.alias("own"))
    for c in ("text", "a"):
        rows = rows.withColumn(f"next_{c}", F.when(F.col("own"), F.col(c)).otherwise(F.col(f"next_{c}")))
    rows = rows.withColumn("n", F.length("text")).withColumn("stays", F.expr("n - n div 4"))
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, stays), substring(next_text, 1, n div 4))"))
    rows = rows.withColumn("from", F.expr(f"greatest(stays - {k - 1}, 0)"))
    rows = rows.withColumn("rest", F.expr(anchors("substring(edited, `from` + 1)", k, s)))
    rows = rows.withColumn("b", F.expr(f"concat(filter(a, x -> x % {PLACE} < `from`), transform(rest, x -> x + `from`))"))
    rows = rows.select("nul", "id", "copies", "own", F.col("n").cast("long").alias("n_chars"), "edited", F.expr(features("a", "text")).alias("f"),
                       F.expr(features("b", "edited")).alias("g"), F.expr(features("next_a", "next_text")).alias("o"))
    out = rows.select("nul", "id", "copies", "own", "n_chars", "edited", F.expr(written("f")).alias("fingerprint"), F.expr(written("g")).alias("edited_fingerprint"),
                      F.expr(likeness("f", "g")).alias("near_edited"), F.expr(likeness("f", "o")).alias("near_next"))
    # As many rows as there were, in blocks so that no array grows with the copies.
    blocks = F.explode(F.when(F.col("own"), F.expr("sequence(0L, (copies - 2) div 4096)")).otherwise(F.array(F.lit(0).cast("long"))))
    out = out.select("*", blocks.alias("block"))
    each = F.when(F.col("own"), F.expr("array_repeat(0, cast(least(copies - 1 - block * 4096, 4096) as int))")).otherwise(F.array(F.lit(0)))
    return out.select("*", F.explode(each).alias("_")).select(_doc_id(), *[c for c in out.columns if c not in ("nul", "id", "copies", "own", "block")])
