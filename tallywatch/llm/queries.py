"""The registered queries of these operators, and their SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"list_filter(string_split_regex({LOW}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


# ---- 1: license scans ----
def _license_sql() -> str:
    from tallywatch.llm.licenses import SLACK, TEMPLATES

    parts = []
    for t in TEMPLATES:
        (first, key), *more = t.phrases()
        lit = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
        check = f"p >= 0 and w[p + {first} + 1:p + {first + len(key)}] = {lit(key)}"
        for place, k in more:
            check += f" and len(list_filter(range(greatest(p + {place - SLACK}, 0), greatest(p + {place + SLACK}, 0) + 1), lambda q: w[q + 1:q + {len(k)}] = {lit(k)})) > 0"
        share = "1.0" if not (more or t.keys) else f"list_sum(list_transform(range({len(t.words)}), lambda j: case when w[p + j + 1] = ({lit(t.words)})[j + 1] then 1 else 0 end)) / {len(t.words)}.0"
        parts.append(f"select doc_id, '{t.label}' as label, {str(t.base).lower()} as base, p as start, {share} as share "
                     f"from (select doc_id, w, unnest(range(len(w))) - {first} as p from d where list_has_all(w, {lit(key)})) where {check}")
    return f"""with d as (select doc_id, {WORDS} as w from documents), hit as ({' union all '.join(parts)}),
        g as (select doc_id, count(*) filter (where base) as n_base, min(start) filter (where base) as first_word, max(start) filter (where base) as last_word,
            string_agg(distinct label, ',' order by label) filter (where base) as base_labels, string_agg(distinct label, ',' order by label) as labels, max(share) as score
            from hit group by doc_id)
        select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base, cast(first_word as bigint) as first_word,
            cast(last_word as bigint) as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, cast(coalesce(score, 0) as double) as score
        from d left join g on d.doc_id = g.doc_id"""


@register("op1_licenses", _license_sql())
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import licenses

    found = licenses.scan(table(spark, sf_dir, "documents")).withColumn("b", F.filter("places", lambda p: p.base))
    joined = lambda c: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(c, lambda p: p.label))))
    starts = F.transform("b", lambda p: p.start)
    return found.select("doc_id", "n_words", F.size("b").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        joined("b").alias("base_labels"), joined("places").alias("labels"),
                        F.coalesce(F.array_max(F.transform("places", lambda p: p.share)), F.lit(0.0)).alias("score"))


# ---- 5: url filters ----
URL_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: Hosts whose pages are blocked where no rule fits.
LISTED_HOSTS = ("spam-farm.example.org", "link-farm.example.net", "casino.example.net", "cheap-pills.example.org")


def _url_sql() -> str:
    rules = ", ".join(f"('{k}', '{k.partition('/')[0]}', '/{k.partition('/')[2]}', '{v}')" for k, v in URL_RULES)
    listed = " or ".join(f"host = '{h}' or ends_with(host, '.{h}')" for h in LISTED_HOSTS)
    return rf"""with s as (select page_id, case when contains(url, '://') then url[strpos(url, '://') + 3:] else '' end as rest from pages),
        h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            regexp_extract(rest[len(regexp_extract(rest, '^[^/?#]*')) + 1:], '^[^?#]*') as path from s),
        r(rule, rh, rp, v) as (values {rules}),
        m as (select page_id, max_by(rule, len(rule)) as rule, max_by(v, len(rule)) as v from h join r
            on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by page_id)
        select h.page_id, host, path, rule, coalesce(v, case when {listed} then 'block' else 'allow' end) as verdict from h left join m on h.page_id = m.page_id"""


@register("op5_url_filter", _url_sql())
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import urls

    return urls.judge(table(spark, sf_dir, "pages"), list(URL_RULES), list(LISTED_HOSTS)).drop("url")


# ---- 7: packing ----
@register("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tallywatch.llm import packing

    return digest_pieces(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def digest_pieces(pieces: DataFrame) -> DataFrame:
    length = F.expr("cast(octet_length(ids) div 4 as bigint)")
    return pieces.select("doc_id", "start", length.alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# ---- 8: sharding ----
@register("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import sharding

    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


# ---- 9: decontamination ----
CONTAMINATION_SQL = f"""with b as (select item_id, {WORDS} as w from benchmark), d as (select doc_id, {WORDS} as w from documents),
    g as (select item_id, unnest(case when len(w) >= 10 then list_transform(range(len(w) - 9), lambda i: w[i + 1:i + 10]) else [w] end) as g from b where len(w) > 0),
    n as (select distinct g, len(g) as k from g), ks as (select distinct k from n),
    p as (select doc_id, k, unnest(range(len(w) - k + 1)) as i from d, ks where len(w) >= k),
    q as (select p.doc_id, i, k, w[i + 1:i + k] as g from p join d on d.doc_id = p.doc_id),
    o as (select doc_id, i, n.k, q.g from q join n on q.g = n.g),
    c as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + k)) as j from o) group by doc_id),
    m as (select doc_id, count(*) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
        from (select distinct doc_id, item_id from o join g on o.g = g.g) group by doc_id)
    select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
        sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join c on d.doc_id = c.doc_id left join m on d.doc_id = m.doc_id"""


@register("op9_decontamination", CONTAMINATION_SQL)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import contamination

    found = contamination.occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m.item_id.cast("string"))))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h.stop - h.start)
    out = found.select("doc_id", "n_words", n_hit.alias("n_hit"), items.alias("items"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


# ---- 10: exact top-k ----
TOP_SQL = """with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
        where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
    select query_id, cast(rank as int) as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5"""


@register("op10_top_k", TOP_SQL)
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import kdtree

    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), kdtree.integers().alias("v"))
    return kdtree.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


# ---- 6: substring dedup ----
REPEATS_SQL = r"""with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
    p as (select doc_id, i, array_to_string(w[i + 1:i + 13], ' ') as g from (select doc_id, w, unnest(range(len(w) - 12)) as i from d where len(w) >= 13)),
    m as (select g, min(doc_id) as least from p group by g),
    c as (select distinct doc_id, j from (select p.doc_id, unnest(range(i, i + 13)) as j from p join m on p.g = m.g where m.least < p.doc_id)),
    r as (select doc_id, list(j) as gone from c group by doc_id)
    select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
        sha256(case when gone is null then array_to_string(w, ' ')
            else coalesce(array_to_string(list_transform(list_filter(list_zip(w, range(len(w))), lambda z: not list_contains(gone, z[2])), lambda z: z[1]), ' '), '') end) as kept_sha256
    from d left join r on d.doc_id = r.doc_id"""


@register("op6_substring_dedup", REPEATS_SQL)
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import substrings

    return substrings.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# ---- 4: near duplicates ----
@register("op4_near_duplicates")
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import neardup

    out = neardup.classes(table(spark, sf_dir, "documents"))
    return out.withColumn("kept", F.col("doc_id") == F.col("class_id"))


# ---- 3: language identification ----
@register("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import language

    rows = language.page_rows(table(spark, sf_dir, "pages"))
    model = language.fit(table(spark, sf_dir, "documents").select("text", "lang"))
    return language.identify(rows, model, markup=True).withColumnRenamed("id", "page_id")


# ---- 2: html extraction ----
@register("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import wrappers

    return wrappers.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


# ---- checksums in SQL ----
#: DuckDB: crc_at(d, b, v): what byte b adds to the CRC-32 of a string in which d bytes follow; crc_start(d, v): a string of d zero bytes, before
#: the last inversion. The checksum is linear, so that of a string is the exclusive or of its bytes' values.
CRC_TABLES = """crc_bits(n, b, v) as (select 0, b, b from range(256) r(b) union all select n + 1, b, xor(v >> 1, 3988292384 * (v & 1)) from crc_bits where n < 8),
    crc_byte as (select b, v from crc_bits where n = 8),
    crc_at(d, b, v) as (select 0, b, v from crc_byte union all select d + 1, c.b, xor(c.v >> 8, t.v) from crc_at c join crc_byte t on t.b = c.v & 255 where d < 255),
    crc_start(d, v) as (select 0, 4294967295 union all select d + 1, xor(c.v >> 8, t.v) from crc_start c join crc_byte t on t.b = c.v & 255 where d < 256)"""


def crc_of(source: str) -> str:
    """DuckDB: s, h: the unsigned CRC-32 of every string s (of at most 256 UTF-8 bytes, not empty) of the rows of `source`."""
    return f"""(select s, xor(xor(any_value(z.v), bit_xor(t.v)), 4294967295) as h
        from (select s, n, n - 1 - j as d, cast('0x' || substr(x, 2 * j + 1, 2) as bigint) as b from (select s, x, len(x) // 2 as n, unnest(range(len(x) // 2)) as j
            from (select s, hex(encode(s)) as x from (select distinct s from {source})))) q
        join crc_at t on t.d = q.d and t.b = q.b join crc_start z on z.d = q.n group by s)"""


# ---- 11: document fingerprints ----
def _fingerprint_sql() -> str:
    from tallywatch.llm.fingerprints import K, S

    w = K - S + 1
    return f"""with recursive {CRC_TABLES}, d as (select doc_id, coalesce(text, '') as t from documents),
    o as (select doc_id, t, length(t) as n, row_number() over (order by doc_id nulls last, md5(t)) as i, count(*) over () as m from d),
    e as (select a.*, left(a.t, a.n - a.n // 4) || left(b.t, a.n // 4) as et, a.i % a.m + 1 as j from o a join o b on b.i = a.i % a.m + 1),
    c as (select i, 0 as kind, t from e union all select i, 1, et from e),
    b as (select i, kind, b, substr(t, 256 * b + 1, {256 + K - 1}) as t from (select *, unnest(range((length(t) + 255) // 256)) as b from c)),
    g as (select i, kind, 256 * b + x as p, substr(t, x + 1, {S}) as s, substr(t, x + 1, {K}) as k
        from (select *, unnest(range(least(256, length(t) - {S - 1}))) as x from b)),
    v as {crc_of('g')},
    h as (select i, kind, p, k, h, min(h) over q as least, lead(h, {w - 1}) over (partition by i, kind order by p) as edge
        from g join v using (s) window q as (partition by i, kind order by p rows between current row and {w - 1} following)),
    a as (select i, kind, k as s, p - coalesce(lag(p) over (partition by i, kind order by p), 0) as gap, p from h where edge is not null and least in (h, edge)),
    every as (select * from a union all select i, kind, t, 0, 0 from c where t <> '' and (i, kind) not in (select (i, kind) from a)),
    x as {crc_of('every')},
    f as (select i, kind, list(printf('%08X%X', h, gap) order by p) as f from every join x using (s) group by i, kind),
    y as (select e.*, coalesce(own.f, []) as f, coalesce(ed.f, []) as g, coalesce(nx.f, []) as k from e left join f own on own.i = e.i and own.kind = 0
        left join f ed on ed.i = e.i and ed.kind = 1 left join f nx on nx.i = e.j and nx.kind = 0)
    select doc_id, cast(n as bigint) as n_chars, sha256(et) as edited_sha256, array_to_string(f, '') as fingerprint, array_to_string(g, '') as edited_fingerprint,
        case when len(f) + len(g) = 0 then 1.0::double else cast(2 * len(list_intersect(f, g)) as double) / (len(list_distinct(f)) + len(list_distinct(g))) end as near_edited,
        case when len(f) + len(k) = 0 then 1.0::double else cast(2 * len(list_intersect(f, k)) as double) / (len(list_distinct(f)) + len(list_distinct(k))) end as near_next from y"""


@register("op11_fingerprints", _fingerprint_sql())
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import fingerprints

    out = fingerprints.compare_edited(table(spark, sf_dir, "documents"))
    return out.withColumn("edited", F.sha2("edited", 256)).withColumnRenamed("edited", "edited_sha256")


# ---- 12: hard negatives ----
HARD_NEGATIVES_SQL = """with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v,
        row_number() over () as row from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select a.row as a, a.vec_id as anchor_id, c.row, c.vec_id as id, a.label = c.label as same, cast(list_inner_product(a.v, c.v) as bigint) as score
        from v a join v c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
    p as (select *, row_number() over (partition by a order by score desc, id, row) as place from s where same qualify place <= 5),
    n as (select p.a, p.place, p.anchor_id, p.id as positive_id, s.id as negative_id, p.score as positive_score, s.score as negative_score,
        cast(row_number() over (partition by p.a, p.place order by s.score desc, s.id) as int) as rank
        from p join s on s.a = p.a and not s.same and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score qualify rank <= 5)
    select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n"""


@register("op12_hard_negatives", HARD_NEGATIVES_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import kdtree, negatives

    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), kdtree.integers().alias("v"))
    return negatives.hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))


# ---- 13: spelling variants ----
SPELLING_SQL = f"""with recursive {CRC_TABLES},
    r as (select coalesce(cast(doc_id as varchar), '') as d, unnest(regexp_extract_all({LOW}, '[a-zÀ-ÿ]{{7,}}')) as w from documents),
    k as (select w, d || ':' || w as s from r), c as {crc_of('k')},
    e as (select case when h % 31 = 0 then left(w, h % length(w)) || substr(w, h % length(w) + 2) else w end as word from k join c using (s)),
    v as (select word, count(*) as n from e where length(word) >= 7 group by word having count(*) >= 2),
    x as (select distinct word, n, left(word, i - 1) || substr(word, i + 1) as less from (select *, unnest(range(1, length(word) + 1)) as i from v)),
    y as (select word, n, left(word, i - 1) || '_' || substr(word, i + 1) as mask from (select *, unnest(range(1, length(word) + 1)) as i from v)),
    near as (select a.word, b.word as other, b.n as m from y a join y b on a.mask = b.mask and a.word <> b.word
        union all select v.word, x.word, x.n from v join x on v.word = x.less union all select x.word, v.word, v.n from v join x on v.word = x.less),
    g as (select word, count(*) as n_near, max(m) as best from near group by word),
    f as (select v.word, v.n, coalesce(g.n_near, 0) as n_near, case when best >= 10 * v.n then (select min(other) from near where near.word = v.word and m = best) end as form,
        case when best >= 10 * v.n then best end as form_n from v left join g on g.word = v.word),
    way(word, upto, steps) as (select word, word, 0 from f union all select way.word, f.form, steps + 1 from way join f on f.word = way.upto and f.form is not null),
    ends as (select word, max_by(upto, steps) as root from way group by word)
    select f.word, form, root, cast(n as bigint) as n, cast(n_near as bigint) as n_near, cast(form_n as bigint) as form_n from f join ends using (word)"""


@register("op13_spelling_variants", SPELLING_SQL)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallywatch.llm import spelling

    return spelling.variants(spelling.occurrences(table(spark, sf_dir, "documents")))
