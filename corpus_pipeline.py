"""Documents to training sequences: language, near duplicates, repeated passages, benchmark passages, packing."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import contamination, language, neardup, packing, substrings
from tallywatch.llm.queries import digest_pieces
from tallywatch.llm.words import row_key
from tallywatch.session import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined. `lang` is the declared language, `source` the host. Texts without letters, in none
    of the languages, or undecided go; null and empty texts go, too. A document with letters whose label has too few texts for a
    model stays: that it fits none of the others tells nothing. Equal rows share their fate. Empty table: no rows."""
    key = row_key(docs, "doc_id", "text", "lang", "source")
    none = F.lit(None).cast("string")
    rows = docs.select(key.alias("id"), docs["text"], docs["lang"].alias("declared"), none.alias("suffix"), none.alias("domain"), docs["source"].alias("host"))
    model = language.fit(docs.select(docs["text"], docs["lang"]))
    # Few documents go, so their keys are the small side, of known size once they are written.
    judged = language.identify(rows, model).where("rejected").select("id", F.col("text_lang").isNull().alias("bare"))
    gone = settle(judged.groupBy("id").agg(F.max("bare").alias("bare")))
    unmodelled = docs["lang"].isNotNull() & (docs["lang"] != "") & ~docs["lang"].isin(model.languages)
    return docs.join(gone, (key == gone["id"]) & (gone["bare"] | ~F.coalesce(unmodelled, F.lit(False))), "left_anti")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of every class of near duplicates. Of rows with one doc_id and the same words one stays;
    rows with one doc_id and unlike texts are documents of their own. A document without doc_id stays. Null and empty texts are
    classes of their own. Empty table: no rows."""
    rows = settle(neardup.placed(docs).where("doc_id is not null"))
    copies = rows.where("content is not null and (doc_id <> class_id or content <> keeper)").select("doc_id", "text_key")
    # Rows of one doc_id with the same words: those of one text stay, and of these one.
    again = settle(rows.groupBy("doc_id", "content").agg(F.count("*").alias("n"), F.min("text_key").alias("least")).where("n > 1"))
    repeated = rows.join(again, (rows["doc_id"] == again["doc_id"]) & rows["content"].eqNullSafe(again["content"])).select(rows["doc_id"], "text_key", "least")
    repeated = settle(repeated.distinct())
    gone = settle(copies.union(repeated.where("text_key <> least").select("doc_id", "text_key")).distinct())
    # Most texts stay where they are: only rows that a bitmap lets through are joined.
    key = lambda i, t: F.xxhash64(i, t).alias("row key")
    own = docs.select("*", docs["doc_id"].cast("long").alias("row id"), neardup.text_key(docs).alias("row text"))
    own = own.select("*", key("row id", "row text"))
    told = gone.union(repeated.select("doc_id", "text_key")).select(key("doc_id", "text_key"))
    marked = neardup.possible(own, "row key", told)
    names = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    some = marked.where("`key may match`")
    at = lambda other: (some["row id"] == other["doc_id"]) & (some["row text"] == other["text_key"])
    kept = some.join(gone, at(gone), "left_anti")
    if repeated.limit(1).count():
        once = kept.join(repeated, at(repeated), "left_anti")
        kept = once.unionByName(kept.join(repeated, at(repeated), "left_semi").dropDuplicates(["doc_id", "text"]))
    return marked.where("not `key may match`").select(*names).unionByName(kept.select(*names))


def _renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Columns beside doc_id and text under names that no operator gives its own results."""
    names = {c: f"document column {i}" for i, c in enumerate(c for c in docs.columns if c not in ("doc_id", "text"))}
    return docs.select("doc_id", "text", *[docs["`" + c.replace("`", "``") + "`"].alias(n) for c, n in names.items()]), names


def _as_before(out: DataFrame, docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return out.select(*[out[f"`{names.get(c, c)}`"].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages of 13 words that begin in a document with a smaller doc_id, too; the other
    words are joined by one space where something was removed or not. n_chars counts what is left. Null and empty texts: empty, kept. Rows of
    equal doc_id do not shorten each other; null ids count as largest. Empty table: no rows. Further columns, whatever their names, go along."""
    rows, names = _renamed(docs)
    out = substrings.remove_repeats(rows, carry=list(names.values())).withColumnRenamed("kept", "text")
    if "n_chars" in names:
        out = out.withColumn(names["n_chars"], F.length("text"))
    return _as_before(out, docs, names)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten consecutive words of a benchmark item stand (nor a whole shorter item). Null and empty texts stay, repeated
    rows share their fate. Empty table: no rows. Further columns, whatever their names, go along."""
    rows, names = _renamed(docs)
    found = contamination.occurrences(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 10, carry=["text", *names.values()])
    return _as_before(found.where(F.size("hits") == 0), docs, names)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens. A null text is an empty one: the closing token alone. Repeated rows and
    rows without doc_id are packed each. Empty table: no rows. Further columns are not looked at."""
    import public_tokenizers

    return digest_pieces(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("language", by_language),
    ("near_duplicates", without_copies),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Language models, sampling and tokens can't be expressed in SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
