"""Language identification by Bayesian fusion of text, declared language, address suffix and host priors."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.words import raw_text, ready
from tallywatch.session import settle

#: Labelled texts per language that the model of character trigrams is fitted on, at most.
SAMPLE_TEXTS = 400
#: A label with fewer distinct texts gets no model.
LEAST_TEXTS = 3
BUCKETS = 1 << 16
UNKNOWN = "und"
#: A text's trigrams are far from independent, so their log likelihoods count for this part.
TEMPER = 0.1
#: Strength of the parent in a smoothed prior, in documents.
STRENGTH = 20.0
#: Below this posterior, or if the text is likelier under no language at all, the language is undetermined.
CERTAIN = 0.5
#: log probability of each trigram under `no language`: characters drawn evenly from about 100.
NO_LANGUAGE = -3 * float(np.log(100))
CUT = 1 << 20


class Model:
    """Naive Bayes over hashed character trigrams (bytes, A-Z folded, digits and white space merged)."""

    FOLD = np.arange(256, dtype=np.uint32)

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=1)
        self.log = np.empty((BUCKETS, len(languages)), np.float32)
        for k, row in enumerate(counts):
            self.log[:, k] = np.log((row + 0.05) / (total[k] + 0.05 * BUCKETS))

    @classmethod
    def trigrams(cls, data: np.ndarray) -> np.ndarray:
        b = _fold()[data]
        if len(b) < 3:
            b = np.concatenate((b, np.full(3 - len(b), 32, np.uint32)))
        return (((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)

    def score(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log likelihoods per text and language, and the number of trigrams that hold a letter."""
        out, n = np.zeros((len(at) - 1, len(self.languages))), np.zeros(len(at) - 1, np.int64)
        letter = _letters()[data]
        for d in range(len(at) - 1):
            # Pieces overlap by two bytes, so every trigram of the whole text counts once.
            for low in range(at[d], at[d + 1], CUT):
                high = min(at[d + 1], low + CUT + 2)
                if high - low < 3 and low > at[d]:
                    break
                inside = letter[low:high]
                if high - low >= 3:
                    inside = inside[:-2] | inside[1:-1] | inside[2:]
                gram = self.trigrams(data[low:high])[:max(1, len(inside))]
                gram = gram[inside[:len(gram)]]
                out[d] += self.log[gram].sum(axis=0, dtype=np.float64)
                n[d] += len(gram)
        return out, n


def _fold() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    out[65:91] += 32
    out[48:58] = 48
    out[9:14] = 32
    return out


def _letters() -> np.ndarray:
    out = np.zeros(256, bool)
    out[65:91] = out[97:123] = out[128:] = True
    return out


def fit(labelled: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> Model:
    """`labelled`: text, lang. The model is fitted on at most `sample_texts` texts of each language, those of least hash (a bound
    of the sample, not of what is judged). Every label with LEAST_TEXTS distinct texts is a language, however small its share and however many
    there are. A label with fewer has no model: its documents are judged by the models of the others."""
    from pyspark.sql import Window as W

    ready(labelled.sparkSession)
    labelled = labelled.where("lang is not null and lang <> '' and text is not null")
    # Copies count once: chances are taken over distinct texts, so that a language of mostly copies has its whole sample, too.
    labelled = labelled.withColumn("h", F.xxhash64("text"))
    distinct = labelled.select("lang", "h").distinct()
    n = settle(distinct.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_TEXTS))
    # A text is considered with a chance that leaves about four times the sample (all texts where there are fewer), then ranked
    # per language; that fewer than the sample are left has a probability below e^-400.
    u = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = labelled.join(n, "lang").where(u * F.col("n") < 4 * sample_texts).dropDuplicates(["lang", "h"])
    few = few.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(u, "h"))).where(F.col("r") <= sample_texts)

    def count(table: pa.Table) -> pa.Table:
        total = np.zeros(BUCKETS, np.int64)
        for text in table["text"]:
            data = np.frombuffer(text.as_py().encode(), np.uint8)
            total += np.bincount(Model.trigrams(data), minlength=BUCKETS)
        seen = np.flatnonzero(total)
        return pa.table([pa.array([table["lang"][0].as_py()]), pa.array([seen.astype(np.uint16).tobytes()]), pa.array([total[seen].tobytes()])], ["lang", "grams", "counts"])

    # The trigrams seen in each language's sample: at most BUCKETS, whatever the input.
    rows = few.select("lang", "text").groupBy("lang").applyInArrow(count, "lang string, grams binary, counts binary").orderBy("lang").collect()
    counts = np.zeros((len(rows), BUCKETS), np.int64)
    for own, r in zip(counts, rows):
        own[np.frombuffer(bytes(r["grams"]), np.uint16)] = np.frombuffer(bytes(r["counts"]), np.int64)
    return Model([r["lang"] for r in rows], counts)


def likelihoods(rows: DataFrame, model: Model, markup: bool) -> DataFrame:
    """Adds `loglik` (array by language, then `no language`) and `grams`. markup: `text` is HTML; tags, scripts and styles don't count."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            column = batch.column("text")
            if markup:
                column = pa.array([visible(t) for t in column.to_pylist()], pa.string())
            data, at = raw_text(column)
            score, n = m.score(data, at)
            both = np.concatenate((score, (n * NO_LANGUAGE)[:, None]), axis=1)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * both.shape[1], pa.int32()), pa.array(both.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), flat, pa.array(n)], [*keep, "loglik", "grams"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, f"{kept}, loglik array<double>, grams long")


def visible(html: str | None) -> str:
    import html as entities
    import re

    text = re.sub(r"(?is)<(script|style)\b.*?(</\1\s*>|\Z)|<!--.*?(-->|\Z)|<[^>]*(>|\Z)", " ", html or "")
    return entities.unescape(text)


def _log_softmax(x: str) -> Column:
    top = F.array_max(x)
    norm = F.log(F.aggregate(x, F.lit(0.0), lambda a, v: a + F.exp(v - F.array_max(x)))) + top
    return F.transform(x, lambda v: v - norm)


def _total(column: str, k: int) -> Column:
    return F.array(*[F.sum(F.col(column)[i]) for i in range(k)])


def _smoothed(counts: Column, parent: Column) -> Column:
    """(counts + STRENGTH * parent) / (sum of counts + STRENGTH)."""
    size = F.aggregate(counts, F.lit(0.0), lambda a, v: a + v) + F.lit(STRENGTH)
    return F.zip_with(counts, parent, lambda c, p: (c + STRENGTH * p) / size)


def identify(rows: DataFrame, model: Model, markup: bool = False) -> DataFrame:
    """Adds lang (`und` if undetermined), posterior, text_lang and rejected to rows (id, text, declared, suffix, domain, host).

    Method: posterior of a language is proportional to likelihood of the text (character trigrams, tempered) x P(declared
    language | language) x P(address suffix | language) x prior of the host. The text alone first gives every document soft
    language counts; grouped aggregation sums them by declared value, suffix, host, domain and overall. The host's prior is
    smoothed by its domain's, that by the overall one, each with STRENGTH documents. Hosts, domains and values are joined as
    small sums, pre-aggregated before they are shuffled; texts are read once and never shuffled.

    A row is rejected if its text has no letters, if it is likelier under no language than under any, or if no language
    reaches CERTAIN. Null or empty text: rejected, lang `und`. Null or unseen declared value, suffix or host: carries no weight of
    its own. Repeated rows: each is judged and counts. Empty table or no labelled rows: no rows, or all undetermined.
    """
    ready(rows.sparkSession)
    k = len(model.languages)
    slim = settle(likelihoods(rows.select("id", "text", "declared", "suffix", "domain", "host"), model, markup))
    if not k:
        blank = F.lit(None).cast("string")
        return slim.select("id", F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("posterior"), blank.alias("text_lang"), F.lit(True).alias("rejected"))
    likely = F.transform(F.slice("loglik", 1, k), lambda v: v * TEMPER)
    doc = slim.withColumn("text_log", likely).withColumn("text_log", _log_softmax("text_log"))
    soft = doc.withColumn("p", F.when(F.col("grams") > 0, F.transform("text_log", lambda v: F.exp(v))))
    seen = soft.where("p is not null")
    even = F.array(*[F.lit(1.0 / k)] * k)
    host = seen.where("host is not null").groupBy("host", "domain").agg(_total("p", k).alias("host_n"))
    domain = seen.where("domain is not null").groupBy("domain").agg(_total("p", k).alias("domain_n"))
    whole = F.transform(_total("p", k), lambda v: F.coalesce(v, F.lit(0.0)))
    overall = seen.agg(whole.alias("all_n")).select(_smoothed(F.col("all_n"), even).alias("all_p")).first()["all_p"]
    prior = F.array(*[F.lit(float(x)) for x in overall])
    domain = domain.select("domain", _smoothed(F.col("domain_n"), prior).alias("domain_p"))
    host = host.join(domain, "domain", "left").select("host", _smoothed(F.col("host_n"), F.coalesce("domain_p", prior)).alias("host_p"))
    host = host.dropDuplicates(["host"])

    def evidence(name: str) -> DataFrame:
        """log P(value | language), smoothed towards the value's share of all documents."""
        sums = seen.where(F.col(name).isNotNull()).groupBy(name).agg(_total("p", k).alias("n"))
        whole = sums.agg(_total("n", k).alias("n")).first()["n"] or [0.0] * k
        size = [float(x or 0) for x in whole]
        share = F.aggregate("n", F.lit(0.0), lambda a, v: a + v) / F.lit(max(1e-9, sum(size)))
        return sums.select(name, F.array(*[F.log((F.col("n")[i] + STRENGTH * share) / F.lit(size[i] + STRENGTH)) for i in range(k)]).alias(f"{name}_log"))

    zero = F.array(*[F.lit(0.0)] * k)
    fused = soft.join(host, "host", "left").join(evidence("declared"), "declared", "left").join(evidence("suffix"), "suffix", "left")
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    total = add(add(F.col("text_log"), F.transform(F.coalesce("host_p", prior), lambda v: F.log(v))), add(F.coalesce("declared_log", zero), F.coalesce("suffix_log", zero)))
    names = F.array(*[F.lit(x) for x in model.languages])
    fused = fused.withColumn("total", total).withColumn("total", _log_softmax("total"))
    best = F.array_max("total")
    fused = fused.select("id", "grams", "loglik", F.get(names, (F.array_position("total", best) - 1).cast("int")).alias("best"), F.exp(best).alias("posterior"),
                         F.get(names, (F.array_position("text_log", F.array_max("text_log")) - 1).cast("int")).alias("text_lang"))
    rejected = (F.col("grams") == 0) | (F.array_max(F.slice("loglik", 1, k)) < F.element_at("loglik", -1)) | (F.col("posterior") < CERTAIN)
    return fused.select("id", F.when(rejected, UNKNOWN).otherwise(F.col("best")).alias("lang"), "posterior", F.when(F.col("grams") > 0, F.col("text_lang")).alias("text_lang"), rejected.alias("rejected"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages as rows for `identify`: declared is <html lang>, suffix the last label of the host, domain its last two labels."""
    host = F.lower(F.nullif(F.regexp_extract("url", r"^[^/?#]*?://([^/?#]*)", 1), F.lit("")))
    labels = F.split(F.regexp_replace("host", ":.*$", ""), r"\.")
    declared = F.lower(F.nullif(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1), F.lit("")))
    out = pages.select(F.col("page_id").cast("long").alias("id"), F.col("html").alias("text"), declared.alias("declared"), host.alias("host"))
    return out.withColumns({"suffix": F.element_at(labels, -1), "domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))}).withColumn(
        "domain", F.when(F.col("host").isNotNull(), F.col("domain")))
