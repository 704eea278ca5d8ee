"""Language identification by fusing evidence with Bayes' rule.

The text's likelihood under each language comes from hashed byte trigrams of its
letters, counted over all documents that name a supported language. A further class
for text of no supported language gives every trigram the same chance. Whatever the
markup declares, the suffix of the address and the host are evidence too: how often
a language goes with a declared one, with a suffix and with a host is counted over
all rows by what their text alone says. A host's prior is smoothed towards its
suffix's, and that towards the prior of all rows; a row's own vote is taken out of
its host's counts before they speak for it.

A row is accepted if a supported language has the highest posterior and at least
``least`` of it, and the text has letters at all.

Models have a fixed size (languages times buckets). Counts per host, suffix and
declared language are grouped aggregates with partial sums, so a host with a third
of all rows is no hot key before the join, and the joins are split by Spark.

Defined results: null texts are empty; a text without letters is not accepted and
its language is null. Missing declarations, hosts and suffixes are a value like any
other. Rows are judged one by one, so repeated rows have equal results. An empty
table gives an empty result; without any training text all languages are alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktide.llm.common import brought_back, map_batches, ordered, set_aside, text_of
from sparktide.workspace import materialise

BUCKETS = 16_384
CHUNK = 262_144
#: What a trigram that a language was never seen with counts.
UNSEEN = 0.1
_OTHER = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Settings:
    languages: tuple[str, ...] = ("de", "en", "es", "fr")
    #: Trigrams overlap, so their likelihood counts for this part.
    weight: float = 1 / 3
    #: Rows a parent's share is worth in a child's prior.
    smoothing: float = 10.0
    #: How sure a declaration is taken to be before anything is counted, and what that is worth in rows.
    trust: float = 0.9
    trust_rows: float = 20.0
    unknown_prior: float = 0.01
    least: float = 0.5


def trigrams(text: str):
    """Arrays of trigram buckets of the text's letters, chunk by chunk."""
    for at in range(0, len(text), CHUNK):
        plain = _OTHER.sub(" ", text[at : at + CHUNK].lower()).strip()
        if plain:
            b = np.frombuffer(f" {plain} ".encode(), np.uint8).astype(np.uint32)
            grams = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
            yield ((grams * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int32)


def train(df: DataFrame, settings: Settings = Settings(), text_col: str = "text", lang_col: str = "lang") -> np.ndarray:
    """Log-probabilities (languages and one more, buckets) from rows that name their language."""
    known = list(settings.languages)
    rows = df.select(F.array_position(F.array(*map(F.lit, known)), F.col(lang_col)).alias("lang"), text_of(text_col).alias("text"))
    rows = rows.where("lang > 0").select((F.col("lang") - 1).cast("int").alias("lang"), "text")
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in ("lang", "bucket")] + [T.StructField("n", T.LongType())])

    def run(batches):
        counts = np.zeros((len(known), BUCKETS), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                for grams in trigrams(text.as_py()):
                    counts[lang] += np.bincount(grams, minlength=BUCKETS)
        lang, bucket = np.nonzero(counts)
        made = [pa.array(x, t) for x, t in ((lang, pa.int32()), (bucket, pa.int32()), (counts[lang, bucket], pa.int64()))]
        yield pa.RecordBatch.from_arrays(made, names=["lang", "bucket", "n"])

    sums = rows.mapInArrow(run, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.full((len(known) + 1, BUCKETS), UNSEEN)
    for r in sums.collect():  # languages times buckets at most
        counts[r.lang, r.bucket] += r.n
    counts[-1] = 1
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def _scored(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """``rows`` (text and more) with the text's log-likelihoods in place of the text."""
    kept = [c for c in rows.columns if c != "text"]
    shared = rows.sparkSession.sparkContext.broadcast(model.T.copy())
    schema = T.StructType(
        [*(rows.schema[c] for c in kept), T.StructField("fits", T.ArrayType(T.DoubleType())), T.StructField("grams", T.LongType())]
    )

    def make():
        table = shared.value

        def step(batch: pa.RecordBatch) -> dict:
            fits, n = [], []
            for text in batch.column("text"):
                total, seen = np.zeros(table.shape[1]), 0
                for grams in trigrams(text.as_py()):
                    total += np.bincount(grams, minlength=BUCKETS) @ table if len(grams) > 2 * BUCKETS else table[grams].sum(axis=0)
                    seen += len(grams)
                fits.append(total.tolist())
                n.append(seen)
            return {c: batch.column(c) for c in kept} | {"fits": fits, "grams": n}

        return step

    return map_batches(rows, make, schema)


def _top(values: list[Column], names: list[str]) -> Column:
    """The name of the largest value, the first of equal ones."""
    most = F.greatest(*values)
    return F.coalesce(*[F.when(v == most, F.lit(n)) for v, n in zip(values, names, strict=True)])


def fuse(rows: DataFrame, model: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """``rows`` (key, declared, suffix, host, text, ...) judged, without the text.

    Adds ``language``, ``confidence``, ``accepted`` and ``text_language``, what the
    text alone says.
    """
    known = list(settings.languages)
    names = [*known, "und"]
    m, n_known = settings.smoothing, len(known)
    given = [F.coalesce(F.lower(F.col(c)), F.lit("")).alias(f"_{c}") for c in ("declared", "suffix", "host")]
    plain = rows.select("*", *given)
    fits = [F.col("fits")[i] * settings.weight for i in range(len(names))]
    scored = materialise(_scored(plain, model).withColumn("_vote", F.when(F.col("grams") > 0, _top(fits, names))), "language_fits")

    def votes(*by: str) -> DataFrame:
        counts = F.array(*[F.count_if(F.col("_vote") == n) for n in known])
        return materialise(scored.groupBy(*by).agg(counts.alias(f"_by{len(by)}" if "_declared" not in by else "_said")), "votes")

    hosts, suffixes, declared = votes("_suffix", "_host"), votes("_suffix"), votes("_declared")
    every = scored.agg(*[F.count_if(F.col("_vote") == n) for n in known]).first()
    total = sum(every)
    base = [(every[i] + 1.0) / (total + n_known) for i in range(n_known)]
    joined = scored.join(hosts, ["_suffix", "_host"]).join(suffixes, "_suffix").join(declared, "_declared")

    def summed(column: str) -> Column:
        return reduce(lambda a, b: a + b, [F.col(column)[i] for i in range(n_known)])

    posts = []
    for i, name in enumerate(known):
        own = F.when(F.col("_vote") == name, 1).otherwise(0)
        voted = F.when(F.col("_vote").isin(known), 1).otherwise(0)
        by_suffix = (F.col("_by1")[i] + m * base[i]) / (summed("_by1") + m)
        by_host = (F.col("_by2")[i] - own + m * by_suffix) / (summed("_by2") - voted + m)
        # A declaration of this language, of another supported one, or of neither.
        first = F.when(F.col("_declared") == name, settings.trust).otherwise((1 - settings.trust) / n_known)
        said = (F.col("_said")[i] - own + settings.trust_rows * first) / (every[i] - own + settings.trust_rows)
        posts.append(fits[i] + F.log(by_host) + F.log(said) + float(np.log(1 - settings.unknown_prior)))
    posts.append(fits[-1] + float(np.log(settings.unknown_prior)) + float(np.log(1 / (n_known + 1))))
    # Step by step, so that no expression repeats another.
    post = [f"_post{i}" for i in range(len(names))]
    staged = joined.withColumns(dict(zip(post, posts, strict=True))).withColumn("_most", F.greatest(*post))
    staged = staged.withColumns(
        {
            "_weight": reduce(lambda a, b: a + b, [F.exp(F.col(p) - F.col("_most")) for p in post]),
            "_best": F.coalesce(*[F.when(F.col(p) == F.col("_most"), F.lit(n)) for p, n in zip(post, names, strict=True)]),
        }
    )
    judged = staged.select(
        *[c for c in rows.columns if c != "text"],
        F.when(F.col("grams") > 0, F.col("_best")).alias("language"),
        F.when(F.col("grams") > 0, 1 / F.col("_weight")).otherwise(0.0).alias("confidence"),
        F.col("_vote").alias("text_language"),
    )
    good = (F.col("language") != "und") & (F.col("confidence") >= settings.least)
    return judged.withColumn("accepted", F.coalesce(good, F.lit(False)))


def suffix_of(host: Column) -> Column:
    """The last label of a host name, null where there is only one."""
    return F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1))


def page_rows(pages: DataFrame) -> DataFrame:
    """key, declared, suffix, host and text of raw pages."""
    html = text_of("html")
    text = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*+>.*?</\1\s*+>", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"<[^>]*+>", " "), r"&[A-Za-z0-9#]{1,10};", " ")
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*+://(?:[^/@]*+@)?([^/:?#]++)", 1)
    return pages.select(
        F.col("page_id").cast("long").alias("key"),
        F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]++)", 1).alias("declared"),
        suffix_of(host).alias("suffix"),
        host.alias("host"),
        text.alias("text"),
    )


def document_rows(docs: DataFrame) -> DataFrame:
    """key, declared, suffix, host and text of documents: the source is the host."""
    return docs.select(
        ordered(F.col("doc_id").cast("long")).alias("key"),
        F.col("lang").alias("declared"),
        suffix_of(F.col("source")).alias("suffix"),
        F.col("source").alias("host"),
        text_of("text").alias("text"),
    )


def keep_identified(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents whose language is accepted, with all their columns, whatever their names.

    Rows with equal id and text are one document: they stay if one of them is accepted.
    A null id is an id like others. An empty table gives an empty one.
    """
    rows = document_rows(docs).withColumn("digest", F.xxhash64("text"))
    judged = fuse(rows, train(docs, settings), settings)
    fates = judged.groupBy("key", "digest").agg(F.bool_or("accepted").alias("accepted"))
    rejected = materialise(fates.where(~F.col("accepted")).select("key", "digest"), "rejected")
    plain, names = set_aside(docs)
    key, digest = ordered(F.col(names["doc_id"]).cast("long")), F.xxhash64(text_of(F.col(names["text"])))
    marked = plain.withColumns({"key": key, "digest": digest})
    return marked.join(rejected, ["key", "digest"], "left_anti").select(*brought_back(names))
