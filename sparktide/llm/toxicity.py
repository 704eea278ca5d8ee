"""Toxic passages as maximum-scoring segments of token log-odds.

A term is a word in lower case or the start of one; a labelled document counts a term
once. Its log-odds between toxic and other documents have an informative Dirichlet
prior, the term's share of all documents. How certain a term is, is the signed root
of its likelihood ratio between the classes; terms below a threshold of it don't
enter the model. A word scores as its most certain term, less a drift, so that
ordinary text sinks.

In one pass over the words of a text every maximal segment is found that scores above
all of its parts (Ruzzo and Tompa). The significance of a segment comes from the
extreme-value law of the best segment of text without toxic passages, fitted on the
labelled documents of that class: P(S >= x) = 1 - exp(-K n exp(-lambda x)). A
document's significant segments add up, and a logistic curve, fitted on the labelled
documents, turns the sum into a probability.

The model is fitted on at most ``max_rows`` labelled rows, those with the smallest hash of
their id, and holds at most ``max_terms`` terms, the most certain ones. Neither bound
depends on the data, so the sample's ids and the model may go to every task, and the
documents are not shuffled to find their labels. Every text is scored whole.

Defined results: null texts are empty, texts without words have no passages and get
the score of a document in which nothing was found. Documents with two labels count
once per label row; null labels teach nothing. An empty table gives an empty result,
and without both classes among the labels every term scores zero.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktide.llm.common import map_batches, ordered, text_of
from sparktide.workspace import materialise

_WORD = re.compile(r"[^\W\d_]+")
#: Characters of a text whose words are looked at together.
CHUNK = 262_144
STARTS = (4, 5, 6, 7, 8)
PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


@dataclass(frozen=True)
class Settings:
    prior: float = 50.0
    least_certain: float = 4.5
    max_terms: int = 65_536
    max_rows: int = 20_000
    drift: float = 0.03
    significant: float = 0.05


@dataclass
class Model:
    terms: dict[str, tuple[float, float]]  # certainty and log-odds
    drift: float
    rate: float = 1.0
    scale: float = 0.05
    significant: float = 0.05
    intercept: float = -2.0
    slope: float = 1.0
    _words: dict[str, float] = field(default_factory=dict, repr=False)

    def word(self, word: str) -> float:
        """The log-odds of a word's most certain term."""
        found = self._words.get(word)
        if found is None:
            known = [(abs(self.terms[t][0]), t) for t in terms(word) if t in self.terms]
            found = self.terms[max(known)[1]][1] if known else 0.0
            if len(self._words) >= 300_000:
                self._words.clear()
            self._words[word] = found
        return found

    def expected(self, score: float, n_words: int) -> float:
        """Segments of this score or more to expect in that many words by chance."""
        return self.scale * max(1, n_words) * math.exp(-self.rate * score)

    def segments(self, text: str) -> list[tuple[int, int, float, float]]:
        """Maximal segments that are unexpected at all: start and end in code points, score, expected number."""
        found, n = maximal_segments(self._scored(text))
        rated = [(a, b, s, self.expected(s, n)) for a, b, s in found]
        return sorted(p for p in rated if p[3] < 1)

    def _scored(self, text: str) -> Iterator[tuple[int, int, float]]:
        lower = text.lower()
        plain = lower if len(lower) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        get, drift = self._words.get, self.drift
        for m in _WORD.finditer(plain):
            word = m.group()
            score = get(word)
            yield m.start(), m.end(), (self.word(word) if score is None else score) - drift

    def evidence(self, segments: list[tuple[int, int, float, float]]) -> float:
        """What a document's segments say together: the sum of -log of their expected numbers."""
        return sum(-math.log(max(p[3], 1e-300)) for p in segments)

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.intercept + self.slope * math.log1p(evidence)))))


def terms(word: str) -> list[str]:
    """A word and its starts; a start is marked, so that it isn't taken for a word."""
    return [word, *(word[:n] + "*" for n in STARTS if len(word) > n)]


def maximal_segments(words) -> tuple[list[tuple[int, int, float]], int]:
    """All maximal scoring segments of (start, end, score) in linear time, and the number of words.

    Candidates keep the sum left of them and up to their end. A new one joins back to
    the last candidate with a smaller left sum as long as that one ends lower.
    """
    held: list[list] = []  # start, end, left sum, right sum, index of the last with a smaller left sum
    total, n = 0.0, 0
    for start, end, score in words:
        n += 1
        before, total = total, total + score
        if score <= 0:
            continue
        new = [start, end, before, total, -1]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= new[2]:
                j = held[j][4]
            if j < 0 or held[j][3] >= new[3]:
                new[4] = j
                held.append(new)
                break
            new = [held[j][0], new[1], held[j][2], new[3], -1]
            del held[j:]
    return [(a, b, right - left) for a, b, left, right, _ in held], n


def _document_terms(labelled: DataFrame) -> DataFrame:
    """(toxic, term) once per labelled document."""
    schema = T.StructType([T.StructField("toxic", T.IntegerType()), T.StructField("terms", T.ArrayType(T.StringType()))])

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            made = []
            for text in batch.column("text"):
                found: set[str] = set()
                for word in set(_WORD.findall(text.as_py().lower())):
                    found.update(terms(word))
                made.append(sorted(found))
            return {"toxic": batch.column("toxic"), "terms": made}

        return step

    return map_batches(labelled, make, schema).select("toxic", F.explode("terms").alias("term"))


def _term_log_odds(labelled: DataFrame, settings: Settings) -> dict[str, tuple[float, float]]:
    """Certainty and log-odds of the certain terms, at most ``max_terms``."""
    sizes = labelled.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    n1, n0 = (float(x or 0) for x in sizes)
    if not n1 or not n0:
        return {}
    counts = _document_terms(labelled).groupBy("term").agg(
        F.count_if(F.col("toxic") == 1).cast("double").alias("c1"), F.count_if(F.col("toxic") == 0).cast("double").alias("c0")
    )
    share = (F.col("c1") + F.col("c0")) / F.lit(n1 + n0)
    a = F.lit(settings.prior) * share
    y1, y0 = F.col("c1") + a, F.col("c0") + a
    m1, m0 = n1 + settings.prior, n0 + settings.prior
    # A term in every document of a class would divide by zero.
    delta = F.log(y1 / F.greatest(F.lit(m1) - y1, F.lit(0.5))) - F.log(y0 / F.greatest(F.lit(m0) - y0, F.lit(0.5)))

    def part(seen: F.Column, expected: F.Column) -> F.Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (
        part(F.col("c1"), share * n1)
        + part(F.col("c0"), share * n0)
        + part(n1 - F.col("c1"), (1 - share) * n1)
        + part(n0 - F.col("c0"), (1 - share) * n0)
    )
    certain = F.signum(F.col("c1") * n0 - F.col("c0") * n1) * F.sqrt(F.greatest(ratio, F.lit(0.0)))
    scored = counts.select("term", delta.alias("delta"), F.round(certain, 6).alias("certain"))
    sure = scored.where(F.abs("certain") >= settings.least_certain)
    sure = sure.orderBy(F.abs("certain").desc(), "term").limit(settings.max_terms)
    return {r.term: (r.certain, r.delta) for r in sure.collect()}


def _best_segments(df: DataFrame, model: Model, extra: list[str]) -> DataFrame:
    """``extra`` columns, the best segment's score and the number of words, per text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(
        [*(df.schema[c] for c in extra), T.StructField("best", T.DoubleType()), T.StructField("n", T.LongType())]
    )

    def make():
        m = shared.value

        def step(batch: pa.RecordBatch) -> dict:
            made = [maximal_segments(m._scored(x.as_py())) for x in batch.column("text")]
            best = [max((s for _, _, s in found), default=0.0) for found, _ in made]
            return {"best": best, "n": [n for _, n in made]} | {c: batch.column(c) for c in extra}

        return step

    return map_batches(df.select(*extra, "text"), make, schema)


def _fit_law(model: Model, labelled: DataFrame) -> None:
    """Rate and scale of the extreme-value law, from the best segments of the other class.

    The best segment of n words minus log(n) / rate follows a Gumbel law: its
    variance gives the rate, its mean the scale. Single words that happen to score
    are the chance; the rate is kept in a range in which segments can matter.
    """
    other = _best_segments(labelled.where("toxic = 0"), model, []).where("n > 0 and best > 0")
    row = other.agg(F.avg("best").alias("m"), F.var_samp("best").alias("v"), F.avg(F.log("n")).alias("ln"), F.count("*").alias("n")).first()
    if row.n < 30 or not row.v:
        return
    model.rate = min(1.0, max(0.3, math.pi / math.sqrt(6 * row.v)))
    model.scale = min(1.0, max(1e-4, math.exp(model.rate * row.m - 0.5772156649 - row.ln)))


def _fit_curve(model: Model, labelled: DataFrame) -> None:
    """Logistic curve over log(1 + evidence), by Newton steps on a histogram of bounded size."""
    scored = find(labelled, model, "text", ["toxic"])
    bins = F.least(F.floor(F.log1p("evidence") * 20), F.lit(400)).alias("bin")
    seen = scored.groupBy(bins, "toxic").agg(F.count("*").alias("n")).collect()
    points = [(r.bin / 20, r.toxic, r.n) for r in seen]
    if len({y for _, y, _ in points}) < 2:
        return
    # Half a document of each class at both ends keeps separable classes finite.
    top = max(x for x, _, _ in points)
    points += [(0.0, 1, 0.5), (0.0, 0, 0.5), (top, 1, 0.5), (top, 0, 0.5)]
    a, b = 0.0, 0.0
    for _ in range(50):
        g0 = g1 = h00 = h01 = h11 = 0.0
        for x, y, n in points:
            p = 1 / (1 + math.exp(-max(-50.0, min(50.0, a + b * x))))
            w = n * p * (1 - p) + 1e-9
            g0, g1 = g0 + n * (y - p), g1 + n * (y - p) * x
            h00, h01, h11 = h00 + w, h01 + w * x, h11 + w * x * x
        det = h00 * h11 - h01 * h01
        if det <= 1e-12:
            return
        da, db = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        step = min(1.0, 4 / max(abs(da), abs(db), 1e-9))
        a, b = a + step * da, b + step * db
        if abs(da) + abs(db) < 1e-9:
            break
    if b > 0:
        model.intercept, model.slope = a, b


def train(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from rows (text, toxic 0 or 1)."""
    rows = labelled.select(text_of("text").alias("text"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    rows = materialise(rows, "labelled")
    model = Model(_term_log_odds(rows, settings), settings.drift, significant=settings.significant)
    _fit_law(model, rows)
    _fit_curve(model, rows)
    return model


def find(df: DataFrame, model: Model, text_col: str = "text", kept: list[str] | None = None) -> DataFrame:
    """The ``kept`` columns with ``passages``, ``evidence`` and ``score`` of every whole text."""
    kept = kept or []
    shared = df.sparkSession.sparkContext.broadcast(model)
    kinds = T._parse_datatype_string(f"passages {PASSAGES}, evidence double, score double")
    schema = T.StructType([*(df.schema[c] for c in kept), *kinds])

    def make():
        m = shared.value

        def step(batch: pa.RecordBatch) -> dict:
            segments = [m.segments(x.as_py()) for x in batch.column("_text")]
            evidence = [m.evidence(p) for p in segments]
            passages = [[p for p in ps if p[3] <= m.significant] for ps in segments]
            names = ("start", "end", "score", "expected")
            return {c: batch.column(c) for c in kept} | {
                "passages": [[dict(zip(names, p, strict=True)) for p in ps] for ps in passages],
                "evidence": evidence,
                "score": [m.probability(e) for e in evidence],
            }

        return step

    return map_batches(df.select(*kept, text_of(text_col).alias("_text")), make, schema)


def learnable(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(text, toxic) of the bounded sample of labelled rows that a model learns from."""
    teach = labels.where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    sample = teach.select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(settings.max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")


def held_out(id_col: str) -> F.Column:
    """Rows that are kept for judging: CRC-32 of the id's digits leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted and n_passages of every document."""
    model = train(learnable(docs, labels))
    rows = docs.select(ordered(F.col("doc_id").cast("long")).alias("key"), "text")
    found = find(rows, model, kept=["key"])
    doc_id = F.when(F.col("key") != -(2**63), F.col("key"))
    return found.select(
        doc_id.alias("doc_id"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), F.size("passages").alias("n_passages")
    ).withColumn("held_out", held_out("doc_id"))
