"""Personal data by proposed spans, checksums and context, in native expressions only.

Regular expressions propose spans: e-mail addresses, dotted IP addresses, card and
phone numbers, and international bank account numbers (``iban``). Validators
confirm them: parts of an address at most 255, 16 to 19 digits that pass Luhn, 8 to
15 digits, mod-97 over the rearranged account number. What fails is dropped
without another try. A confirmed span starts with its kind's score and gains or
loses by words next to it.

Matches and gaps of one pattern interleave, so positions are running sums of their
lengths; the sums are taken in blocks, so that a text with very many matches costs
little more than its length. The patterns don't backtrack: where the plain form
would, a possessive one with a guarded start finds the same matches.

Positions count code points, the end is exclusive. A null text is empty and has no
spans; other columns of the input stay, except ``spans``, which is replaced. Rows
are independent of each other, so ties and repeated rows need no rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktide.llm.common import brought_back, set_aside, text_of

#: Matches whose lengths are summed one by one; sums of whole blocks come first.
BLOCK = 256
#: Code points on each side of a span in which words count as its context.
NEAR = 40
LOWER, RAISED = 0.2, 0.3


@dataclass(frozen=True)
class Kind:
    """A kind of span. ``needs`` is what any text with a match holds, as a cheap first test."""

    name: str
    pattern: str
    needs: str
    score: float
    words: str


# Words that speak for a kind, and words that speak against any.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        0.6,
        "mail|contact|kontakt|correo|courriel|write to",
    ),
    Kind(
        "ip",
        r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
        0.5,
        "ip|address|adresse|host|server|login",
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){15}", 0.6, "card|karte|carte|tarjeta|visa|credit|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.5, "phone|tel|call|mobile|fax|anruf|appel|llam"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
        0.7,
        "iban|bank|konto|compte|cuenta|account",
    ),
)
AGAINST = "example|sample|test|dummy|version|beispiel|exemple|ejemplo"
ADDRESS = r"^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])){3}$"


def _mod97(account: Column) -> Column:
    """The remainder of an account number, its first four characters moved to the end."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    moved = F.split(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4))), "")

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        letter = code >= 65
        return F.when(letter, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(moved, F.lit(0), step)


def _confirmed(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(ADDRESS)
    if kind == "card":
        digits = F.regexp_replace(found, r"[\x20-]", "")
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.regexp_replace(found, "[^0-9]", "")).between(8, 15)
    if kind == "iban":
        length = F.length(F.replace(found, F.lit(" "), F.lit("")))
        return length.between(15, 34) & (_mod97(found) == 1)
    return F.lit(True)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _starts(gaps: Column, matches: Column) -> Column:
    """Where each match starts, from the lengths of gaps and matches."""
    steps = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: g + m)
    n = F.size(matches)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda b: _sum(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))))
    fronts = F.aggregate(
        blocks, F.array(F.lit(0)), lambda made, b: F.concat(made, F.array(F.element_at(made, -1) + b))
    )

    def start(gap: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        return F.get(fronts, block) + _sum(F.slice(steps, block * BLOCK + 1, i % BLOCK)) + gap

    return F.when(n > 0, F.transform(F.slice(gaps, 1, n), start)).otherwise(F.array().cast("array<int>"))


_NO_TEXTS = "CAST(array() AS array<string>)"


def find(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``spans``: (kind, start, end, score), by kind in order of ``KINDS``, then by start."""
    plain, names = set_aside(df)
    kept = {c: n for c, n in names.items() if c != "spans"}
    rows = plain.select(*kept.values(), text_of(F.col(names[text_col])).alias("_text"))
    steps: list[dict[str, Column]] = [{}, {}, {}]
    for k in KINDS:
        may = F.contains("_text", F.lit(k.needs)) if k.needs in "@+" else F.col("_text").rlike(k.needs)
        none = F.expr(_NO_TEXTS)
        steps[0][f"_{k.name}"] = F.when(may, F.regexp_extract_all("_text", F.lit(k.pattern), F.lit(0))).otherwise(none)
        some = F.size(f"_{k.name}") > 0
        steps[1][f"_{k.name}_gap"] = F.when(some, F.transform(F.split("_text", k.pattern, -1), F.length)).otherwise(
            F.array().cast("array<int>")
        )
        steps[2][f"_{k.name}_at"] = _starts(F.col(f"_{k.name}_gap"), F.transform(f"_{k.name}", F.length))
    for columns in steps:
        rows = rows.withColumns(columns)

    def spans(k: Kind) -> Column:
        found, start = f"_{k.name}", f"_{k.name}_at"
        good = F.filter(F.arrays_zip(found, start), lambda p: _confirmed(k.name, p[found]))
        return F.transform(good, lambda p: _span(k, p[found], p[start]))

    def _span(k: Kind, found: Column, start: Column) -> Column:
        end = start + F.length(found)
        first = F.greatest(start - NEAR, F.lit(0))
        around = F.lower(
            F.concat(F.substr("_text", first + 1, start - first), F.lit(" "), F.substr("_text", end + 1, F.lit(NEAR)))
        )
        score = (
            F.lit(k.score)
            + F.when(around.rlike(k.words), RAISED).otherwise(0.0)
            - F.when(around.rlike(AGAINST), LOWER).otherwise(0.0)
        )
        return F.struct(F.lit(k.name).alias("kind"), start.alias("start"), end.alias("end"), F.round(score, 1).alias("score"))

    return rows.select(*brought_back(kept), F.concat(*[spans(k) for k in KINDS]).alias("spans"))


def joined(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of spans, comma-joined in their order."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(df: DataFrame, text_col: str = "text", least_score: float = 0.5) -> DataFrame:
    """``df`` of ``find`` with every span of at least that score replaced by its kind in brackets.

    Spans that overlap one that starts further left go with it.
    """
    chosen = F.array_sort(
        F.filter("spans", lambda s: s["score"] >= least_score),
        lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(b["end"] - a["end"]),
    )
    text = text_of(text_col)
    begin = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        made = F.concat(
            state["parts"], F.array(F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.concat(F.lit("["), s["kind"], F.lit("]")))
        )
        return F.when(
            s["start"] >= state["at"], F.struct(made.alias("parts"), s["end"].alias("at"))
        ).otherwise(F.struct(state["parts"].alias("parts"), F.greatest(state["at"], s["end"]).alias("at")))

    done = lambda state: F.concat(F.array_join(state["parts"], ""), F.substr(text, state["at"] + 1))
    return df.withColumn(text_col, F.when(F.size(chosen) > 0, F.aggregate(chosen, begin, step, done)).otherwise(F.col(text_col)))
