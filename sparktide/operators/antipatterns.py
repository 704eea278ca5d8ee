"""Classification of logged query texts by costly predicate shapes.

A text is cut into lexemes by one pattern: comments, quoted texts, bracketed and quoted
names, numbers, words, operators. Each lexeme becomes a short code and the codes are
joined, which leaves a text without comments, blanks, letter case or literals, in which
a predicate has one spelling only:

    WHERE [t].[Views] IN (1, 2) OR Views = N'x'    W{7669657773}I<0,0>|{7669657773}=u

Names are written in hexadecimal between braces, so a name can hold anything. The
conditions of a text are then split at ANDs and parentheses into runs of terms joined by
OR, and the literals compared with a column are counted inside its run only. All steps are
built-in functions over one row, with patterns that can't recurse on a long text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktide.workspace import materialise

# From this many IN values or OR terms on a mistyped column a query is flagged.
TERM_THRESHOLD = 65

# A column of these types is converted to be compared with a number ...
TEXT_TYPES = ("char", "nchar", "nvarchar", "string", "text", "varchar")
# ... and one of these also to be compared with a national text.
NARROW_TYPES = ("char", "text", "varchar")

_LEXEME = (
    r"(?s)--[^\r\n]*+|/\*.*?\*/|[Nn]?'[^']*+'|\[[^\]]*+\]|\"[^\"]*+\"|\d[\w.]*+"
    r"|[@#]*+[\p{L}_][\p{L}\p{N}_@#$]*+|<>|[!<>]=|![<>]|\S"
)

# Words that open conditions, that end them, and that stand inside.
_OPEN = ("where", "on", "having")
_END = (
    "select from group order set union except intersect option values join inner full outer cross apply"
    " insert update delete merge then begin end go"
).split()
_WORDS = dict.fromkeys(_OPEN, "W") | dict.fromkeys(_END, ";") | {
    "and": "&", "or": "|", "in": "I", "not": "!", "between": "B", "like": "L", "is": "S", "null": "N", "case": "?", "when": "?", "else": "?",
}
_SIGNS = dict.fromkeys(("<>", "!=", "<=", ">=", "!<", "!>", "<", ">"), "~") | dict.fromkeys("+-*/%", "+") | {c: c for c in "=().,;"}

_NAME = r"\{([0-9A-F]*+)\}"
# 0 a number, s a text, u a national text; + any arithmetic.
_LITERAL = r"[+0su]++"


def _lookup(codes: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in codes.items() for x in pair]), key)


def _named(name: Column) -> Column:
    return F.concat(F.lit("{"), F.hex(F.lower(name)), F.lit("}"))


def _code(lexeme: Column) -> Column:
    first = F.substring(lexeme, 1, 1)
    return (
        F.when(lexeme.startswith("--") | lexeme.startswith("/*"), "")
        .when(first == "'", "s")
        .when(F.lower(F.substring(lexeme, 1, 2)) == "n'", "u")
        .when(first.isin("[", '"') & (F.length(lexeme) > 1), _named(F.substr(lexeme, F.lit(2), F.length(lexeme) - 2)))
        .when(first.rlike(r"\d"), "0")
        .when(first == "@", "v")
        .when(first.rlike(r"[\p{L}_#]"), F.coalesce(_lookup(_WORDS, F.lower(lexeme)), _named(lexeme)))
        .otherwise(F.coalesce(_lookup(_SIGNS, lexeme), F.lit("?")))
    )


def coded(text: Column) -> Column:
    """The codes of a query text."""
    lexemes = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_LEXEME), F.lit(0))
    return F.array_join(F.transform(lexemes, _code), "")


def _shaped(codes: Column) -> Column:
    """Qualifiers dropped, lists of literals in angle brackets, single terms and OR groups without parentheses."""
    text = F.regexp_replace(codes, r"\{[0-9A-F]*+\}\.", "")
    text = F.regexp_replace(text, r"B([+0su]++)&([+0su]++)", "B<$1,$2>")
    text = F.regexp_replace(text, r"(?<![}?v])\(([+0su,]++)\)", "<$1>")
    for _ in range(3):
        text = F.regexp_replace(text, r"(?<![}?vI!+])\(([^()&;W]++)\)(?!\+)", "$1")
    return text


def _terms(run: Column) -> Column:
    """(name, kind, terms) of the comparisons of a run whose one side is a bare column, the other literal."""
    # A name on the left, or on the right of a literal.
    left = rf"^{_NAME}(=|~|I|!I|B|!B)<?([+0su,]++)>?$"
    right = rf"^<?({_LITERAL})>?[=~]{_NAME}$"

    # Step by step, so that each pattern is asked once a term.
    def sides(text: Column) -> Column:
        return F.struct(text.alias("text"), F.regexp_extract(text, left, 1).alias("name"))

    def parts(t: Column) -> Column:
        named = t["name"] != ""
        return F.struct(
            F.when(named, t["name"]).otherwise(F.regexp_extract(t["text"], right, 2)).alias("name"),
            # A list is as many terms as it has values; one that is negated, or a range, is one.
            F.when(named, F.regexp_extract(t["text"], left, 3)).otherwise(F.regexp_extract(t["text"], right, 1)).alias("literals"),
            (named & t["text"].contains("}I")).alias("listed"),
        )

    def term(t: Column) -> Column:
        literals = t["literals"]
        kind = F.when(F.contains(literals, F.lit("0")), "number").when(F.contains(literals, F.lit("u")), "national").otherwise("text")
        n = F.when(t["listed"], F.length(literals) - F.length(F.replace(literals, F.lit(","), F.lit(""))) + 1).otherwise(1)
        return F.struct(t["name"].alias("name"), kind.alias("kind"), n.cast("int").alias("n"))

    bare = F.filter(F.transform(F.transform(F.split(run, r"\|"), sides), parts), lambda t: t["name"] != "")
    return F.transform(bare, term)


def _runs(text: Column) -> Column:
    """The terms of each run of a query text."""
    conditions = F.regexp_extract_all(_shaped(coded(text)), F.lit(r"W([^W;]++)"), F.lit(1))
    runs = F.flatten(F.transform(conditions, lambda c: F.split(c, r"[&()]")))
    return F.filter(F.transform(runs, _terms), lambda terms: F.size(terms) > 0)


def _compared(runs: Column) -> Column:
    """(name, kind, n) per column and kind of literal: the most terms in one run."""
    keys = F.array_distinct(F.transform(F.flatten(runs), lambda t: F.struct(t["name"].alias("name"), t["kind"].alias("kind"))))

    def most(key: Column) -> Column:
        def in_run(terms: Column) -> Column:
            mine = F.filter(terms, lambda t: (t["name"] == key["name"]) & (t["kind"] == key["kind"]))
            return F.aggregate(mine, F.lit(0), lambda total, t: total + t["n"])

        return F.struct(key["name"].alias("name"), key["kind"].alias("kind"), F.array_max(F.transform(runs, in_run)).alias("n"))

    return F.transform(keys, most)


def antipattern_scan(
    query_log: DataFrame, column_types: DataFrame, threshold: int = TERM_THRESHOLD
) -> DataFrame:
    """Flag columns that a query compares with literals of another type, and long lists of such terms.

    ``column_types`` has (column_name, type_name). A text column compared with a number is
    converted, and one of a narrow type compared with a national text; both are flagged
    only where the bare column is one side of the comparison. ``large_number_of_or`` tells
    that one list, or one run of terms joined by OR, has ``threshold`` such terms or more.
    A row per query and column; queries without a flag are left out. Null and empty texts
    have no flags. Runs a job over ``column_types``.
    """
    kinds = F.when(F.lower("type_name").isin(*NARROW_TYPES), F.array(F.lit("number"), F.lit("national")))
    kinds = kinds.when(F.lower("type_name").isin(*TEXT_TYPES), F.array(F.lit("number")))
    mistyped = column_types.select(F.col("column_name").alias("compared_column"), F.explode(kinds).alias("kind")).distinct()
    # Written, so that Spark knows how small the list is; most texts may name one column.
    mistyped = materialise(mistyped.withColumn("name", F.hex(F.lower("compared_column"))), "text_columns")
    # In two steps: the text is cut once, its runs are asked several times.
    cut = query_log.select("query_id", _runs(F.col("query_sql_text")).alias("runs"))
    # No filter on the runs: it would be pushed down and cut every text a second time.
    found = cut.select("query_id", F.explode(_compared(F.col("runs"))).alias("found"))
    met = found.select("query_id", "found.*").join(mistyped, ["name", "kind"], "inner")
    return met.groupBy("query_id", "compared_column").agg(
        F.lit(1).alias("type_convert"), F.when(F.max("n") >= threshold, 1).otherwise(0).alias("large_number_of_or")
    )
