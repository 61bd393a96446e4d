"""Regular expressions met with names by an index, instead of every one with every name.

A text that a pattern finds holds the pattern's required literal, if it has one. The literal's first three characters are the
join key with the three-character parts of the names; what the literal occurs in meets the pattern itself. Patterns without
such a literal meet every name, in blocks of a bounded number. ASCII letters are folded in the index, so that it serves
patterns that ignore casing too; the pattern decides with its own flags.
"""

from __future__ import annotations

import re
import string
from re import _constants as kinds  # type: ignore[attr-defined]
from re import _parser as parser  # type: ignore[attr-defined]

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ironsift.operators.dims import small
from ironsift.sources.shared import new_folder

GRAM = 3
FEW = 16  # patterns that meet every row of names, rather than distinct names
LOOSE = 256  # patterns without a literal that meet each name at a time
_FOLD = (string.ascii_uppercase, string.ascii_lowercase)
# What Java's patterns and Python's read differently: classes within classes, quotes, octal escapes, Unicode casing.
_DIFFERS = re.compile(r"\[[^\]]*\[|&&|\\[QE0]|\(\?[a-zA-Z]*[uU]")


def required_literal(pattern: str) -> str:
    """The longest text, with ASCII letters lowered, that every match of a pattern holds; empty where none is certain."""
    if _DIFFERS.search(pattern):
        return ""
    try:
        tree = parser.parse(pattern)
    except (re.error, OverflowError, RecursionError):
        return ""
    if tree.state.flags & re.IGNORECASE and any(ord(c) > 127 for c in pattern):
        return ""
    runs = [""]
    _collect(tree, runs)
    return max(runs, key=len).translate(str.maketrans(*_FOLD))


def _collect(tree: parser.SubPattern, runs: list[str]) -> None:
    """Appends to the last run what must follow it, and begins a new one where anything may stand in between."""
    for kind, value in tree:
        if kind is kinds.LITERAL:
            runs[-1] += chr(value)
        elif kind is kinds.AT:
            continue
        elif kind is kinds.SUBPATTERN:
            _collect(value[3], runs)
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT) and value[0] > 0:
            _collect(value[2], runs)
            runs.append("")
        elif kind in (kinds.ASSERT, kinds.ASSERT_NOT):
            continue
        else:
            runs.append("")


def _folded(column: str | Column) -> Column:
    return F.translate(column, *_FOLD)


def _grams(text: Column) -> Column:
    """The distinct three-character parts of a text."""
    last = F.char_length(text) - GRAM + 1
    parts = F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(GRAM)))
    return F.when(last >= 1, F.array_distinct(parts)).otherwise(F.array().cast("array<string>"))


def pattern_index(patterns: DataFrame, column: str = "pattern") -> DataFrame:
    """Adds literal, and gram (its first characters; null where it is shorter)."""
    literal = F.udf(required_literal, "string", useArrow=False)(F.col(column))
    indexed = patterns.withColumn("literal", literal)
    return indexed.withColumn("gram", F.when(F.char_length("literal") >= GRAM, F.left("literal", F.lit(GRAM))))


def find_patterns(names: DataFrame, patterns: DataFrame, name: str = "name", pattern: str = "pattern") -> DataFrame:
    """Every row of names with every row of patterns that is found in its name: the columns of both. Null names and patterns are
    found nowhere. The two have no column in common. With more than FEW patterns, each distinct name meets each distinct pattern
    once, however many rows have them; their index is written first, or Spark would look for literals before it drops copies, and again
    for each use."""
    names, patterns = names.filter(F.col(name).isNotNull()), patterns.filter(F.col(pattern).isNotNull())
    if patterns.limit(FEW + 1).count() <= FEW:
        return _met(names, pattern_index(patterns, pattern), name, pattern).select(*names.columns, *patterns.columns)
    folder = new_folder(names.sparkSession, "patterns")
    pattern_index(patterns.select(pattern).distinct(), pattern).write.parquet(folder)
    hits = _met(names.select(name).distinct(), names.sparkSession.read.parquet(folder), name, pattern).select(name, pattern).join(patterns, pattern)
    return names.join(hits, name).select(*names.columns, *patterns.columns)


def _met(names: DataFrame, indexed: DataFrame, name: str, pattern: str) -> DataFrame:
    found = F.regexp_like(F.col(name), F.col(pattern))
    strict = small(indexed.filter("gram IS NOT NULL"))
    parts = names.withColumn("_folded", _folded(name)).withColumn("_gram", F.explode(_grams(F.col("_folded"))))
    hits = parts.join(strict, F.col("_gram") == F.col("gram")).filter(F.contains("_folded", "literal") & found)
    columns = [*names.columns, *(x for x in indexed.columns if x not in ("literal", "gram"))]
    out = hits.select(*columns)
    loose = indexed.filter("gram IS NULL").drop("literal", "gram")
    for block in _blocks(loose, pattern):
        out = out.unionByName(names.join(F.broadcast(block), found).select(*columns))
    return out


def _blocks(loose: DataFrame, pattern: str) -> list[DataFrame]:
    """The patterns in tables of at most LOOSE rows."""
    n = loose.count()
    if n <= LOOSE:
        return [loose] if n else []
    numbered = loose.withColumn("_n", F.row_number().over(Window.orderBy(pattern)))
    return [numbered.filter(F.col("_n").between(k + 1, k + LOOSE)).drop("_n") for k in range(0, n, LOOSE)]
