"""Scalar text expressions (T1-T7, T9, and the greedy wrap of T8).

All are built-in Spark functions: whitespace splitting with Java's Unicode
class ``(?U)\\s``, word tokens as runs of letters, digits and underscore,
character counts in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_PATTERN = r"[\p{L}\p{N}_]+"
PUNCT_PATTERN = r"[!-/:-@\[-`{-~]"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prepared(c: str | Column) -> Column:
    """T1 with the reference's null rule: a missing text prints as 'nan'
    before lower-casing."""
    return F.lower(F.coalesce(_c(c), F.lit("nan")))


def n_chars(c: str | Column) -> Column:
    """Characters (code points)."""
    return F.length(_c(c))


def measured_length(c: str | Column) -> Column:
    """T2 (``measure_length``): length with a missing text counted as 1."""
    return F.coalesce(F.length(_c(c)), F.lit(1))


def words(c: str | Column) -> Column:
    """T3 tokens: split on runs of Unicode whitespace, empty pieces dropped."""
    return F.filter(F.split(_c(c), r"(?U)\s+"), lambda x: x != F.lit(""))


def n_words(c: str | Column) -> Column:
    return F.size(words(c))


def n_unique_words(c: str | Column) -> Column:
    """T4."""
    return F.size(F.array_distinct(words(c)))


def unique_ratio(c: str | Column) -> Column:
    """T5: distinct / total words * 100; null when there are no words."""
    return F.try_divide(n_unique_words(c).cast("double"), n_words(c).cast("double")) * F.lit(100.0)


def n_punct(c: str | Column) -> Column:
    """ASCII punctuation characters."""
    x = _c(c)
    return F.length(x) - F.length(F.regexp_replace(x, PUNCT_PATTERN, ""))


def drop_astral(c: str | Column) -> Column:
    """Remove characters above U+FFFF."""
    return F.regexp_replace(_c(c), r"[^\x{0000}-\x{FFFF}]", "")


def tokens(c: str | Column) -> Column:
    """Word tokens (letters, digits, underscore), in order."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_PATTERN), 0)


def long_tokens(c: str | Column) -> Column:
    """Tokens of two or more word characters (count-vectorizer default)."""
    return F.filter(tokens(c), lambda t: F.length(t) >= 2)


# Where a line may break inside a word: after the hyphen of a hyphenated word, and on
# both sides of dashes between words.
_IN_WORD = (r"(?U)(?:(?<=[^\d\W]{2}-)|(?<=[^\d\W]-[^\d\W]-))(?=[^\d\W]-?[^\d\W])"
            r"|(?<=[\w!\"'&.,?])(?=-{2,}\w)|(?<=[\w!\"'&.,?]-{2,20})(?=\w)")
_SPACE = r"\t\n\x0B\f\r "
_SPACES = "\t\n\x0b\f\r "


def wrap_pieces(c: str | Column, width: int) -> Column:
    """Greedy wrap into pieces of at most ``width`` characters, broken at white space,
    after hyphens and at dashes between words. White space becomes spaces (as many inside
    a line, none at a break); what is longer than ``width`` and cannot be broken is kept
    whole in its own piece. Returns an array of pieces.

    A fold over the array of unbreakable parts (``aggregate``) keeps the work per row, in
    the JVM, with no Python and no shuffle. A part's word, its spaces and its length are
    taken once, and the fold adds lengths: a lambda evaluates each use of an expression anew.
    """
    spaced = F.regexp_extract_all(_c(c), F.lit(f"[{_SPACE}]*[^{_SPACE}]+"), 0)
    # words break at hyphens and dashes only
    cut = F.flatten(F.transform(spaced, lambda w: F.when(F.contains(w, F.lit("-")), F.split(w, _IN_WORD)).otherwise(F.array(w))))
    words_ = F.transform(cut, lambda p: F.struct(F.ltrim(p, F.lit(_SPACES)).alias("word"), F.length(p).alias("n")))
    parts = F.transform(words_, lambda p: F.struct(
        p["word"].alias("word"), F.length(p["word"]).alias("n"), (p["n"] - F.length(p["word"])).alias("pad")))
    # accumulator: finished pieces + the piece being filled, with its length
    start = F.struct(F.array().cast("array<string>").alias("done"),
                     F.lit(None).cast("string").alias("cur"), F.lit(0).alias("n"))

    def step(acc, p):
        cur, word = acc["cur"], p["word"]
        n = acc["n"] + p["pad"] + p["n"]
        # only the text's first piece may begin with spaces
        fits = (cur.isNotNull() | (F.size(acc["done"]) == 0)) & (n <= F.lit(width))
        joined = F.concat(F.coalesce(cur, F.lit("")), F.repeat(F.lit(" "), p["pad"]), word)
        return F.when(fits, F.struct(acc["done"].alias("done"), joined.alias("cur"), n.alias("n"))) \
            .when(cur.isNull(), F.struct(acc["done"].alias("done"), word.alias("cur"), p["n"].alias("n"))) \
            .otherwise(F.struct(F.concat(acc["done"], F.array(cur)).alias("done"), word.alias("cur"), p["n"].alias("n")))

    def finish(acc):
        return F.when(acc["cur"].isNull(), acc["done"]).otherwise(
            F.concat(acc["done"], F.array(acc["cur"])))

    return F.aggregate(parts, start, step, finish)
