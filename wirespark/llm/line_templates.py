"""Dropping lines whose template recurs across documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirespark.llm.common import carried, restored, stored
from wirespark.operators.joins import lookup_join

#: Leading tokens of the tree, segments of the rest of which one may vary, fewest tokens of a
#: line that is judged and of one that is generalised, and documents that make a template recur.
DEPTH, SEGMENTS, MIN_TOKENS, MIN_GENERAL, MIN_DOCS = 3, 4, 3, 8, 3
#: Documents that make the very words of a line of ``MIN_GENERAL`` or more tokens recur.
MIN_SAME_DOCS = 2
#: Tokens without a digit that a template needs (more than half of the line's as well).
MIN_CONSTANT = 3
FIELD = "<*>"
DROPPED = "dropped_lines"

_BLANKS = "[\\x20\\x09-\\x0D]+"
_DIGITS = "[^\\x20\\x09-\\x0D0-9]*+[0-9][^\\x20\\x09-\\x0D]*+"


def tokens(line: Column) -> Column:
    """The tokens of a line; a token with a digit is a variable field."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _DIGITS, FIELD)).otherwise(line)
    return _split(masked)


def _split(line: Column) -> Column:
    return F.array_remove(F.split(line, _BLANKS), "")


def _templates(found: Column, line: Column, min_constant: int) -> Column:
    """Hashes of the templates that a line's tokens fit.

    The tree's path is the token count and the ``DEPTH`` leading tokens. Under it a line fits
    its own token sequence, and, if long enough, the sequences with one of ``SEGMENTS``
    equal segments of the other tokens generalised, and its words as they stand. A template
    with too few constant tokens is left out; a short line then fits its words only. The last
    bit of a hash says whether it stands for the words of a long line.
    """
    size = F.size(found)
    rest = size - DEPTH
    masked = F.array_contains(found, FIELD)

    def marked(template: Column, same: Column) -> Column:
        return template.bitwiseAND(F.lit(-2)).bitwiseOR(same.cast("bigint"))

    def judged(*parts: Column) -> Column:
        if not min_constant:
            return F.lit(True)
        constant = sum(F.size(F.array_remove(p, FIELD)) for p in parts)
        return ~masked | ((constant >= min_constant) & (constant * 2 > size))

    def general(segment: int) -> Column:
        begin = DEPTH + F.floor(rest * segment / SEGMENTS).cast("int")
        end = DEPTH + F.floor(rest * (segment + 1) / SEGMENTS).cast("int")
        parts = F.slice(found, 1, begin), F.slice(found, end + 1, size - end)
        template = marked(F.xxhash64(F.lit(segment), size, *parts), F.lit(False))
        return F.when(judged(*parts), template)

    words = F.xxhash64(F.lit(-2), size, _split(line))
    own = marked(F.xxhash64(F.lit(-1), size, found), ~masked & (size >= MIN_GENERAL))
    own = F.when(judged(found), own)
    long = F.array(own, *[general(i) for i in range(SEGMENTS)])
    return (
        F.when(size < MIN_GENERAL, F.array(F.coalesce(own, marked(words, F.lit(False)))))
        .when(masked, F.array_compact(F.concat(long, F.array(marked(words, F.lit(True))))))
        .otherwise(long)
    )


def recurring_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_constant: int = 0
) -> DataFrame:
    """The lines to drop of each document: row (hash of doc_id and text), dropped (line numbers).

    Only documents that lose a line are listed.
    """
    # The hash has a select of its own: beside the explode it would be computed for every line.
    hashed = docs.select(
        F.xxhash64("doc_id", "text").alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.split("text", "\n").alias("lines"),
    )
    lines = hashed.select("row", "doc_id", F.posexplode_outer("lines").alias("line_no", "line"))
    parsed = lines.select("row", "doc_id", "line_no", "line", tokens(F.col("line")).alias("found"))
    fitting = F.when(
        F.size("found") >= MIN_TOKENS, _templates(F.col("found"), F.col("line"), min_constant)
    )
    # The outer form, filtered afterwards: a filter on the tokens, or one that Spark infers for
    # the plain form, would move below them and have each line parsed twice.
    listed = parsed.select("row", "doc_id", "line_no", F.explode_outer(fitting).alias("template"))
    fits = stored(listed.filter(F.col("template").isNotNull()), "templates")
    # Once per document, then once per template: both aggregate in each task before the shuffle.
    met = fits.groupBy("template", "row").agg(F.min("doc_id").alias("doc_id"))
    counted = met.groupBy("template").agg(
        F.count("*").alias("docs"), F.min(F.struct("doc_id", "row")).alias("first")
    )
    same = F.col("template").bitwiseAND(F.lit(1)) == 1
    enough = F.when(same, F.least(F.lit(MIN_SAME_DOCS), F.lit(min_docs))).otherwise(min_docs)
    recurring = counted.filter(F.col("docs") >= enough).select(
        "template", F.col("first.row").alias("first")
    )
    dropped = lookup_join(fits, recurring, "template").filter("row != first")
    return dropped.groupBy("row").agg(F.collect_set("line_no").alias("dropped"))


def without_recurring_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_constant: int = 0
) -> DataFrame:
    """Documents without the lines whose template recurs in other documents.

    ``docs`` needs doc_id and text and keeps all its columns; ``dropped_lines`` (line numbers
    from 0, rising) is added or replaced. Lines are parsed by a tree of fixed depth: by
    token count, then by the leading tokens; variable fields (tokens with a digit, and one
    segment of a longer line) are generalised to templates. A template that at least
    ``min_docs`` documents have recurs, and so do the very words of a line of ``MIN_GENERAL``
    or more tokens that ``MIN_SAME_DOCS`` documents have: the lines go from all of them but the
    one with the smallest doc_id (null first), so what is written stays in the corpus once.
    With ``min_constant`` a template is judged only if so many tokens, and more than half of
    the line's, are constant; other lines are compared as they stand, so rows of different
    numbers stay. The query and the pipeline pass ``MIN_CONSTANT``.
    Lines of under ``MIN_TOKENS`` tokens stay, and so do passages shared inside lines that
    differ elsewhere. Rows equal in doc_id and text count as one document and are
    treated alike. A null text stays null, a text that loses all lines becomes empty, the
    order of lines is kept, an empty table gives an empty result.
    """
    drops = stored(recurring_lines(docs, min_docs, min_constant), "dropped-lines")
    # The document travels as one column, whatever its columns are called.
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text", carried(docs))
    named = drops.select("row", F.array_sort("dropped").alias("dropped"))
    joined = keyed.join(named.hint("shuffle_hash"), "row", "left")

    def without_dropped(lines: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(lines) - 1)
        kept = F.transform(F.array_except(places, F.col("dropped")), lambda i: F.get(lines, i))
        return F.array_join(kept, "\n")

    # Bound as a variable, the text is split once; inside the loop it would be for every line.
    left = F.transform(F.array(F.split("text", "\n")), without_dropped)[0]
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(left)
    found = {"text": text, DROPPED: F.coalesce("dropped", F.array().cast("array<int>"))}
    names = [*docs.columns, *([] if DROPPED in docs.columns else [DROPPED])]
    return joined.select(restored(names, found))
