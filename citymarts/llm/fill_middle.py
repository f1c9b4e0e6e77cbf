"""Fill-in-the-middle transformation by counted quantifiers (DataFrame functions only).

A text is cut into units by one regular expression. ``regexp_count`` tells how
many there are; two cut points drawn from a digest of the row's key give a
pattern of the row's own, whose possessive groups ``unit{a}`` and
``unit{b-a}`` take prefix, middle and suffix in one match. Possessive
repetition keeps the match linear and off the stack, however long the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blanks go with the word they stand before; trailing blanks are a unit of their own.
BLANK = r"\x20\x09-\x0D"
UNIT = rf"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+"
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")


def _quoted(mark: str) -> str:
    return "\\Q" + mark + "\\E"


def _draws(key: Column, seed: int) -> list[Column]:
    """The first four groups of eight digits of the key's digest, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 42,
    plain_from: int = 50,
    spm_below: int = 80,
    unit: str = UNIT,
    marks: Sequence[str] = MARKS,
) -> DataFrame:
    """``key``, ``n``, ``form``, ``prefix``, ``middle``, ``suffix``, ``output`` for every row.

    ``n`` counts the text's units. The cut points are the draws h1 and h2
    modulo n + 1, the smaller first. ``form`` is ``plain`` (``output`` is the
    text; the parts are NULL) if the text is empty, holds a mark or
    h3 % 100 >= ``plain_from``; else ``spm`` (suffix, prefix, middle) if
    h4 % 100 < ``spm_below``, else ``psm`` (prefix, suffix, middle).

    A NULL text counts as empty, a NULL key as an empty string in the digest.
    Every row is treated by itself, so repeated rows give repeated results and
    an empty table none; other columns are not read, so names cannot clash. No
    row leaves its task. ``unit`` must match every character of a text.
    """
    before_prefix, before_suffix, before_middle = marks
    draws = _draws(F.col(key), seed)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = F.lit(False)
    for m in marks:
        marked = marked | F.contains(body, F.lit(m))
    form = (
        F.when((body == "") | marked | (draws[2] % 100 >= plain_from), "plain").when(draws[3] % 100 < spm_below, "spm").otherwise("psm")
    )
    counted = docs.select(
        F.col(key),
        body.alias("_text"),
        F.regexp_count(body, F.lit(unit)).cast("long").alias("n"),
        form.alias("form"),
        draws[0].alias("_h1"),
        draws[1].alias("_h2"),
    )
    one, two = F.col("_h1") % (F.col("n") + 1), F.col("_h2") % (F.col("n") + 1)
    many = lambda count: F.concat(F.lit(f"((?:{unit}){{"), count.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit("(?s)^"), many(F.least(one, two)), many(F.abs(one - two)), F.lit("(.*+)"))
    # A text without marks can be cut at marks again: none can arise across a cut.
    parts = F.split(
        F.regexp_replace("_text", pattern, F.lit(f"$1{_escaped(before_middle)}$2{_escaped(before_suffix)}$3")),
        f"{_quoted(before_middle)}|{_quoted(before_suffix)}",
    )
    # A generator's output: what follows reads the parts and never matches again.
    cut = counted.select(
        key, "_text", "n", "form", F.explode(F.array(F.when(F.col("form") != "plain", parts))).alias("_parts")
    )
    prefix, middle, suffix = (F.col("_parts")[i] for i in range(3))
    output = (
        F.when(F.col("form") == "plain", F.col("_text"))
        .when(F.col("form") == "spm", F.concat(F.lit(before_suffix), suffix, F.lit(before_prefix), prefix, F.lit(before_middle), middle))
        .otherwise(F.concat(F.lit(before_prefix), prefix, F.lit(before_suffix), suffix, F.lit(before_middle), middle))
    )
    return cut.select(
        key, "n", "form", prefix.alias("prefix"), middle.alias("middle"), suffix.alias("suffix"), output.alias("output")
    )


def _escaped(mark: str) -> str:
    """``mark`` inside a replacement."""
    return mark.replace("\\", "\\\\").replace("$", "\\$")


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that ``fill_in_middle`` made ``output`` of, from it and ``form`` alone (NULL if either is)."""
    before_prefix, before_suffix, before_middle = map(_quoted, marks)
    psm = F.regexp_replace(output, F.lit(f"(?s)^{before_prefix}(.*?){before_suffix}(.*?){before_middle}(.*+)"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(f"(?s)^{before_suffix}(.*?){before_prefix}(.*?){before_middle}(.*+)"), F.lit("$2$3$1"))
    return F.when(form == "plain", output).when(form == "spm", spm).when(form == "psm", psm)
