"""Fill-in-the-middle: texts cut at lines into prefix, middle and suffix, and put together in another order.

``regexp_count`` gives a text's number of units ``n``.  Two hashes of the id choose the cuts ``a <= b``, and a
pattern of the row's own, with the possessive groups ``unit{a}`` and ``unit{b - a}``, captures prefix, middle and
suffix in one match, which the replacement writes out in the new order.  A possessive quantifier over a group is a
loop in Java's engine, without a stack frame per unit, and gives nothing back, so a match is linear in the text
however many lines it has.  All of it runs inside Spark's expressions; there is no shuffle.

The markers must be such that no text part and marker together can make another one: they start with a character
and end with a character that lie nowhere else in them.  A text that holds a marker stays plain, so the output can
be taken apart at the markers and the text restored.

Defined results: a null or empty text is plain with ``n`` = 0; a null id is hashed as an empty text, so all rows
without an id share their random numbers; rows that share an id are rows of their own; an empty table gives no rows;
all columns of a row are carried in ``row``, so their names cannot clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a line with its end, or a last line without one.
LINE = r"[^\n]*\n|[^\n]+"


@dataclass(frozen=True)
class Markers:
    """What stands before prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        every = (self.prefix, self.suffix, self.middle)
        firsts, lasts = {m[:1] for m in every}, {m[-1:] for m in every}
        inner = "".join(m[1:-1] for m in every)
        if len(set(every)) < 3 or any(len(m) < 2 for m in every) or firsts & lasts or any(c in inner for c in firsts | lasts):
            raise ValueError("markers must differ, and their outer characters must lie nowhere else in them")

    @property
    def every(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle

    @property
    def pattern(self) -> str:
        return "|".join(map(_quoted, self.every))


def _quoted(text: str) -> str:
    """A pattern for the text itself."""
    return re.sub(r"([^0-9A-Za-z])", r"\\\1", text)


def _literal(text: str) -> str:
    """A replacement for the text itself."""
    return text.replace("\\", r"\\").replace("$", r"\$")


def draws(doc_id: Column, seed: str) -> list[Column]:
    """Four unsigned 32-bit numbers from the id: the first groups of eight digits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_middle(documents: DataFrame, seed: str = "7:", rate: int = 100, spm_share: int = 50, unit: str = LINE,
                markers: Markers = Markers()) -> DataFrame:
    """Per row ``row`` (all its columns), ``n``, ``form`` and ``output``.

    ``rate`` percent of the texts are taken apart, ``spm_share`` percent of those with the suffix first.
    """
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    drawn = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")).select(
        "row", text.alias("_text"), F.array(*draws(F.col("row.doc_id"), seed)).alias("_h"))
    counted = drawn.withColumn("n", F.regexp_count("_text", F.lit(unit)).cast("long"))
    h = [F.col("_h")[i] for i in range(4)]
    first, second = h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)
    plain = (F.col("_text") == "") | (h[2] % 100 >= rate)
    for marker in markers.every:
        plain = plain | F.contains("_text", F.lit(marker))
    cut = counted.withColumns({
        "form": F.when(plain, "plain").when(h[3] % 100 < spm_share, "spm").otherwise("psm"),
        "_a": F.least(first, second), "_b": F.greatest(first, second)})
    group = f"((?:{unit}){{"
    pattern = F.concat(F.lit(r"\A" + group), F.col("_a").cast("string"), F.lit("}+)" + group),
                       (F.col("_b") - F.col("_a")).cast("string"), F.lit(r"}+)((?s:.*))\z"))
    p, s, m = map(_literal, markers.every)
    order = F.when(F.col("form") == "psm", f"{p}$1{s}$3{m}$2").otherwise(f"{s}$3{p}$1{m}$2")
    output = F.when(F.col("form") == "plain", F.col("_text")).otherwise(F.regexp_replace("_text", pattern, order))
    return cut.select("row", "n", "form", output.alias("output"))


def taken_apart(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """``prefix``, ``middle``, ``suffix`` of an output; all null for a plain one."""
    parts = F.split(output, markers.pattern, -1)
    # Parts follow their markers: psm is prefix, suffix, middle and spm is suffix, prefix, middle.
    psm = F.struct(parts[1].alias("prefix"), parts[3].alias("middle"), parts[2].alias("suffix"))
    spm = F.struct(parts[2].alias("prefix"), parts[3].alias("middle"), parts[1].alias("suffix"))
    return F.when(form == "psm", psm).when(form == "spm", spm)


def restored(output: Column, form: Column, parts: Column) -> Column:
    """The text an output was made of."""
    return F.when(form == "plain", output).otherwise(F.concat(parts["prefix"], parts["middle"], parts["suffix"]))
