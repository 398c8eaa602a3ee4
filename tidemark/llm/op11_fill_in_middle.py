r"""Fill-in-middle rearrangement with counted quantifiers.

``regexp_count`` gives a text's number of units n.  Two cuts a <= b of 0..n follow from a hash of the id, and
a pattern made for the row, ``\A((?:unit){a}+)((?:unit){b-a}+)(.*)\z``, captures prefix, middle and suffix in one
match, whose replacement writes the marked output.  The possessive counts make the matcher walk the units in
a loop: it keeps no place to come back to, so depth and memory do not grow with a, and a text costs linear time.

All of it is column expressions on single rows: no shuffle, no Python, nothing that a frequent key could gather.
Lengths come from the places of the marks; the text is rebuilt from output and form alone, which is exact
because a text that holds a mark stays plain and no mark begins or ends inside another one.

Defined cases: a null text is an empty one, and an empty one stays plain with n 0; a null id hashes as the bare
seed; repeated rows give equal rows; texts that hold a mark stay plain; an empty table gives no rows; other columns of
the input are ignored, whatever their names.  Units must tile a text: what other patterns leave uncovered stays
in the suffix, or, before the cut, leaves the row plain.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents

#: A line with its end, or the last one without.
LINES = r"[^\n]*\n|[^\n]+"


class Marks(NamedTuple):
    """Their first character stands nowhere else in them."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def _literal(s: str) -> str:
    """As a replacement that stands for itself."""
    return s.replace("\\", r"\\").replace("$", r"\$")


def _quoted(s: str) -> str:
    return "".join("\\" + c if re.match(r"[^\w<>]", c) else c for c in s)


def draw(doc_id: Column, seed: int, i: int) -> Column:
    """The i-th (from 0) 32-bit number of an id's hash."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, unit: str = LINES, marks: Marks = Marks()) -> DataFrame:
    """doc_id, text, n, form, output: ``rate`` percent of the texts rearranged, ``spm`` percent of those with the suffix first."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.regexp_count(text, F.lit(unit)).cast("long").alias("n"), *(draw(F.col("doc_id"), seed, i).alias(f"h{i + 1}") for i in range(4)))
    cut = lambda h: F.col(h) % (F.col("n") + 1)
    rows = rows.withColumns({"a": F.least(cut("h1"), cut("h2")), "b": F.greatest(cut("h1"), cut("h2"))})
    marked = F.contains("text", F.lit(marks.prefix)) | F.contains("text", F.lit(marks.suffix)) | F.contains("text", F.lit(marks.middle))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= rate)
    rows = rows.withColumn("form", F.when(plain, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm"))
    pattern = F.concat(F.lit(rf"(?s)\A((?:{unit}){{"), F.col("a"), F.lit(rf"}}+)((?:{unit}){{"), F.col("b") - F.col("a"), F.lit(r"}+)(.*)\z"))
    p, s, m = map(_literal, marks)
    shape = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    out = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, shape))
    done = rows.withColumn("output", out)
    if unit != LINES:  # a text that its units do not tile may not match, and is then as it was
        done = done.withColumn("form", F.when(F.col("output") == F.col("text"), "plain").otherwise(F.col("form")))
    return done.select("doc_id", "text", "n", "form", "output")


def parts(marks: Marks = Marks()) -> tuple[Column, Column]:
    """Code points of prefix and middle, from ``form`` and ``output``; null where plain."""
    at = lambda x: F.instr("output", x)
    width = dict(zip(marks._fields, map(len, marks), strict=True))
    prefix = F.when(F.col("form") == "psm", at(marks.suffix) - 1 - width["prefix"]).when(F.col("form") == "spm", at(marks.middle) - at(marks.prefix) - width["prefix"])
    middle = F.when(F.col("form") != "plain", F.char_length("output") + 1 - at(marks.middle) - width["middle"])
    return prefix.cast("long"), middle.cast("long")


def restored(marks: Marks = Marks()) -> Column:
    """The text again, from ``form`` and ``output``."""
    p, s, m = map(_quoted, marks)
    psm = F.regexp_replace("output", F.lit(rf"(?s)\A{p}(.*){s}(.*){m}(.*)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace("output", F.lit(rf"(?s)\A{s}(.*){p}(.*){m}(.*)\z"), F.lit("$2$3$1"))
    return F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("output"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix, middle = parts()
    return fill_in_middle(documents(spark, sf_dir)).select(
        "doc_id", "n", "form", prefix.alias("prefix_chars"), middle.alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256")
    )


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (
  SELECT doc_id, text, CASE WHEN text = '' THEN [] ELSE regexp_extract_all(text, '[^\n]*\n|[^\n]+') END AS lines,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d),
c AS (
  SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT *, coalesce(array_to_string(lines[1:a], ''), '') AS pre, coalesce(array_to_string(lines[a + 1:b], ''), '') AS mid, coalesce(array_to_string(lines[b + 1:n], ''), '') AS suf
  FROM c)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
