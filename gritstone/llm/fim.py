"""Fill-in-the-middle: a text is cut at two unit borders and written as prefix, suffix, middle or suffix, prefix, middle.

``regexp_count`` gives the number of units n. Two draws from the row's hash make the cuts 0 <= a <= b <= n, and one
match of a pattern made for the row, ``(unit){a}+`` and ``(unit){b-a}+`` as groups and the rest as a third, captures
the three parts; the replacement string of that same match puts them in order. The counted groups are possessive, so
the matcher walks over the units in a loop, neither backtracks nor recurses, and a text of a million lines is one pass.

Units must cover the text without gaps when matched left to right (lines, by default). Null texts count as empty. A text
that is empty, holds a mark or is not drawn stays as it is (form ``plain``). A null key is hashed as the empty string.
Repeated rows are treated alike; an empty table gives an empty result; columns of the names in ADDED are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

LINE = r"[^\n]*+\n|[^\n]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ADDED = ("n", "form", "output")


@dataclass(frozen=True)
class Draw:
    """Seed of the row hash; of 100 texts ``rate`` are cut, of 100 of those ``spm_rate`` put the suffix first."""

    seed: int = 7
    rate: int = 100
    spm_rate: int = 50


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit integers from the SHA-256 of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def cut_pattern(before: Column, inside: Column, unit: str) -> Column:
    return F.concat(
        F.lit(rf"(?s)\A((?:{unit}){{"), before.cast("string"), F.lit(rf"}}+)((?:{unit}){{"), inside.cast("string"), F.lit(r"}+)(.*+)\z"))


def fill_in_middle(frame: DataFrame, key: str = "doc_id", text: str = "text", draw: Draw = Draw(), unit: str = LINE) -> DataFrame:
    """All columns of ``frame`` with n (units, long), form (plain, psm or spm) and output (string)."""
    kept = [F.col(f"`{c}`") for c in frame.columns if c.lower() not in ADDED]
    row = F.struct(*kept) if kept else F.struct(F.lit(None).alias("_none"))
    whole = F.col("`_text`")
    marked = whole.contains(PREFIX) | whole.contains(SUFFIX) | whole.contains(MIDDLE)
    first, second, drawn, order = (F.get("`_draws`", k) for k in range(4))
    units = F.col("`_n`") + 1
    low, high = F.least(first % units, second % units), F.greatest(first % units, second % units)
    form = F.when((whole == "") | marked | (drawn % 100 >= draw.rate), "plain").when(order % 100 < draw.spm_rate, "spm").otherwise("psm")
    order_of_parts = F.when(F.col("`_form`") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    cut = F.regexp_replace(whole, F.col("`_pattern`"), order_of_parts)
    return (
        frame.select(row.alias("_row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
                     F.array(*draws(F.col(f"`{key}`"), draw.seed)).alias("_draws"))
        .withColumn("_n", F.regexp_count("_text", F.lit(unit)).cast("long"))
        .withColumn("_form", form).withColumn("_pattern", cut_pattern(low, high - low, unit))
        .select(*(["_row.*"] if kept else []), F.col("_n").alias("n"), F.col("_form").alias("form"),
                F.when(F.col("_form") == "plain", whole).otherwise(cut).alias("output"))
    )


def _between(text: Column, start: str, end: str) -> Column:
    return F.substring_index(F.substring_index(text, end, 1), start, -1)


def parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix of an output that is not plain.

    No part holds a mark, and no mark can begin in a part and end in the mark after it, so the marks are where they were put.
    """
    psm = form == "psm"
    prefix = F.when(psm, _between(output, PREFIX, SUFFIX)).otherwise(_between(output, PREFIX, MIDDLE))
    suffix = F.when(psm, _between(output, SUFFIX, MIDDLE)).otherwise(_between(output, SUFFIX, PREFIX))
    return prefix, F.substring_index(output, MIDDLE, -1), suffix


def with_parts(cut: DataFrame) -> DataFrame:
    """``prefix``, ``middle``, ``suffix`` (null if plain) and ``restored``, rebuilt from output and form alone."""
    prefix, middle, suffix = parts(F.col("output"), F.col("form"))
    plain = F.col("form") == "plain"
    split = cut.withColumns({"prefix": F.when(~plain, prefix), "middle": F.when(~plain, middle), "suffix": F.when(~plain, suffix)})
    return split.withColumn("restored", F.when(plain, F.col("output")).otherwise(F.concat("prefix", "middle", "suffix")))


def digests(cut: DataFrame, key: str = "doc_id") -> DataFrame:
    return with_parts(cut).select(
        key, "n", "form", F.char_length("prefix").cast("long").alias("prefix_chars"), F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l,
  list_transform([1, 9, 17, 25], lambda k: CAST(concat('0x', substr(h, k, 8)) AS BIGINT)) AS r FROM d),
c AS (SELECT *, len(l) AS n, least(r[1] % (len(l) + 1), r[2] % (len(l) + 1)) AS a, greatest(r[1] % (len(l) + 1), r[2] % (len(l) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
    WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(list_slice(l, 1, a), '') AS pre, array_to_string(list_slice(l, a + 1, b), '') AS mid,
  array_to_string(list_slice(l, b + 1, n), '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
