"""Benchmark decontamination: which documents contain a test item, short or long.

Words are the runs of letters and digits, lower-cased; shingles are five words (all the words of an item that has
fewer). A document contains an item if it has at least THRESHOLD of the item's different shingles.

Items are partitioned by size, the power of two below their number of shingles. An item is
represented by its MinHash signature, the shingles with the k smallest hashes, where k is one more than the
shingles that the largest item of the partition may lack; so a document that contains the item must
have one of them, however long the document is. Documents too short for a partition are passed over.
The documents' shingles are looked up in the signatures (a stored table: the planner broadcasts it
if its measured size allows, and else shuffles), and only the pairs found so are verified on the shingles themselves.

Everything here is built from DataFrame functions. Null and empty texts contain nothing; items
without words are skipped; rows that repeat a doc_id count once per pair with their best containment.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from gritstone.llm.store import stored

WIDTH = 5
THRESHOLD = 0.8
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(text), NOT_WORD), "")


def shingles(frame: DataFrame, keys: list[str], width: int | None = None) -> DataFrame:
    """keys, w, at and n for each shingle start; ``width`` None takes the frame's column of that name."""
    size = F.lit(width) if width else F.col("width")
    starts = F.when(F.size("w") >= size, F.sequence(F.lit(0), F.size("w") - size))
    return frame.select(*keys, "w", (F.size("w") - size + 1).alias("n"), F.explode(starts).alias("at"))


def _parts(width: int) -> list[Column]:
    return [F.get("w", F.col("at") + k) for k in range(width)]


def _each_width(frame: DataFrame, keys: list[str], widths: list[int], value) -> DataFrame:
    parts = [
        shingles(frame, keys, width).select(*keys, "n", F.lit(width).alias("width"), value(*_parts(width)).alias("s"))
        for width in widths
    ]
    return reduce(DataFrame.unionAll, parts)


def item_shingles(items: DataFrame, value) -> DataFrame:
    """item_id, width and each different shingle s of the item, as ``value`` makes it of the words."""
    tokens = items.select("item_id", words("text").alias("w")).where(F.size("w") > 0)
    tokens = tokens.withColumn("width", F.least(F.size("w"), F.lit(WIDTH)))
    parts = [
        shingles(tokens.where(F.col("width") == width), ["item_id"], width)
        .select("item_id", F.lit(width).alias("width"), value(*_parts(width)).alias("s"))
        for width in range(1, WIDTH + 1)
    ]
    return reduce(DataFrame.unionAll, parts).distinct()


def signatures(items: DataFrame, threshold: float) -> DataFrame:
    """item_id, width, s (hash) of the k smallest hashes, and ``need``: the fewest shingles a container has."""
    hashed = item_shingles(items, F.xxhash64)
    sizes = hashed.groupBy("item_id", "width").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("s")).alias("all"))
    part = F.floor(F.log2("n")).cast("int")
    most = F.pow(F.lit(2.0), F.col("part") + 1) - 1
    may_lack = (most - F.ceil(F.lit(threshold) * most)).cast("int")
    return sizes.withColumn("part", part).select(
        "item_id", "width", "part", F.ceil(F.lit(threshold) * F.pow(F.lit(2.0), "part")).cast("int").alias("need"),
        F.explode(F.slice("all", 1, F.least(F.col("n").cast("int"), may_lack + 1))).alias("s"))


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, key, item_id, n_shingles, n_shared, containment) of every pair at or above ``threshold``.

    ``key`` identifies the row: the hash of doc_id and text.
    """
    signed = stored(signatures(items, threshold), "signatures")
    exact = stored(item_shingles(items, lambda *w: F.concat_ws(" ", *w)), "item-shingles")
    widths = [row[0] for row in signed.select("width").distinct().collect()]  # five at most
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    if not widths:
        widths = [WIDTH]
    tokens = keyed.select("key", words("text").alias("w"))
    probes = _each_width(tokens, ["key"], widths, F.xxhash64)
    found = stored(
        probes.join(signed, ["width", "s"]).where(F.col("n") >= F.col("need")).select("key", "item_id").distinct(),
        "candidates")
    suspects = keyed.join(found.select("key").distinct(), "key", "left_semi").select("doc_id", "key", words("text").alias("w"))
    have = _each_width(suspects, ["doc_id", "key"], widths, lambda *w: F.concat_ws(" ", *w))
    shared = have.join(exact, ["width", "s"]).groupBy("doc_id", "key", "item_id").agg(F.count_distinct("s").alias("n_shared"))
    sizes = exact.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    return (
        shared.join(found, ["key", "item_id"]).join(sizes, "item_id")
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
        .where(F.col("n_shared") >= F.lit(threshold) * F.col("n_shingles"))
        .select("doc_id", "key", "item_id", "n_shingles", "n_shared", "containment")
    )


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and contained item."""
    return contained_items(docs, items, threshold).groupBy("doc_id", "item_id", "n_shingles").agg(
        F.max("n_shared").alias("n_shared"), F.max("containment").alias("containment"))


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    bad = stored(contained_items(docs, items, threshold).select("key").distinct(), "leaks")
    return docs.join(bad, F.xxhash64(docs["doc_id"], docs["text"]) == bad["key"], "left_anti")


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '{NOT_WORD}'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(string_split_regex(lower(text), '{NOT_WORD}'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, k AS width, array_to_string(list_slice(w, p, p + k - 1), ' ') AS s
  FROM d, range(1, {WIDTH} + 1) v(k), unnest(range(1, len(w) - k + 2)) t(p)
  WHERE k IN (SELECT least(len(w), {WIDTH}) FROM i)),
s AS (SELECT DISTINCT item_id, least(len(w), {WIDTH}) AS width, array_to_string(list_slice(w, p, p + least(len(w), {WIDTH}) - 1), ' ') AS s
  FROM i, unnest(range(1, len(w) - least(len(w), {WIDTH}) + 2)) t(p) WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n_shingles FROM s GROUP BY item_id)
SELECT ds.doc_id, s.item_id, n.n_shingles, count(*) AS n_shared, count(*) / n.n_shingles AS containment
FROM ds JOIN s USING (width, s) JOIN n ON n.item_id = s.item_id
GROUP BY ds.doc_id, s.item_id, n.n_shingles HAVING count(*) >= {THRESHOLD} * n.n_shingles
"""
