"""Repeated paragraphs: MinHash bands, exact confirmation, and removal by components.

A paragraph here is a passage of PASSAGE words at a place that its own words choose, since what repeats may stand inside a
longer line: of every REACH consecutive places the one whose first five words hash lowest begins a passage. A
run of PASSAGE + REACH - 1 = 50 words that stands in two documents so begins a passage at the same word in both, whatever is around
it and however it is broken into lines; runs well below PASSAGE words (titles, short lines) are never compared. Lines of at
least PASSAGE words are passages as a whole, too, so that an edit within does not hide them. Passages the same lower-cased words are one, so one that stands in a third of all documents is one row from then on. Whole
lines get MinHash values of their five-word shingles; the bands are tuned so that a pair at the least similarity
collides with probability RECALL. A placed passage has one band, its least shingle, with which it begins, and that of what overlaps it widely in its text; those whose band
no other text holds are left behind at once. Of documents with equal texts one is looked at, and the passages of the others all go. Colliding passages are confirmed by exact Jaccard similarity (files of very many
as in ``copies``), and confirmed pairs joined into components. Of each component the passages of the first document (by
doc_id) stay, and those of all others go. Words of a repeated run outside its passages, fewer than REACH at either end, stay.

Null and empty texts, and texts of fewer than PASSAGE words, have no passages. Rows that agree in doc_id and text count
once as a source and get the same result; a null doc_id comes first. What repeats within one document only stays.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_128_digest

from gritstone.llm.components import components
from gritstone.llm.copies import SIMILARITY, WIDTH, confirmed, links, sharing
from gritstone.llm.store import slices, stored
from gritstone.llm.words import FACTORS, odd_numbers, scramble, shingles, word_hashes

PASSAGE, REACH = 24, 27
RECALL = 0.997
BAND_ROWS = 2
SHINGLES = PASSAGE - WIDTH + 1
#: Words between the beginnings of two passages, and words of a line around a passage, up to which they are similar.
APART, WIDEST = int(SHINGLES * (1 - SIMILARITY) / (1 + SIMILARITY)), int(SHINGLES / SIMILARITY) + WIDTH - 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Places whose neighbourhoods are compared at once.
STEP = 1 << 16


def tuned_bands(similarity: float = SIMILARITY, rows: int = BAND_ROWS, recall: float = RECALL) -> int:
    """The fewest bands of ``rows`` values with which a pair at ``similarity`` collides with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


BANDS = tuned_bands()
_SEEDS = np.random.default_rng(5).integers(0, 1 << 64, BANDS * BAND_ROWS, dtype=np.uint64)
_FACTORS = odd_numbers(2 * BANDS * BAND_ROWS)[BANDS * BAND_ROWS :]
_IN_PASSAGE = FACTORS[WIDTH : WIDTH + PASSAGE]


def bands(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """One row of band values for each passage of words [start, stop), from the shingle hashes of the whole text."""
    out = np.zeros((len(starts), BANDS), dtype=np.uint64)
    if len(starts):
        edges = np.column_stack([starts, stops - WIDTH + 1]).ravel()
        for k, (seed, factor) in enumerate(zip(_SEEDS, _FACTORS)):
            values = np.append((hashes ^ seed) * factor, np.uint64(0))  # so that the last edge lies inside
            values ^= values >> np.uint64(32)
            values *= np.uint64(0x9E3779B97F4A7C15)
            least = np.minimum.reduceat(values, edges)[::2]
            band = k // BAND_ROWS
            out[:, band] = scramble(out[:, band] * np.uint64(0x9E3779B97F4A7C15) + least + np.uint64(band))
    return out.view(np.int64)


def passage_starts(hashes: np.ndarray) -> np.ndarray:
    """The words at which passages begin: of each REACH places (all, if there are fewer) the first of least hash."""
    places = len(hashes) - SHINGLES + 1
    if places <= 0:
        return np.zeros(0, dtype=np.int64)
    reach = min(REACH, places)
    low, chosen = np.uint64((2 << 16) - 1), []
    for at in range(0, places - reach + 1, STEP):
        part = hashes[at : min(at + STEP + reach - 1, places)] * np.uint64(0x94D049BB133111EB)
        least, width = (part & ~low) | np.arange(len(part), dtype=np.uint64), 1  # the place within the part, so that it is found again
        while width < reach:
            step = min(width, reach - width)
            least, width = np.minimum(least[:-step], least[step:]), width + step
        chosen.append((least & low).astype(np.int64) + at)
    found = np.concatenate(chosen)
    return found[np.append(True, found[1:] != found[:-1])]


def overlapping(starts: np.ndarray, first: int, stop: int) -> np.ndarray:
    """Which of the passages that begin at these places of a text share at least SIMILARITY of their shingles with its words [first, stop)."""
    both = np.minimum(starts + SHINGLES, stop - WIDTH + 1) - np.maximum(starts, first)
    return np.flatnonzero(both >= SIMILARITY * (SHINGLES + stop - first - WIDTH + 1 - both))


def located(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[int]]]:
    """Of a text in UTF-8 bytes: place, key and rest of each placed passage; pairs (numbers) of those that overlap widely; place, stop,
    key and rest of each whole line; the lines' bands.

    Key and rest identify the lower-cased words. The key of a placed passage is its band, and that of what overlaps it widely.
    """
    begins, words = word_hashes(data)
    if len(words) < PASSAGE:
        return np.zeros((0, 3), np.int64), np.zeros((0, 2), np.int64), np.zeros((0, 4), np.int64), []
    hashes = shingles(words, WIDTH)
    starts = passage_starts(hashes)
    rest = scramble((words[starts[:, None] + np.arange(PASSAGE)] * _IN_PASSAGE).sum(axis=1, dtype=np.uint64))
    line = np.searchsorted(np.flatnonzero(data == 10), begins)
    ends = np.concatenate([[0], np.flatnonzero(line[1:] != line[:-1]) + 1, [len(words)]])
    first, stop = ends[:-1], ends[1:]
    first, stop = first[stop - first >= PASSAGE], stop[stop - first >= PASSAGE]
    digests = b"".join(xxh3_128_digest(words[a:b].tobytes()) for a, b in zip(first.tolist(), stop.tolist()))
    placed = np.column_stack([starts, hashes[starts].view(np.int64), rest.view(np.int64)])
    keys = placed[:, 1]
    close = [np.flatnonzero((starts[k:] - starts[:-k] <= APART) & (keys[k:] != keys[:-k])) for k in range(1, APART + 1)]
    one = np.concatenate([x for k, n in enumerate(close, 1) for x in (n, n + k)])
    other = np.concatenate([x for k, n in enumerate(close, 1) for x in (n + k, n)])
    made = bands(hashes, first, stop).tolist()
    for n in np.flatnonzero(stop - first <= WIDEST).tolist():
        made[n] += keys[overlapping(starts, first[n], stop[n])].tolist()
    return (placed, np.column_stack([one, other]),
            np.column_stack([first, stop, np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)]), made)


def passages(text: str) -> tuple[list[tuple[int, int, int, int]], list[list[int] | None]]:
    """(first word, last word + 1, and two longs that identify its lower-cased words) of every passage by its place, and the bands of whole lines.

    The first long of a placed passage is its band; its place in the second list is None.
    """
    placed, _, lines, made = located(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8))
    found = [((place, place + PASSAGE, key, rest), None) for place, key, rest in placed.tolist()]
    found += [(tuple(line), own) for line, own in zip(lines.tolist(), made)]
    found.sort(key=lambda x: x[0])
    return [x for x, _ in found], [own for _, own in found]


PLACED = "array<struct<place:int,key:bigint,rest:bigint>>"
NEAR = "array<struct<one:int,other:int>>"
LINES = "array<struct<place:int,stop:int,key:bigint,rest:bigint,bands:array<bigint>>>"


def listed(docs: DataFrame) -> DataFrame:
    """row, doc_id, same (equal for equal texts), total (different places), placed, near (numbers of two that overlap widely) and lines of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def nested(counts: list[int], columns: list[pa.Array], names: list[str]) -> pa.Array:
        offsets = pa.array(np.cumsum([0, *counts]), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                found = [located(np.frombuffer(x.as_buffer() or b"", dtype=np.uint8)) for x in rows.column("text")]
                total = [len({*p[:, 0].tolist()} - {*n[n[:, 1] - n[:, 0] == PASSAGE, 0].tolist()}) + len(n) for p, _, n, _ in found]
                p, near, n = (np.concatenate([x[k] for x in found]) for k in range(3))
                own = [x for f in found for x in f[3]]
                of = [nested([len(x[k]) for x in found], columns, names) for k, columns, names in (
                    (0, [pa.array(p[:, 0], pa.int32()), pa.array(p[:, 1]), pa.array(p[:, 2])], ["place", "key", "rest"]),
                    (1, [pa.array(near[:, k], pa.int32()) for k in (0, 1)], ["one", "other"]),
                    (2, [*(pa.array(n[:, k], pa.int32()) for k in (0, 1)), pa.array(n[:, 2]), pa.array(n[:, 3]), pa.array(own, pa.list_(pa.int64()))],
                     ["place", "stop", "key", "rest", "bands"]))]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in ("row", "doc_id", "same")), pa.array(total, pa.int32()), *of],
                    ["row", "doc_id", "same", "total", "placed", "near", "lines"])

    return docs.select("row", "doc_id", "same", "text").mapInArrow(
        run, f"row bigint, doc_id {kind}, same bigint, total int, placed {PLACED}, near {NEAR}, lines {LINES}")


def texts_at(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(row, text): the words of the passages ``wanted`` (id, row, place, stop), under their id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                ids, texts = [], []
                for text, places in zip(rows.column("text"), rows.column("places")):
                    words = text.as_py().encode("utf-8", "surrogatepass").split()
                    for one in places.as_py():
                        ids.append(one["id"])
                        texts.append(b" ".join(words[one["place"] : one["stop"]]).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["row", "text"])

    places = wanted.groupBy("row").agg(F.collect_list(F.struct("id", "place", "stop")).alias("places"))
    # Texts and places are dealt by row once; rows that occur twice go there.
    found = docs.select("row", "text").join(places.hint("merge"), "row").dropDuplicates(["row"])
    return found.select("text", "places").mapInArrow(run, "row bigint, text string")


def shared_passages(found: DataFrame) -> DataFrame:
    """row, doc_id, place, key, rest and band of the placed passages of ``found``, for each of their bands that stands in another text, too."""
    placed = found.select("row", "doc_id", "same", F.inline("placed"))
    keys = placed.groupBy("key").agg(F.min("same").alias("x"), F.max("same").alias("y")).where("x <> y").select(F.col("key").alias("band"))
    names = ["row", "doc_id", "place", "key", "rest", "band"]
    near = found.where(F.size("near") > 0).select("row", "doc_id", "placed", F.inline("near")).select(
        "row", "doc_id", F.col("placed")[F.col("one")].alias("p"), F.col("placed")[F.col("other")]["key"].alias("band")).select(
        "row", "doc_id", "p.place", "p.key", "p.rest", "band")
    return placed.withColumn("band", F.col("key")).select(names).unionByName(near.select(names)).join(stored(keys, "bands-shared"), "band").select(names)


def classes(docs: DataFrame, pool: DataFrame, lines: DataFrame) -> DataFrame:
    """(key, rest, first): for passages that repeat, exactly or nearly, the (doc_id, row, place, stop) of the first of their class."""
    names = ["doc_id", "row", "place", "stop", "key", "rest"]
    every = pool.withColumn("stop", F.col("place") + PASSAGE).select(
        *names, "band", F.lit(None).cast("array<bigint>").alias("bands")).unionByName(
        lines.select(*names, F.lit(None).cast("bigint").alias("band"), "bands"))
    different = stored(
        every.groupBy("key", "rest").agg(
            F.min(F.struct("doc_id", "row", "place", "stop")).alias("first"), (F.min("row") != F.max("row")).alias("again"),
            F.array_distinct(F.concat(F.collect_set("band"), F.flatten(F.collect_set("bands")))).alias("bands"))
        .withColumn("id", F.monotonically_increasing_id()), "different", compression="zstd")
    unsigned = F.lit(None).cast("array<bigint>").alias("sign")
    filed = stored(sharing(different.select(F.col("id").alias("row"), unsigned, F.explode("bands").alias("file"))), "files")
    wanted = different.select("id", "first.row", "first.place", "first.stop").join(
        filed.select(F.col("row").alias("id")).distinct(), "id", "left_semi")
    held = stored(texts_at(docs, wanted), "passage-texts", compression="zstd")

    def texts_of(rows: DataFrame) -> DataFrame:
        return held.join(rows, "row", "left_semi")

    def confirm(pairs: DataFrame) -> DataFrame:
        return confirmed(pairs, held)

    roots = components(links(filed, confirm, texts_of))
    rooted = different.select("key", "rest", "first", "again", "id").join(roots, F.col("id") == F.col("node"), "left")
    alone = rooted.where("root is null and again").select("key", "rest", "first")
    linked = rooted.where("root is not null")
    firsts = linked.groupBy("root").agg(F.min("first").alias("first"))
    return alone.unionByName(linked.select("key", "rest", "root").join(firsts, "root").select("key", "rest", "first"))


def repeated_paragraphs(docs: DataFrame) -> DataFrame:
    """One line per row: doc_id, row, n_paragraphs, n_removed, removed (place and stop, in words), kept_in (doc_ids where they stay)."""
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.xxhash64("text").alias("same"), "text")
    found = stored(listed(keyed), "paragraphs", compression="zstd")
    sources = found.groupBy("same").agg(F.min(F.struct("doc_id", "row")).alias("source"))
    pool = stored(shared_passages(found), "pool")
    lines = found.select("row", "doc_id", F.inline("lines"))
    repeats = stored(classes(keyed, pool, lines), "classes")
    spans = ["row", "place", "stop", "key", "rest"]
    every = pool.withColumn("stop", F.col("place") + PASSAGE).select(*spans).unionByName(lines.select(*spans))
    removed = every.join(repeats, ["key", "rest"]).where("first.row <> row").groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("place", "stop"))).alias("removed"), F.sort_array(F.collect_set("first.doc_id")).alias("kept_in"))
    # Of documents with equal texts all but the first lose every passage, whatever their passages share with others.
    copied = F.col("row") != F.col("source.row")
    span = F.when(copied, F.sort_array(F.array_distinct(F.concat(
        F.transform("placed", lambda x: F.struct(x.alias("place"), (x + PASSAGE).alias("stop"))),
        F.arrays_zip(F.col("first").alias("place"), F.col("last").alias("stop"))))))
    rows = found.select(
        "doc_id", "row", "same", "total", F.col("placed.place").alias("placed"), F.col("lines.place").alias("first"), F.col("lines.stop").alias("last")
    ).join(sources, "same").select(
        "doc_id", "row", F.col("total").cast("long").alias("n_paragraphs"), span.alias("own"),
        F.when(copied & (F.col("total") > 0), F.array_compact(F.array("source.doc_id"))).alias("own_source"))
    joined = rows.dropDuplicates(["doc_id", "row"]).join(removed, "row", "left")
    gone = F.coalesce("own", "removed", F.array().cast("array<struct<place:int,stop:int>>"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    kept = F.coalesce("own_source", F.when(F.col("own").isNull(), F.col("kept_in")), F.array().cast(f"array<{kind}>"))
    return joined.select(
        "doc_id", "row", "n_paragraphs", F.size(gone).cast("long").alias("n_removed"), gone.alias("removed"), kept.alias("kept_in"))


def without_passages(text: str, removed: list[tuple[int, int]]) -> str:
    """``text`` without these passages (first word, last word + 1; by first word) and the white space after each."""
    spans = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for first, stop in removed:
        if spans[first][0] > at:
            out.append(text[at : spans[first][0]])
        at = max(at, spans[stop][0] if stop < len(spans) else len(text))
    return "".join([*out, text[at:]])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages taken out of ``text``; rows and other columns stay."""
    gone = stored(repeated_paragraphs(docs).where("n_removed > 0").groupBy("row").agg(F.first("removed").alias("removed")), "removed")
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text", F.struct(*docs.columns).alias("rest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                texts = [
                    without_passages(text, [(x["place"], x["stop"]) for x in removed])
                    for text, removed in zip(rows.column("text").to_pylist(), rows.column("removed").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    cut = keyed.select("row", "text").dropDuplicates(["row"]).join(gone, "row").mapInArrow(run, "row bigint, text string") \
        .select("row", F.col("text").alias("cut"))
    joined = keyed.select("row", "rest").join(cut, "row", "left")
    return joined.select(*[F.coalesce("cut", "rest.text").alias(c) if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns])
