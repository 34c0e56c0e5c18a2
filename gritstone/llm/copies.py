"""Near copies by SimHash fingerprints, then by wider blocks, confirmed on five-word shingles.

First the method of ``simhash`` as it is: the 64-bit SimHash of all shingles (of five words) of a text is cut into pigeonhole
blocks, and all fingerprints at most two bits apart are found. That misses most edited copies of short documents, and no
slices of one SimHash are both long enough to keep unlike texts apart and short enough for a similarity of 0.8. So the search
goes on from the components found: a text also has BLOCKS blocks of 64 bits. Block k is the SimHash of the DRAWN shingles
that come first in the k-th random order, so two texts share it with probability about similarity ** DRAWN
whatever kind of edit lies between them: at 0.8 at least one of the blocks with probability above 0.99. Texts that share a
block are compared by the Hamming distance of a SimHash of SIGN_WORDS words over all their shingles, with a limit that
similar texts pass (below). All pairs are confirmed by the exact Jaccard similarity and joined into components.

Texts with equal words are merged before anything else, so a group of exact copies is one row. Of the texts that share a block,
each is first compared with one of them, the hub (in ROUNDS rounds, each with other hubs and across the components known so far): a group
of near copies costs a few comparisons a text and then is one component. After that all pairs that share a block and
still lie in different components are compared, so no link between texts that share a block is missed. Where more than
CROWDED texts share one, they are filed anew by their rarest shingles; where as many share one of these, not pairs of texts are moved but the texts: they are dealt into parts, every two parts meet in one
cell, and a cell counts the shingles that one text shares with all others at once. The comparisons there still grow with the
square of the texts, what is moved with the square over CELL, and no cell holds more than two parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_128_digest

from gritstone.llm import simhash
from gritstone.llm.components import components
from gritstone.llm.simhash import majority_bits, shingle_hashes
from gritstone.llm.store import map_text, slices, stored
from gritstone.llm.words import different_shingles, shared

BLOCKS, DRAWN, SIGN_WORDS = 9, 3, 2
WIDTH, SIMILARITY = 5, 0.8
#: At similarity 0.8 the cosine is at least 0.888 and 19.5 of 128 bits differ, with a deviation of 4.1: six deviations above.
MAX_DISTANCE = 44
ROUNDS = 1
#: Files of more texts than CROWDED are compared by cells of two parts, each of about CELL texts and CELL_CHARS characters at most.
CROWDED, CELL, CELL_CHARS = 32, 256, 4_000_000

_ROUND = np.random.default_rng(11).integers(0, 1 << 64, BLOCKS + SIGN_WORDS, dtype=np.uint64)


def scrambled(hashes: np.ndarray, k: int) -> np.ndarray:
    mixed = hashes ^ _ROUND[k]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return mixed ^ (mixed >> np.uint64(33))


def signature(hashes: np.ndarray) -> list[int]:
    """SIGN_WORDS SimHash fingerprints of the different hashes, as signed longs."""
    bits = [majority_bits(scrambled(hashes, BLOCKS + k)) for k in range(SIGN_WORDS)]
    return np.array(bits, dtype=np.uint64).view(np.int64).tolist()


def block_values(hashes: np.ndarray) -> list[int]:
    """For each order, the SimHash of the first DRAWN hashes, mixed with the number of the order."""
    out = np.zeros(BLOCKS, dtype=np.uint64)
    for k in range(BLOCKS if len(hashes) else 0):
        mixed = scrambled(hashes, k)
        first = mixed if len(mixed) <= DRAWN else np.partition(mixed, DRAWN - 1)[:DRAWN]
        out[k] = majority_bits(scrambled(first, k))
    return (out + np.arange(BLOCKS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64).tolist()


def signatures(docs: DataFrame) -> DataFrame:
    """row, doc_id, words (digest of the lower-cased words), signature and blocks of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(rows: pa.RecordBatch) -> pa.RecordBatch:
        digests, signed, blocks = [], [], []
        for text in rows.column("text"):
            value = text.as_py() or ""
            hashes = np.unique(shingle_hashes(value, WIDTH))
            digests.append(xxh3_128_digest(b" ".join(value.encode("utf-8", "surrogatepass").lower().split())))
            signed.append(signature(hashes))
            blocks.append(block_values(hashes))
        return pa.RecordBatch.from_arrays(
            [rows.column("row"), rows.column("doc_id"), pa.array(digests, pa.binary()), pa.array(signed, pa.list_(pa.int64())),
             pa.array(blocks, pa.list_(pa.int64()))], ["row", "doc_id", "words", "signature", "blocks"])

    return map_text(docs.select("row", "doc_id", "text"), run,
                    f"row bigint, doc_id {kind}, words binary, signature array<bigint>, blocks array<bigint>")


def close(one: Column, other: Column) -> Column:
    """Whether two signatures (null: not known) are near enough to be compared exactly."""
    apart = sum((F.bit_count(F.get(one, F.lit(k)).bitwiseXOR(F.get(other, F.lit(k)))) for k in range(SIGN_WORDS)), F.lit(0))
    return F.coalesce(apart <= MAX_DISTANCE, F.lit(True))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts (row, text) share at least SIMILARITY of their five-word shingles."""
    sides = [texts.select(F.col("row").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text_b"):
                number: dict[int, int] = {}  # a text stands in many pairs
                met, ends = [], []
                for x in "ab":
                    ids = rows.column(x).to_pylist()
                    for n, row in enumerate(ids):
                        if row not in number:
                            number[row] = len(number)
                            met.append(rows.column(f"text_{x}")[n].as_py())
                    ends.append(np.array([number[row] for row in ids], dtype=np.int64))
                own = different_shingles(met, WIDTH)
                size = np.array([len(x) for x in own], dtype=np.int64)
                both = shared(own, *ends)
                keep = both >= SIMILARITY * (size[ends[0]] + size[ends[1]] - both)
                yield rows.select(["a", "b"]).filter(pa.array(keep))

    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(run, "a bigint, b bigint")


def _labelled(shared: DataFrame, found: DataFrame | None) -> DataFrame:
    """``shared`` with the component of every row, for files that lie in more than one."""
    if found is None:
        return shared.withColumn("part", F.col("row"))
    parts = stored(components(found), "parts").select(F.col("node").alias("row"), "root")
    labelled = shared.join(parts, "row", "left").select(*shared.columns, F.coalesce("root", "row").alias("part"))
    split = labelled.groupBy("file").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x <> y").select("file")
    return stored(labelled.join(split, "file", "left_semi"), "split")


def compared(cell: pa.Table) -> pa.Table:
    """Confirmed pairs (a, b) of the texts (row, text, sign, part, side) of one cell, enough to connect what is similar.

    If the cell has two sides, only texts of different sides are compared.
    """
    rows, part, side = (cell.column(c).to_numpy() for c in ("row", "part", "side"))
    own = different_shingles(cell.column("text").to_pylist(), WIDTH)
    size = np.array([len(x) for x in own])
    owner = np.repeat(np.arange(len(own)), size)
    shingles, which = np.unique(np.concatenate(own), return_inverse=True)
    ends = np.cumsum([0, *size])
    signs = cell.column("sign").to_pylist()
    signed = np.array([x is not None for x in signs])
    words = np.array([x or [0] * SIGN_WORDS for x in signs], dtype=np.int64).view(np.uint64)
    across = len(np.unique(side)) > 1
    held, found = np.zeros(len(shingles), dtype=bool), []
    for x in range(len(rows)):
        wanted = part != part[x]
        wanted[: x + 1] = False
        if across:
            wanted &= side != side[x]
        if signed[x]:
            wanted &= ~signed | (np.bitwise_count(words ^ words[x]).sum(axis=1, dtype=np.int64) <= MAX_DISTANCE)
        if not wanted.any():
            continue
        mine = which[ends[x] : ends[x + 1]]
        held[mine] = True
        both = np.bincount(owner[held[which]], minlength=len(rows))
        held[mine] = False
        for y in np.flatnonzero(wanted & (both >= SIMILARITY * (size + size[x] - both))):
            if part[y] != part[x]:
                found.append((rows[x], rows[y]))
                part = np.where(part == part[y], part[x], part)
    a, b = np.array(found, dtype=np.int64).reshape(-1, 2).T
    return pa.table({"a": a, "b": b})


def crowded_links(left: DataFrame, texts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Confirmed pairs (a, b) of the rows of one file that lie in different parts; ``texts`` gives (row, text) for rows."""
    held = stored(texts(left.select("row").distinct()), "crowded-texts")
    lengths = held.select("row", F.length("text").alias("chars"))
    wide = left.join(lengths, "row").groupBy("file").agg(
        F.greatest(F.ceil(F.count("*") / CELL), F.ceil(F.sum("chars") / CELL_CHARS), F.lit(1)).cast("int").alias("parts"))
    dealt = left.join(wide, "file").withColumn("side", F.pmod(F.xxhash64("row", F.lit(CELL)), F.col("parts")).cast("int"))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "file", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "row", "sign", "part", "side")
    return cells.join(held, "row").groupBy("file", "low", "high").applyInArrow(compared, "a bigint, b bigint")


def sharing(filed: DataFrame) -> DataFrame:
    """The rows of ``filed`` (file, row, sign) whose file holds more than one."""
    sizes = filed.groupBy("file").agg(F.count("*").alias("n")).where("n > 1").select("file")
    return filed.select("file", "row", "sign").join(sizes, "file")


def links(
    filed: DataFrame, confirm: Callable[[DataFrame], DataFrame], texts: Callable[[DataFrame], DataFrame],
    found: DataFrame | None = None, anew: bool = False,
) -> DataFrame:
    """Confirmed pairs (a, b), enough to connect all rows that share a file and are similar; ``found`` are pairs known before.

    ``filed`` has file and row, both long, and sign, an array of longs or null, by which pairs are ruled out early. It is read
    several times: pass a stored table of what ``sharing`` leaves. ``anew`` says that it is made of rare shingles already.
    """
    left = filed
    for turn in range(ROUNDS):
        left = _labelled(left.select("file", "row", "sign"), found)
        if found is not None and left.isEmpty():  # every file lies in one component
            return found
        hubs = left.groupBy("file").agg(F.min_by(F.struct("row", "sign", "part"), F.xxhash64("row", F.lit(turn))).alias("hub"))
        pairs = left.join(hubs, "file").where((F.col("hub.part") != F.col("part")) & close(F.col("hub.sign"), F.col("sign")))
        # The hub comes first, so its shingles are made once for the pairs that follow each other.
        ends = pairs.select(F.col("hub.row").alias("a"), F.col("row").alias("b")).distinct()
        more = stored(confirm(ends), "links")
        found = more if found is None else found.unionByName(more)
    left = _labelled(left.select("file", "row", "sign"), found)
    sizes = left.groupBy("file").agg(F.count("*").alias("n"))
    few = left.join(sizes.where(F.col("n") <= CROWDED).select("file"), "file")
    many = stored(left.join(sizes.where(F.col("n") > CROWDED).select("file"), "file"), "crowded")
    one, other = (few.select("file", *[F.col(c).alias(f"{c}_{x}") for c in ("row", "sign", "part")]) for x in "ab")
    rest = one.join(other, "file").where(
        (F.col("row_a") < F.col("row_b")) & (F.col("part_a") != F.col("part_b")) & close(F.col("sign_a"), F.col("sign_b")))
    more = confirm(rest.select(F.col("row_a").alias("a"), F.col("row_b").alias("b")).distinct())
    if many.isEmpty():
        return found.unionByName(more)
    found = found.unionByName(stored(more, "links"))
    if anew:
        return found.unionByName(crowded_links(many, texts))
    rows = many.select("row", "sign").dropDuplicates(["row"])
    finer = sharing(rare_shingles(texts(rows.select("row"))).join(rows, "row"))
    return links(stored(finer, "finer-files"), confirm, texts, found, anew=True)


def rare_shingles(texts: DataFrame) -> DataFrame:
    """(file, row): each text (row, text) under so many of its shingles, the rarest first, that texts similar to it have one of theirs among them.

    Of n shingles SIMILARITY * n at least are shared, so one of any n - SIMILARITY * n + 1 of them is; and if both texts take their
    first ones in one order of all shingles, one that both have taken. So no link between similar texts is lost.
    """

    def run(rows: pa.RecordBatch) -> pa.RecordBatch:
        own = [x.view(np.int64) for x in different_shingles(rows.column("text").to_pylist(), WIDTH)]
        return pa.RecordBatch.from_arrays([rows.column("row"), pa.array(own, pa.list_(pa.int64()))], ["row", "own"])

    own = stored(map_text(texts.select("row", "text"), run, "row bigint, own array<bigint>"), "crowded-shingles")
    each = own.select("row", F.size("own").alias("n"), F.explode("own").alias("file"))
    counted = each.join(each.groupBy("file").agg(F.count("*").alias("held")), "file")
    ordered = counted.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("held", "file"))).alias("own"))
    least = F.ceil(F.size("own") * F.lit(SIMILARITY) - F.lit(1e-9))
    return ordered.select("row", F.explode(F.slice("own", F.lit(1), (F.size("own") - least + 1).cast("int"))).alias("x")).select("x.file", "row")


def fingerprint_pairs(texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of the texts (row, sign) whose 64-bit SimHash, the first word of ``sign``, differs in two bits at most, enough to connect them."""
    prints = stored(texts.select("row", F.get("sign", F.lit(0)).alias("fp")), "prints")
    first = stored(prints.groupBy("fp").agg(F.min("row").alias("first")), "firsts")
    equal = prints.join(first, "fp").where("row <> first").select(F.col("first").alias("a"), F.col("row").alias("b"))
    ends = [first.select(F.col("fp").alias(x), F.col("first").alias(f"row_{x}")) for x in "ab"]
    near = simhash.links(first.select("fp")).join(ends[0], "a").join(ends[1], "b").select(
        F.col("row_a").alias("a"), F.col("row_b").alias("b"))
    return equal.unionByName(near)


def groups(docs: DataFrame) -> DataFrame:
    """(row, doc_id, kept): every row, and the row that stays of its group (the smallest doc_id)."""
    signed = stored(signatures(docs), "signatures")
    texts = stored(
        signed.groupBy("words").agg(F.min(F.struct("row", "signature", "blocks")).alias("one")).select(
            "words", "one.row", F.col("one.signature").alias("sign"), "one.blocks"), "texts")

    filed = stored(sharing(texts.select("row", "sign", F.explode("blocks").alias("file"))), "files")
    pairs = stored(fingerprint_pairs(texts), "near")
    # Texts are moved once to pick all that may be compared; every later step picks from these.
    wanted = filed.select("row").unionByName(pairs.select(F.col("a").alias("row"))).unionByName(pairs.select(F.col("b").alias("row")))
    held = stored(
        docs.select("row", F.coalesce("text", F.lit("")).alias("text")).join(wanted.distinct().hint("merge"), "row", "left_semi")
        .dropDuplicates(["row"]), "candidate-texts")

    def texts_of(rows: DataFrame) -> DataFrame:
        return held.join(rows, "row", "left_semi")

    def confirm(pairs: DataFrame) -> DataFrame:
        return confirmed(pairs, held)

    near = stored(confirm(pairs), "near-fingerprints")
    roots = components(links(filed, confirm, texts_of, near))
    grouped = texts.select("words", "row").join(roots, F.col("row") == F.col("node"), "left").select("words", F.coalesce("root", "row").alias("root"))
    rows = stored(signed.select("row", "doc_id", "words").join(grouped, "words").select("row", "doc_id", "root"), "rooted")
    first = rows.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    return rows.join(first, "root").select("row", "doc_id", F.col("first.row").alias("kept"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies, all columns as they are.

    Null and empty texts are copies of each other. Of rows that agree in doc_id and text one stays.
    """
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("row"), F.struct(*docs.columns).alias("rest"), "doc_id", "text")
    found = stored(groups(keyed.select("row", "doc_id", "text")), "groups")
    gone = stored(found.where("row <> kept").select("row").distinct(), "gone")
    twice = stored(found.where("row = kept").groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row"), "twice")
    # What goes grows with the corpus, so it is never a side to broadcast.
    left = keyed.select("row", "rest").join(gone.hint("merge"), "row", "left_anti")
    if twice.isEmpty():
        return left.select("rest.*")
    once = left.join(twice, "row", "left_anti").unionByName(left.join(twice, "row", "left_semi").dropDuplicates(["row"]))
    return once.select("rest.*")
