"""SimHash fingerprints, and near-duplicate groups by pigeonhole blocks.

A 64-bit fingerprint is cut into four blocks of 16 bits. Two fingerprints that differ in at most
two bits agree on at least two whole blocks, so each fingerprint is filed under its six pairs of
blocks (32 bits each) and only fingerprints of one file are compared, exactly. Equal fingerprints are
merged before filing, so groups of copies cost one row. In a file of more than PAIRS_UP_TO
different fingerprints not all pairs are formed: each fingerprint is listed under itself and the 32 values
that differ from it in one bit outside the file's blocks; two fingerprints are at most two bits apart
exactly if they share a listed value, so linking those of one value loses no link and the work stays in proportion.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from gritstone.llm.components import components
from gritstone.llm.store import map_text, stored

SEED = 42
BLOCK_BITS = 16
BLOCK_PAIRS = list(combinations(range(4), 2))
MAX_DISTANCE = 2
#: With n fingerprints there are n(n-1)/2 pairs or 33n listed values; beyond this many the latter are fewer.
PAIRS_UP_TO = 64
STEP = 1 << 15


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``width`` words, A-Z lower-cased; of all words if there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(joined)]
    take = max(1, len(words) - width + 1)
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:take], ends[min(width, len(words)) - 1 :])]
    return np.array(hashes, dtype=np.uint64)


def majority_bits(hashes: np.ndarray) -> int:
    """The 64-bit number whose bit is 1 where over half of the hashes have it (no hash: zero)."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), STEP):
        bits = np.unpackbits(hashes[at : at + STEP].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. Null and empty texts get zero."""

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = [majority_bits(shingle_hashes(x.as_py(), width)) for x in rows.column("text")]
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_text(docs.select("doc_id", "text"), work, f"doc_id {kind}, fp bigint")


def _block(fp: Column, number: int) -> Column:
    return F.shiftrightunsigned(fp, BLOCK_BITS * number).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _files(fp: Column) -> Column:
    """The six files of a fingerprint: number of the pair of blocks, and the blocks' bits."""
    return F.array(*[
        F.struct(F.lit(k).alias("pair"), (F.shiftleft(_block(fp, i), BLOCK_BITS) + _block(fp, j)).alias("bits"))
        for k, (i, j) in enumerate(BLOCK_PAIRS)
    ])


def _listed(fp: Column, pair: Column) -> Column:
    """The fingerprint and its one-bit neighbours outside the blocks of ``pair``."""
    out = None
    for k, blocks in enumerate(BLOCK_PAIRS):
        free = [b for n in range(4) if n not in blocks for b in range(BLOCK_BITS * n, BLOCK_BITS * (n + 1))]
        masks = [0, *(1 << b if b < 63 else -(1 << 63) for b in free)]
        values = F.array(*[fp.bitwiseXOR(F.lit(m).cast("long")) for m in masks])
        out = F.when(pair == k, values) if out is None else out.when(pair == k, values)
    return out


def links(distinct_fps: DataFrame) -> DataFrame:
    """(a, b): pairs of fingerprints at most two bits apart, enough to connect all that are linked.

    ``distinct_fps`` has one column fp without repeats.
    """
    filed = distinct_fps.select("fp", F.explode(_files(F.col("fp"))).alias("f")).select("fp", "f.pair", "f.bits")
    sizes = filed.groupBy("pair", "bits").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(filed.join(sizes, ["pair", "bits"]), "files")
    few = shared.where(F.col("n") <= PAIRS_UP_TO)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE
    pairs = (
        few.select("pair", "bits", F.col("fp").alias("a"))
        .join(few.select("pair", "bits", F.col("fp").alias("b")), ["pair", "bits"])
        .where((F.col("a") < F.col("b")) & near).select("a", "b")
    )
    listed = shared.where(F.col("n") > PAIRS_UP_TO).select(
        "pair", "bits", "fp", F.explode(_listed(F.col("fp"), F.col("pair"))).alias("value"))
    hubs = listed.groupBy("pair", "bits", "value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    starred = hubs.drop("n").join(listed, ["pair", "bits", "value"]).select("a", F.col("fp").alias("b")).where("a <> b")
    return pairs.unionByName(starred).distinct()


def near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): documents linked by fingerprints at most two bits apart.

    ``component_id`` is the smallest doc_id reachable, a document's own included. Null and
    empty texts share fingerprint zero and so belong together. Repeated rows stay. A row with a
    null doc_id keeps its fingerprint and takes the component of the others that have it (null if alone).
    """
    fps = stored(fingerprints(docs, width), "fingerprints")
    first = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    found = links(first.select("fp"))
    ends = found.join(first.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a") \
        .join(first.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b")
    roots = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))
    groups = first.join(roots, F.col("first") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "first").alias("component_id"))
    return fps.join(groups, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
