"""Exact removal of repeated byte strings, by bucket-pointer refinement over sparse suffixes.

A byte goes if a string of LENGTH bytes that covers it also starts earlier (smaller doc_id, or earlier in the same
document). Sorting all suffixes of a large corpus would shuffle many times its size, so suffixes are
taken at anchors only: in every string of LENGTH bytes the Q-gram with the smallest identifier (leftmost on ties). Equal
strings have the same anchor at the same offset, so nothing is missed.

Buckets. Identifiers of longer prefixes come from those of shorter ones at later offsets, each level reused by
the next: 1, 2, 4, 8, 16, Q = 24, 48, 96 and LENGTH = 100 bytes. They are 64-bit fingerprints instead of ranks, so
no level needs a sort of its own. An anchor's initial bucket is its Q-gram. The bucket is sorted on the identifiers of the LENGTH-byte strings
at the two ends of the anchor's run (the strings that have this anchor): anchors that agree there have the same run, and
all but the first of them are repeats as a whole. What is left of a bucket with several different runs
is refined by their bytes around the anchor: up to GROUP_UP_TO runs in one task, which notes the strings it has met
(a few dozen for each run), more by one row for each string, grouped by its digest, so a passage
with very many contexts is spread out.

Null texts are empty. Texts under LENGTH bytes lose nothing. Rows that agree in doc_id and text count as one document and get
the same result; rows that agree in doc_id only are ordered by a hash of the text. A null doc_id comes first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh3_128_digest

from gritstone.llm.store import slices, stored

LENGTH = 100
Q = 24
SPAN = LENGTH - Q + 1
PLACE_BITS = 28
GROUP_UP_TO = 10_000
PAIRS_UP_TO = 8
#: Bytes of text worked on at once: every byte takes a dozen numbers of eight bytes.
STEP = 1_000_000
#: A bucket with so many anchors in one of LOOKED_AT parts of the documents is crowded.
LOOKED_AT, CROWDED = 64, 2000
ID = ["doc_id", "tie"]

_BYTE = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Identifier of two strings in a row from theirs."""
    out = left * _LEFT
    out ^= out >> np.uint64(32)
    out += right
    out *= _RIGHT
    out ^= out >> np.uint64(29)
    return out


def refined(left: np.ndarray, right: np.ndarray, offset: int) -> np.ndarray:
    """Identifiers of longer prefixes at every place, by those at the place and ``offset`` later."""
    n = max(0, len(right) - offset)
    return mix(left[:n], right[offset : offset + n])


def anchor_runs(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of equal anchors in texts laid end to end (``ends``: where each stops).

    text: its number; at: place of the anchor in the text; before, after: the run's strings start at - before to at - after.
    """
    names = ("text", "at", "before", "after", "bucket", "run")
    if len(data) < LENGTH:
        return {n: np.zeros(0, dtype=np.int64) for n in names}
    two = refined(one := _BYTE[data], one, 1)
    four = refined(two, two, 2)
    eight = refined(four, four, 4)
    gram = refined(sixteen := refined(eight, eight, 8), eight, 16)
    double = refined(gram, gram, Q)
    whole = refined(refined(double, double, 2 * Q), four, 4 * Q)
    del one, two, eight, sixteen, double
    order = (gram >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(gram), dtype=np.uint64)
    reach = 1
    while reach < SPAN:
        step = min(reach, SPAN - reach)
        order = np.minimum(order[: len(order) - step], order[step:])
        reach += step
    anchor = (order & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    good = np.ones(len(anchor), dtype=bool)
    for end in ends.tolist():
        good[max(0, end - LENGTH + 1) : end] = False
    place = np.flatnonzero(good)
    if not len(place):
        return {n: np.zeros(0, dtype=np.int64) for n in names}
    own = anchor[place]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(place)]]) - 1
    low, high, at = place[first], place[last], own[first]
    text = np.searchsorted(ends, low, side="right")
    before, after = at - low, at - high
    run = mix(mix(whole[low], whole[high]), (before * 256 + after).astype(np.uint64))
    return {"text": text, "at": at - starts[text], "before": before, "after": after,
            "bucket": gram[at].view(np.int64), "run": run.view(np.int64)}


def own_repeats(found: dict[str, np.ndarray]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Which runs are the first of their kind in their text; (text, start, stop) of what the others cover, merged."""
    text, at = found["text"], found["at"]
    order = np.lexsort((at, found["run"], found["bucket"], text))
    first = np.ones(len(at), dtype=bool)
    again = np.ones(max(0, len(at) - 1), dtype=bool)
    for name in ("text", "bucket", "run"):
        again &= found[name][order][1:] == found[name][order][:-1]
    first[order[1:][again]] = False
    text, start, stop = text[~first], (at - found["before"])[~first], (at - found["after"])[~first] + LENGTH
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] > stop[:-1])
    last = np.concatenate([np.flatnonzero(new)[1:], [len(text)]])[: new.sum()] - 1
    return first, (text[new], start[new], stop[last])


def _bytes(column: pa.Array) -> list[bytes]:
    return [(x.as_py() or "").encode("utf-8", "surrogatepass") for x in column]


def with_tie(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")


def each_once(texts: DataFrame) -> DataFrame:
    """One of the rows that agree in doc_id and text: a row that is given twice is no earlier copy of itself.

    Only rows that are given several times are moved for it.
    """
    twice = stored(texts.groupBy(*ID).agg(F.count("*").alias("n")).where("n > 1").select(*ID), "twice")
    if twice.isEmpty():
        return texts
    same = [texts["doc_id"].eqNullSafe(twice["doc_id"]), texts["tie"] == twice["tie"]]
    return texts.join(twice, same, "left_anti").unionByName(stored(texts.join(twice, same, "left_semi").dropDuplicates(ID), "once"))


def anchors(docs: DataFrame, kind: str) -> DataFrame:
    """One row per different run of every text, and one (``own``) for each range that runs of the same text repeat.

    The latter need no comparison: ``at`` to ``at`` - ``after`` + LENGTH is the range, and the bucket is a number of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", STEP):
                texts = _bytes(rows.column("text"))
                ends = np.cumsum([len(t) for t in texts])
                found = anchor_runs(np.frombuffer(b"".join(texts), dtype=np.uint8), ends)
                first, (text, start, stop) = own_repeats(found)
                n, zero = len(text), np.zeros(len(text), dtype=np.int64)
                alone = mix(start.astype(np.uint64) + np.uint64(1), text.astype(np.uint64) + np.uint64(len(ends))).view(np.int64)

                def column(name: str, own: np.ndarray, kind: pa.DataType) -> pa.Array:
                    return pa.array(np.concatenate([found[name][first], own]), kind)

                of = column("text", text, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(of), rows.column("tie").take(of), column("at", start, pa.int32()),
                     column("before", zero, pa.int16()), column("after", start - stop + LENGTH, pa.int32()),
                     column("bucket", alone, pa.int64()), column("run", zero, pa.int64()),
                     pa.array(np.concatenate([np.zeros(first.sum(), dtype=bool), np.ones(n, dtype=bool)]))],
                    ["doc_id", "tie", "at", "before", "after", "bucket", "run", "own"])

    return docs.mapInArrow(
        run, f"doc_id {kind}, tie bigint, at int, before smallint, after int, bucket bigint, run bigint, own boolean")


def sorted_buckets(found: DataFrame) -> DataFrame:
    """Anchors of buckets with several members: ``whole`` for repeats of the same run, ``kinds`` different runs.

    ``own`` rows are in no bucket with others and come out as they are.
    """
    bucket = Window.partitionBy("bucket", "own")
    inside = bucket.orderBy("run", *ID, "at")
    return (
        found.withColumn("whole", F.col("own") | F.coalesce(F.lag("run").over(inside) == F.col("run"), F.lit(False)))
        .withColumn("kinds", F.count(F.when(~F.col("whole"), 1)).over(bucket))
        .where("whole or kinds > 1").drop("run", "own")
    )


def crowded_buckets(found: DataFrame) -> DataFrame:
    """The same for buckets that would be too much for a task: firsts by grouping, the others by a join."""
    runs = stored(found, "crowded")
    place = F.struct(*ID, "at")
    firsts = stored(runs.groupBy("bucket", "run").agg(
        F.min(place).alias("first"), F.first("before").alias("before"), F.first("after").alias("after")), "firsts")
    whole = runs.join(firsts.select("bucket", "run", "first"), ["bucket", "run"]).where(place != F.col("first"))
    kinds = firsts.groupBy("bucket").agg(F.count("*").alias("kinds"))
    left = firsts.join(kinds, "bucket").where("kinds > 1").select("first.*", "before", "after", "bucket", F.lit(False).alias("whole"), "kinds")
    return left.unionByName(whole.select(*ID, "at", "before", "after", "bucket", F.lit(True).alias("whole"), F.lit(1).cast("long").alias("kinds")))


def buckets(docs: DataFrame, kind: str) -> DataFrame:
    """Anchors that repeat as a whole, and those of buckets with several different runs.

    A look at one in LOOKED_AT documents tells which buckets are crowded. That settles only how they are
    worked through, not what comes out.
    """
    looked_at = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(LOOKED_AT)) == 0)
    sizes = anchors(looked_at, kind).where("not own").groupBy("bucket", "own").agg(F.count("*").alias("n"))
    many = stored(sizes.where(F.col("n") >= CROWDED).select("bucket", "own"), "crowds")
    found = anchors(docs, kind)
    if many.isEmpty():
        return sorted_buckets(found)
    keys = ["bucket", "own"]
    return sorted_buckets(found.join(many, keys, "left_anti")).unionByName(crowded_buckets(found.join(many, keys, "left_semi")))


def surroundings(docs: DataFrame, open_runs: DataFrame, kind: str) -> DataFrame:
    """The bytes of each open run's strings, from ``before`` bytes left of the anchor."""
    wanted = open_runs.groupBy(*ID).agg(F.collect_list(F.struct("at", "before", "after", "bucket", "kinds")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", STEP):
                out: list[tuple] = []
                for doc, tie, text, runs in zip(*(rows.column(c) for c in ("doc_id", "tie", "text", "runs"))):
                    data, doc, tie = text.as_py().encode("utf-8", "surrogatepass"), doc.as_py(), tie.as_py()
                    for r in runs.as_py():
                        at, before, after = r["at"], r["before"], r["after"]
                        out.append((doc, tie, at, before, after, r["bucket"], r["kinds"], data[at - before : at - after + LENGTH]))
                columns = list(zip(*out)) if out else [[]] * 8
                kinds = (rows.schema.field("doc_id").type, pa.int64(), pa.int32(), pa.int16(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    ["doc_id", "tie", "at", "before", "after", "bucket", "kinds", "data"])

    joined = docs.join(wanted, [docs["doc_id"].eqNullSafe(wanted["doc_id"]), docs["tie"] == wanted["tie"]]) \
        .select(docs["doc_id"], docs["tie"], "text", "runs")
    return joined.mapInArrow(run, f"doc_id {kind}, tie bigint, at int, before smallint, after int, bucket bigint, kinds bigint, data binary")


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def repeats_in_bucket(members: list[tuple[int, int, bytes]]) -> list[tuple[int, int, int]]:
    """(member, least offset, greatest offset) of strings that an earlier member has at the same offset.

    Members (before, after, data) come in document order; an offset is the anchor's place in the string.
    """
    out = []
    if len(members) > PAIRS_UP_TO:
        met: set[bytes] = set()
        for i, (before, after, data) in enumerate(members):
            since = None
            for offset in range(after, before + 1):
                string = xxh3_128_digest(data[before - offset : before - offset + LENGTH])
                if string in met:
                    since = offset if since is None else since
                else:
                    met.add(string)
                    if since is not None:
                        out.append((i, since, offset - 1))
                        since = None
            if since is not None:
                out.append((i, since, before))
        return out
    cut = [(before, after, data[:before][::-1], data[before:]) for before, after, data in members]
    for i, (before, after, left, right) in enumerate(cut):
        for other_before, other_after, other_left, other_right in cut[:i]:
            low = max(after, other_after, LENGTH - common_prefix(right, other_right))
            high = min(before, other_before)
            if low <= high:
                high = min(high, common_prefix(left, other_left))
                if low <= high:
                    out.append((i, low, high))
                    if (low, high) == (after, before):
                        break
    return out


def compared(surrounded: DataFrame, kind: str) -> DataFrame:
    """(doc_id, tie, start, stop) of repeated bytes in buckets of few different runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "tie", "at", "before", "after", "data")))

        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * 4
            kinds = (doc_type, pa.int64(), pa.int32(), pa.int32())
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "tie", "start", "stop"])
            out.clear()
            return made

        doc_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
        for _, group in groupby(rows(), key=lambda r: r[0]):
            members = list(group)
            for i, low, high in repeats_in_bucket([(r[4], r[5], r[6]) for r in members]):
                _, doc, tie, at, _, _, _ = members[i]
                out.append((doc, tie, at - high, at - low + LENGTH))
            if len(out) >= 20_000:
                yield flush()
        yield flush()

    few = surrounded.where(F.col("kinds") <= GROUP_UP_TO).repartition("bucket").sortWithinPartitions("bucket", *ID, "at")
    return few.select("bucket", *ID, "at", "before", "after", "data").mapInArrow(run, f"doc_id {kind}, tie bigint, start int, stop int")


def spread_out(surrounded: DataFrame, kind: str) -> DataFrame:
    """The same for buckets of many different runs: every string is a row, equal ones meet by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                of, starts, keys = [], [], []
                for n, (place, before, after, data) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("at", "before", "after", "data")))):
                    for k in range(before - after + 1):
                        of.append(n)
                        starts.append(place - before + k)
                        keys.append(xxh3_128_digest(data[k : k + LENGTH]))
                taken = pa.array(of, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(taken), rows.column("tie").take(taken), pa.array(starts, pa.int32()), pa.array(keys, pa.binary())],
                    ["doc_id", "tie", "start", "string"])

    many = surrounded.where(F.col("kinds") > GROUP_UP_TO).select(*ID, "at", "before", "after", "data")
    strings = stored(many.mapInArrow(run, f"doc_id {kind}, tie bigint, start int, string binary"), "strings")
    first = strings.groupBy("string").agg(F.min(F.struct(*ID, "start")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = strings.join(first, "string").where(F.struct(*ID, "start") != F.col("first"))
    return again.select(*ID, "start", (F.col("start") + LENGTH).alias("stop"))


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, start, stop): byte ranges to remove; they may touch and overlap."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    told = with_tie(docs)
    texts = each_once(told.where(F.octet_length("text") >= LENGTH))
    found = stored(buckets(texts, kind), "buckets")
    whole = found.where("whole").select(
        *ID, (F.col("at") - F.col("before")).alias("start"), (F.col("at") - F.col("after") + LENGTH).alias("stop"))
    surrounded = stored(surroundings(texts, found.where("not whole"), kind), "surroundings")
    return whole.unionByName(compared(surrounded, kind)).unionByName(spread_out(surrounded, kind))


def kept_bytes(data: bytes, ranges: list[tuple[int, int]]) -> tuple[list[bytes], int, int]:
    """The pieces that stay, the bytes removed, and the number of maximal removed runs."""
    pieces, removed, runs, at, stop = [], 0, 0, 0, -1
    for start, end in sorted(ranges):
        if start > stop:
            pieces.append(data[at:start])
            runs += 1
            stop = start
        if end > stop:
            removed += end - stop
            stop = end
            at = end
    pieces.append(data[at:])
    return pieces, removed, runs


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept`` (binary: the remaining bytes) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    told = with_tie(docs)
    ranges = stored(repeated(docs), "ranges").groupBy(*ID).agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", STEP):
                out = []
                for data, cut in zip(_bytes(rows.column("text")), rows.column("ranges")):
                    pieces, removed, runs = kept_bytes(data, [(r["start"], r["stop"]) for r in cut.as_py() or ()])
                    kept = b"".join(pieces)
                    out.append((len(data), removed, runs, hashlib.sha256(kept).hexdigest(), kept))
                columns = list(zip(*out)) if out else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = told.join(ranges, [told["doc_id"].eqNullSafe(ranges["doc_id"]), told["tie"] == ranges["tie"]], "left")
    return joined.select(told["doc_id"], "text", "ranges").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
