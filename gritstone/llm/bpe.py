"""Byte-pair encoding and decoding with a published word vocabulary.

Every word is encoded once per Python worker by a contiguous rank array: the word's parts
lie in a row, ``ranks[i]`` is the merge rank of parts i and i+1, the smallest rank is looked
up by a scan, its boundary deleted and the two neighbouring ranks refreshed. Words of more than
SCAN_PARTS parts take the smallest rank from a heap instead (same order: rank, then place), since
repeated scans of a long run would take quadratic time. No rows move between tasks.

Null and empty texts encode to no ids and decode to the empty string. All columns of the input
that do not clash with the added ones are kept; clashing ones are replaced. Repeated rows stay.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from tokenizers import Tokenizer

SCAN_PARTS = 64
#: Words kept by a worker; beyond it the memory is emptied and refilled (a speed matter only).
MEMORY_WORDS = 300_000

# The split pattern of the vocabulary file, and the letters for which
# every Unicode version agrees with the tokenizer's own tables.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
UNUSUAL = regex.compile(r"[^\x00-ԯ -⁣₠-₵℀-↋]")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordEncoder:
    """The merges of one vocabulary file, and the words met so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.vocab: dict[str, int] = dict(model["model"]["vocab"])
        self.suffix: str = model["model"]["end_of_word_suffix"] or ""
        self.specials = {x["content"]: x["id"] for x in model["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.specials.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.vocab[left], self.vocab[right]] = (rank, self.vocab[left + right])
        letters = byte_letters()
        self.inner = [self.vocab[x] for x in letters]
        self.last = [self.vocab[x + self.suffix] for x in letters]
        self.of_letter = {x: b for b, x in enumerate(letters)}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.library = Tokenizer.from_file(path)
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, parts: list[int]) -> list[int]:
        return self.merge_scanning(parts) if len(parts) <= SCAN_PARTS else self.merge_heap(parts)

    def merge_scanning(self, parts: list[int]) -> list[int]:
        get, none = self.merges.get, (1 << 60, -1)
        ranks = [get(pair, none) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least is none or least[1] < 0:
                break
            at = ranks.index(least)
            parts[at : at + 2] = [least[1]]
            del ranks[at]
            if at:
                ranks[at - 1] = get((parts[at - 1], parts[at]), none)
            if at < len(ranks):
                ranks[at] = get((parts[at], parts[at + 1]), none)
        return parts

    def merge_heap(self, parts: list[int]) -> list[int]:
        n, get = len(parts), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, parts[i], parts[i + 1], m[1]) for i in range(n - 1) if (m := get((parts[i], parts[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (m := get((parts[a], parts[b]))):
                    heapq.heappush(heap, (m[0], a, parts[a], parts[b], m[1]))
        return [p for p in parts if p >= 0]

    def word(self, word: str) -> tuple[int, ...]:
        data = word.encode("utf-8", "surrogatepass")
        ids = tuple(self.merge([self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]))
        if len(self.known) >= MEMORY_WORDS:
            self.known.clear()
        if len(word) <= SCAN_PARTS:
            self.known[word] = ids
        return ids

    def words(self, text: str) -> list[str]:
        if UNUSUAL.search(text) is None:
            text = unicodedata.normalize("NFC", text)
            return WORD.findall((text.replace("Σ", "σ") if "Σ" in text else text).lower())
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.of_letter[x] for x in piece).decode("utf-8") for piece, _ in pieces]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.split.split(text) if self.split and "<|" in text else [text]:
            if part in self.specials:
                out.append(self.specials[part])
                continue
            get, word = self.known.get, self.word
            for w in self.words(part):
                out += get(w) or word(w)
        return out

    def decode(self, ids: list[int]) -> str:
        """The vocabulary file names no decoder: tokens as they stand, joined by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


#: Characters a task encodes before it hands rows on: ids and decoded text take several times as much.
STEP_CHARS = 2_000_000


def encode_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (array of int) and ``decoded`` (string) for the whole of ``text``."""
    kept = docs.drop("ids", "decoded")
    schema = StructType([*kept.schema.fields, StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())])
    names = kept.columns

    def flush(rows: pa.RecordBatch, ids: list[np.ndarray], decoded: list[str]) -> pa.RecordBatch:
        ends = np.zeros(len(ids) + 1, dtype=np.int32)
        np.cumsum([len(x) for x in ids], out=ends[1:])
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
        columns = [*rows.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(decoded, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[*names, "ids", "decoded"])

    def run(batches):
        tokenizer = encoder(path)
        for batch in batches:
            ids, decoded, start, size = [], [], 0, 0
            for at, value in enumerate(batch.column(text)):
                found = tokenizer.encode(value.as_py() or "")
                ids.append(np.array(found, dtype=np.int32))
                decoded.append(tokenizer.decode(found))
                size += len(decoded[-1])
                if size >= STEP_CHARS:
                    yield flush(batch.slice(start, at + 1 - start), ids, decoded)
                    ids, decoded, start, size = [], [], at + 1, 0
            if ids:
                yield flush(batch.slice(start), ids, decoded)

    return kept.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids in decimal joined by spaces and of the decoded text."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
