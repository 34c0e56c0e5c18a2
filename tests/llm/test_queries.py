"""Every registered query of the subpackage over the smallest tables, against brute force or the library it stands for."""

from __future__ import annotations

import hashlib
import re
from html import unescape
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tests_llm_brute import base_spans, leaks, near_components, nearest, removed_bytes, simhash_components
from tokenizers import Tokenizer

from gritstone.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def rows(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def test_op1(spark, documents):
    got = rows(spark, "op1_hypergeometric_sharding")
    texts = dict(documents)
    assert len(got) == len(documents)
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, crc32(data), "rows", None)
    for shard in range(16):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) in (len(got) // 16, -(-len(got) // 16))


def test_op2(spark, documents):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows(spark, "op2_substring_dedup")}
    assert got == removed_bytes(documents)
    assert sum(x[1] for x in got.values())


def test_op3(spark, documents):
    texts = dict(documents)
    for r in rows(spark, "op3_secret_scan"):
        expected = base_spans(texts[r.doc_id] or "")
        listed = [f"{k}:{a}:{b}" for k, a, b in expected]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[0] == k for x in expected) for k in ("assign", "access", "hex")]
        assert set(listed) <= set(r.spans.split(","))


def test_op4(spark):
    got = rows(spark, "op4_language_id")
    assert np.mean([r.language == r.declared for r in got]) > 0.98
    pages = rows(spark, "page_languages")
    assert len(pages) == 50 and np.mean([r.language == r.declared for r in pages]) > 0.9


def test_op5(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = rows(spark, "op5_html_extraction")
    assert len(got) == len(pages)
    for r in got:
        article = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]+>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_op6(spark, documents):
    from gritstone.llm.paragraphs import WORD, passages

    listed, texts, seen = [], {}, {}
    for doc, text in sorted(documents):
        own = WORD.findall((text or "").lower())
        for place, stop, *_ in passages(text or "")[0]:
            passage = " ".join(own[place:stop])
            listed.append((doc, (place, stop), passage))
            seen.setdefault(passage, len(seen))
    root = near_components({n: passage for passage, n in seen.items()})
    first, expected = {}, {}
    for doc, place, passage in listed:
        if first.setdefault(root[seen[passage]], doc) != doc:
            expected.setdefault(doc, []).append(place)
    found = rows(spark, "op6_paragraph_dedup")
    got = {r.doc_id: [tuple(x) for x in r.removed] for r in found if r.n_removed}
    assert got == expected and got
    runs, shared = set(), set()
    for doc, text in sorted(documents):
        own = WORD.findall((text or "").lower())
        mine = {tuple(own[n : n + 50]) for n in range(len(own) - 49)}
        shared |= {doc} if mine & runs else set()
        runs |= mine
    assert shared and shared <= got.keys()


def test_op7(spark, documents):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op7_simhash")}
    assert got == simhash_components(documents)


def test_op8(spark):
    table = {r.vec_id: r.embedding for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    ids = sorted(table)
    points = np.array([table[i] for i in ids], dtype=float)
    exact = nearest(ids, points, [i for i in ids if i % 50 == 0])
    got = {}
    for r in sorted(rows(spark, "op8_neighbours"), key=lambda r: (r.query_id, r.rank)):
        a, b = points[ids.index(r.query_id)], points[ids.index(r.vec_id)]
        assert abs(r.score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got.keys() == exact.keys() and all(len(x) == 5 for x in got.values())
    assert np.mean([v in got[q] for q in exact for v in exact[q]]) >= 0.9


def test_op9(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in rows(spark, "op9_decontamination")}
    assert got == leaks(documents, items)


def test_op10(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = dict(documents)
    for r in rows(spark, "op10_bpe"):
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pipeline(spark, documents):
    import corpus_pipeline
    from gritstone.llm.secrets import redact, spans

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    texts = {doc: text for doc, text in documents if any(c.isalpha() for c in text or "")}
    kept = {doc for doc, root in near_components(texts).items() if doc == root}
    kept -= {doc for doc, _ in leaks([(d, texts[d]) for d in kept], items)}
    expected = {doc: redact(texts[doc], spans(texts[doc])) for doc in kept}
    got = corpus_pipeline.run(spark, FOLDER)
    names = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert got.columns[: len(names)] == names
    found = got.collect()
    assert {r.doc_id: r.text for r in found} == expected and len(found) == len(expected)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in found:
        assert r.ids == library.encode(r.text, add_special_tokens=False).ids and r.n_tokens == len(r.ids) and r.n_chars == len(r.text)
