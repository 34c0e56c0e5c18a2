"""Fill-in-the-middle, license scan and whitening against plain versions, and at their edges."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import product

import numpy as np
import pytest

from gritstone.llm import fim, licenses, whitening
from gritstone.llm.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
SHA = lambda text: hashlib.sha256(text.encode()).hexdigest()


def cut(doc_id, text, seed=7, rate=100, spm_rate=50, unit=r"[^\n]*\n|[^\n]+"):
    """(n, form, prefix, middle, suffix, output) of the contract, by slicing a list of units."""
    text = text or ""
    units = re.findall(unit, text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", pre, mid, suf, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", pre, mid, suf, f"<P>{pre}<S>{suf}<M>{mid}"


def test_fim_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op13_fill_in_middle"](spark, FOLDER).collect()
    assert len(got) == len(texts) and {r.form for r in got} >= {"psm", "spm"}
    for r in got:
        n, form, pre, mid, _, output = cut(r.doc_id, texts[r.doc_id])
        sizes = (None, None) if form == "plain" else (len(pre), len(mid))
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (
            n, form, *sizes, SHA(output), SHA(texts[r.doc_id] or ""))


def test_fim_edges(spark):
    draw = random.Random(3)
    texts = [None, "", "\n", "\n\n\n", "one line", "a<P>b", "<S", "x <S>", "<M>", "$1 \\ \\$2\n$0", "a\r\nb\rc\u2028d", "é🙂\n🙂🙂\nü", "<\n<S\n<P\nM>\n",
             "line\n" * 60_000, "y" * 400_000, "".join(draw.choice("<PSM>\n$\\") for _ in range(300))]
    rows = [(k % 40 or None, t, "mine", 5) for k, t in enumerate(t for t in texts for _ in range(4))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, form string, _text int").repartition(3)
    got = fim.with_parts(fim.fill_in_middle(frame))
    assert got.columns == ["doc_id", "text", "_text", "n", "form", "output", "prefix", "middle", "suffix", "restored"]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n, r.form, r.prefix, r.middle, r.suffix, r.output) == cut(r.doc_id, r.text) and r.restored == (r.text or "")
    words = fim.Draw(seed=1, rate=50, spm_rate=0)
    for r in fim.fill_in_middle(frame, draw=words, unit=r"[^ ]*+ |[^ ]++").collect():
        assert (r.n, r.form, r.output) == (lambda c: (c[0], c[1], c[5]))(cut(r.doc_id, r.text, 1, 50, 0, r"[^ ]* |[^ ]+"))
    assert fim.fill_in_middle(frame.limit(0)).count() == 0
    named = fim.fill_in_middle(spark.createDataFrame([("k", "a\nb", 1)], "id string, n string, output int"), key="id", text="n").first()
    assert named.asDict().keys() == {"id", "n", "form", "output"} and named.n == 2 and named.output == cut("k", "a\nb")[5]


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return low, re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def licensed(text, templates=licenses.TEMPLATES, threshold=licenses.THRESHOLD):
    low, words = words_of(text)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        here = [k for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        places += here
        base |= {label} if here else set()
    paragraphs, lines = [[]], low.split("\n")
    for line in lines:
        paragraphs[-1].append(line) if words_of(line)[1] else paragraphs.append([])
    blocks = {"line": [set(words_of(x)[1]) for x in lines], "paragraph": [set(words_of(" ".join(p))[1]) for p in paragraphs]}
    found, best = set(base), 1.0 if places else 0.0
    for kind, some in blocks.items():
        for block in some:
            met = [(t.label, set(t.words)) for t in templates if t.kind == kind and t.words and len(block & set(t.words)) >= threshold * len(t.words) - 1e-9]
            for label, own in met:
                if not any(own < other for _, other in met):
                    found.add(label)
                    best = max(best, len(block & own) / len(own))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(found)), best


def license_row(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score


def test_license_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = QUERIES["op12_license_scan"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(texts) and {"gpl,gpl-3.0", "cc-by,cc-by-nc-4.0", "mit"} <= {r.labels for r in got}
    for r in got:
        assert license_row(r) == licensed(texts[r.doc_id])


def test_license_edges(spark):
    draw = random.Random(5)
    mit = next(t for t in licenses.TEMPLATES if t.label == "mit" and t.kind == "paragraph").text
    gpl = next(t for t in licenses.TEMPLATES if t.label == "gpl-3.0").text
    commented = "code\n#\n# " + mit.replace("\n", "\n# ") + "\n#\nmore"
    lacking = mit.replace("sublicense", "x").replace("merge", "x")
    far = mit.replace("sublicense", "x").replace("merge", "x").replace("furnished", "x").replace("deal", "x").replace("granted", "x").replace("charge", "x")
    apart = mit.replace("\n", "\n\n", 1)
    texts = [None, "", " .!\n\n", "CC BY cc-by CC\nBY", "cc bye xcc by", "All rights reserved", "all rights reserved" * 2, "general public license " * 3, "CC\u212a BY \u0130",
             commented, lacking, far, apart, gpl, gpl.replace("GNU", ""), gpl.replace("GNU", "GNU Lesser"), gpl + "\u00e9", "É cc by É", "word " * 50_000 + gpl,
             mit.replace("\n", " "), ("\n".join([gpl] * 500))]
    vocabulary = sorted({w for t in licenses.TEMPLATES for w in t.words})
    texts += [" ".join(draw.choice(vocabulary) for _ in range(draw.choice((5, 20, 200, 900)))) for _ in range(40)]
    rows = [(k, t, "mine", 3) for k, t in enumerate(texts)] + [(None, gpl, None, None), (13, gpl, "mine", 3)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, labels string, row int").repartition(4)
    found = licenses.find_licenses(frame)
    assert found.columns == ["doc_id", "row", *licenses.ADDED]
    got = found.collect()
    by_id = {k: t for k, t, _, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        assert license_row(r) == licensed(by_id[r.doc_id]), by_id[r.doc_id][:80]
    assert "mit" in licensed(lacking)[5] and "mit" not in licensed(far)[5] and "mit" in licensed(commented)[5]
    assert licenses.find_licenses(frame.limit(0)).count() == 0
    own = [licenses.Template("x", "line", "alpha beta gamma delta"), licenses.Template("y", "line", "beta gamma epsilon"), licenses.Template("z", "paragraph", "!!")]
    small = spark.createDataFrame([(" ".join(c),) for c in product(("alpha", "beta", "q"), ("gamma", "delta", "beta"), ("epsilon", "gamma", "delta"))], "t string")
    for threshold in (0.5, 0.8, 1.0):
        rows = licenses.find_licenses(small.withColumn("own", small.t), "t", own, threshold).collect()
        assert len(rows) == 27 and all(license_row(r) == licensed(r.own, own, threshold) for r in rows)
    assert {r.labels for r in licenses.find_licenses(small, "t", []).collect()} == {""}


def test_license_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = licenses.find_licenses(docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def whitened(rows, components=4, scale=256):
    """Distinct integer vectors' exact sums, and numpy's eigenvectors of their covariance."""
    x = {key: [int(np.floor(scale * c)) for c in v] for key, v in rows}
    distinct = sorted({tuple(v) for v in x.values()})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[float(n * a - s) / n for a, s in zip(v, sums)] for v in distinct])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    chosen = [k for k in np.argsort(-values)[:components] if values[k] > 1e-9 * values.sum()]
    scores = {k: [(np.array([float(n * a - s) / n for a, s in zip(v, sums)]) @ axes[:, c]) / values[c] ** 0.5 for c in chosen] for k, v in x.items()}
    exact = {k: sum((n * a - s) ** 2 for a, s in zip(v, sums)) for k, v in x.items()}
    return n, exact, scores, [values[c] / values.sum() for c in chosen]


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    n, exact, scores, shares = whitened(rows)
    got = QUERIES["op11_whitening"](spark, FOLDER).collect()
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n}
    assert all(r.deviation == exact[r.vec_id] and abs(r.explained - shares[r.component - 1]) < 1e-9 and r.identity_error < 1e-12 for r in got)
    for c in range(4):
        mine = np.array([r.whitened for r in got if r.component == c + 1])
        theirs = np.array([scores[r.vec_id][c] for r in got if r.component == c + 1])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-9


def test_characteristic_polynomial(spark):
    for width, seed in ((1, 0), (2, 1), (5, 2), (9, 3)):
        half = np.random.default_rng(seed).integers(-10**9, 10**9, (width, max(1, width - seed % 2))).astype(object)
        matrix = half.dot(half.T)
        found = whitening.characteristic_polynomial(spark, matrix)
        power, expected = np.eye(width, dtype=int).astype(object), [1]  # Faddeev and LeVerrier
        for k in range(1, width + 1):
            product_ = matrix.dot(power)
            expected.append(-int(sum(product_.diagonal())) // k)
            power = product_ + expected[-1] * np.eye(width, dtype=int).astype(object)
        assert found == expected[::-1]


def test_roots():
    def polynomial(roots):
        c = [1]
        for r in roots:
            c = [a - r * b for a, b in zip([0, *c], [*c, 0])]
        return c

    roots = [10**30 + 1, 10**30, 7, 7, 7, 1, 0, 0]
    p = polynomial(roots)
    assert [whitening.roots_above(p, x) for x in (-1, 0, 1, 6, 7, 10**30, 10**30 + 1)] == [8, 6, 5, 5, 2, 1, 0]
    found = whitening.largest_roots(p, sum(roots), 6)
    assert [m for _, m, _ in found] == [1, 1, 3, 1]
    assert [-(-(low + 1) >> shift) for low, _, shift in found] == [10**30 + 1, 10**30, 7, 1]


def test_whitening_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0, -2.0]), (2, [0.5, 1.0, -2.0]), (3, [1.5, -1.0, 0.25]), (4, [0.0, -0.0, 3.0]), (4, [0.0, -0.0, 3.0]), (None, [2.0, 1.0, 1.0]),
            (5, None), (6, [nan, 1.0, 1.0]), (7, [inf, 0.0, 0.0]), (8, [1.0, None, 2.0]), (9, []), (10, [1.0, 2.0]), (11, [-0.001, 0.0, 7.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    kept = [r for r in rows if r[0] in (1, 2, 3, 4, None, 11)]
    n, exact, scores, _ = whitened(kept)
    clash = frame.selectExpr("*", "1 AS row", "'y' AS x", "'s' AS scores", "2 AS n")
    found, model, error = whitening.whiten(clash)
    assert found.columns == ["vec_id", "row", "x", "n", "deviation", "scores"] and len(model.roots) == 3 and error < 1e-9
    got = found.collect()
    assert len(got) == len(kept) and n == 5
    assert all(r.deviation == exact[r.vec_id] and np.allclose(np.abs(r.scores), np.abs(scores[r.vec_id])) for r in got)
    assert whitening.by_component(frame.limit(0), "vec_id").count() == 0
    assert whitening.by_component(frame.where("vec_id <= 2"), "vec_id").count() == 0
    flat = spark.createDataFrame([(k, [float(k), 2.0 * k, 5.0]) for k in range(6)], "vec_id bigint, embedding array<float>")
    assert {(r.component, r.explained) for r in whitening.by_component(flat, "vec_id").collect()} == {(1, 1.0)}
    equal = spark.createDataFrame([(2 * k + s, [float((2 * s - 1) * (j == k)) for j in range(4)]) for k in range(4) for s in range(2)], "vec_id bigint, embedding array<float>")
    found, model, error = whitening.whiten(equal)
    assert error < 1e-12 and np.allclose(np.array(model.vectors) @ np.array(model.vectors).T, np.eye(4)) and len(set(model.roots)) == 1
    big = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [1e15, -5.0]), (4, [3.0, 1e-300])], "vec_id bigint, embedding array<double>")
    found, model, error = whitening.whiten(big)
    assert error < 1e-9 and found.count() == 4 and found.where("deviation is null").count() >= 2


def test_close_roots_have_their_own_vectors():
    turn = np.array([[3, 4, 0], [-4, 3, 0], [0, 0, 5]], dtype=object)
    matrix = turn.T.dot(np.diag(np.array([10**40 + 1, 10**40, 5], dtype=object))).dot(turn)  # roots times 25
    trace = int(sum(matrix.diagonal()))
    a, b, c = (25 * r for r in (10**40 + 1, 10**40, 5))
    polynomial = [-a * b * c, a * b + b * c + a * c, -trace, 1]
    found = whitening.largest_roots(polynomial, trace, 2)
    vectors = [whitening.null_space(matrix, low, shift, m)[0] for low, m, shift in found]
    assert np.allclose(np.abs(vectors), [[0.6, 0.8, 0.0], [0.8, 0.6, 0.0]], atol=1e-15)


@pytest.mark.parametrize("bits", [10, 40, 62])
def test_exact_products(bits):
    x = np.random.default_rng(bits).integers(-(2**bits), 2**bits, (5000, 3))
    assert (whitening.exact_products(x) == x.astype(object).T.dot(x.astype(object))).all()
    for value in (0, 5, -5, 2**60, -(2**60), 2**130 + 3, -(2**130)):
        assert sum(part << (whitening.LIMB * place) for place, part in whitening.limbs(value)) == value
