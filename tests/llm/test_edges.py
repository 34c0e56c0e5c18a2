"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import base64
import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tests_llm_brute import Sets, leaks, near_components, nearest, removed_bytes, simhash_components
from tokenizers import Tokenizer

from gritstone.llm import (
    bpe, copies, decontamination, htmltext, language, neighbours, paragraphs, secrets, sharding, simhash, substrings, words as wording)

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed, n, letters="abcdefgh"):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(letters) for _ in range(draw.randint(2, 7))) for _ in range(n))


LONG = words(1, 30_000)
BASE = words(2, 120)
ROWS = [
    (1, None, "en", "a", 0), (2, "", None, None, None), (3, BASE, "en", "a", None), (4, BASE, "en", None, 7),
    (4, BASE, "en", None, 7), (5, BASE.replace(" ", "\n", 3), None, "b.org", 3), (6, LONG, "xx", "b.de", 1),
    (7, " \t\n ", "en", "a", 4), (8, "!!! 123 ???", "de", "c", 11), (9, LONG[:5000] + " end", "en", "a", 5004),
    (10, "a" * 3000, "en", "a", 3000), (11, "é" * 200 + "🙂", "fr", "a", 201),
]
TEXTS = {r[0]: r[1] for r in ROWS}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_sharding(docs, none):
    clash = docs.selectExpr("*", "'x' AS shard", "1.5 AS slot", "0 AS part", "0 AS row", "0 AS payload")
    got = sharding.hypergeometric_shuffle(clash, 5, seed=3)
    assert got.columns == [*docs.columns, "part", "row", "payload", "shard", "slot"]
    found = got.collect()
    assert sorted((r.doc_id, r.text or "") for r in found) == sorted((r[0], r[1] or "") for r in ROWS)
    for shard in range(5):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) in (2, 3)
    assert sharding.hypergeometric_shuffle(none, 5).count() == 0


def test_hypergeometric_draws():
    rng = np.random.default_rng(0)
    drawn = [sharding.draw_hypergeometric(rng, 30, 70, 20) for _ in range(20_000)]
    expected = np.random.default_rng(1).hypergeometric(30, 70, 20, 20_000)
    assert abs(np.mean(drawn) - 6) < 0.05 and abs(np.std(drawn) - expected.std()) < 0.05
    assert sharding.draw_hypergeometric(rng, 5, 0, 3) == 3 and sharding.draw_hypergeometric(rng, 0, 9, 4) == 0
    big = sharding.draw_hypergeometric(rng, 2_000_000_000, 30_000_000_000, 8_000_000)
    assert abs(big - 500_000) < 5_000
    matrix = np.array(sharding.draw_matrix(rng, [10, 0, 7, 4], sharding.shard_sizes(21, 4)))
    assert matrix.sum(axis=1).tolist() == [10, 0, 7, 4] and matrix.sum(axis=0).tolist() == [6, 5, 5, 5]


def test_shuffle_is_uniform(spark):
    counts = np.zeros((6, 3))
    for seed in range(150):
        for r in sharding.hypergeometric_shuffle(spark.range(6).coalesce(2), 3, seed).collect() if seed < 12 else []:
            counts[r.id, r.shard] += 1
    assert counts.sum() == 72 and counts.min() >= 0 and (counts.sum(axis=0) == 24).all()


def test_substrings(docs, none, spark, monkeypatch):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.without_repeats(docs).collect()}
    assert got == removed_bytes(TEXTS.items())
    assert substrings.without_repeats(none).count() == 0
    passage = words(9, 40)
    draw = random.Random(4)
    rows = [(n, words(100 + n, draw.randint(0, 20)) + passage[draw.randint(0, 9) :] + words(300 + n, draw.randint(0, 20))) for n in range(40)]
    rows += [(50, passage * 3), (51, "ab" * 400), (52, "xy" + "ab" * 90), (53, passage[:99]), (54, passage[:100])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = removed_bytes(rows)
    for most, crowded in ((10_000, 2000), (2, 2000), (10_000, 2)):
        monkeypatch.setattr(substrings, "GROUP_UP_TO", most)
        monkeypatch.setattr(substrings, "CROWDED", crowded)
        monkeypatch.setattr(substrings, "LOOKED_AT", 1 if crowded == 2 else 64)
        found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.without_repeats(frame).collect()}
        assert found == expected
    nameless = spark.createDataFrame([(None, passage), (1, passage)], "doc_id bigint, text string")
    assert {(r.doc_id, r.n_removed) for r in substrings.without_repeats(nameless).collect()} == {(None, 0), (1, len(passage))}


def test_substrings_doubled_rows(spark, monkeypatch):
    passage = words(9, 40)
    rows = [(3, passage), (7, "before " + passage[20:] + " after"), (8, words(31, 60)), (9, passage + " " + passage), (10, "x" + passage[:150] + "y")]
    other = (3, words(32, 60))  # agrees with a doubled row in doc_id only
    frame = spark.createDataFrame(rows * 2 + rows[:3] + [other], "doc_id bigint, text string").repartition(3)
    expected = {**removed_bytes(rows)}
    for most, crowded in ((10_000, 2000), (1, 2000), (10_000, 2)):
        monkeypatch.setattr(substrings, "GROUP_UP_TO", most)
        monkeypatch.setattr(substrings, "CROWDED", crowded)
        monkeypatch.setattr(substrings, "LOOKED_AT", 1 if crowded == 2 else 64)
        found = [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in substrings.without_repeats(frame).collect()]
        alone = removed_bytes([other]).popitem()
        assert len(found) == 14 and set(found) == {*expected.items(), alone}
        assert expected[3][1] == expected[8][1] == alone[1][1] == 0


def test_secrets(docs, none):
    def der(tag, body):
        size = bytes([len(body)]) if len(body) < 128 else b"\x82" + len(body).to_bytes(2, "big")
        return bytes([tag]) + size + body

    key = der(0x30, der(2, b"\0") + b"".join(der(2, bytes(range(1, 30))) for _ in range(8)))
    token = ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in ({"alg": "HS256"}, {"sub": 1})) + ".c2ln"
    body = base64.b64encode(key).decode()
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{body[:64]}\n{body[64:]}\n-----END RSA PRIVATE KEY-----"
    kinds = lambda text: [k for k, _, _ in secrets.spans(text)]
    assert "pem" in kinds(f"x {pem} y") and "pem" not in kinds(pem.replace(body[:8], "AAAAAAAA"))
    assert "jwt" in kinds(token) and "jwt" not in kinds(token.replace(token[:12], "eyJhYmMiOjEy"))
    assert "key64" in kinds(body) and "key64" not in kinds(base64.b64encode(key[:-1] + b"\0\0").decode())
    assert "keyhex" in kinds(key.hex().upper()) and "hex" in kinds(key.hex())
    assert "hex" in kinds("0" * 32) and not kinds("0" * 31) and kinds("AKIA" + "A" * 12) == ["access"] and not kinds("AKIA" + "A" * 11)
    assert kinds("passWord: 'abcdefgh'") == ["assign"] and not kinds("password: secret:abcdefghi")
    assert not kinds("paſſword=abcdefgh") and secrets.spans("🙂🙂 token=abcdefgh")[0][1:] == (3, 17)
    found = secrets.find_secrets(docs.selectExpr("*", "1 AS spans"))
    assert found.columns == [*docs.columns, "spans"] and found.count() == len(ROWS)
    masked = secrets.without_secrets(docs.selectExpr("*", "7 AS extra"))
    assert masked.columns == [*docs.columns, "extra"]
    by_id = {r.doc_id: r.text for r in masked.collect()}
    assert by_id[1] is None and by_id[3] == BASE and by_id[10] == "[secret]"
    assert secrets.digests(secrets.find_secrets(none)).count() == 0


def test_secrets_however_they_start():
    kinds = lambda text: [k for k, _, _ in secrets.spans(text)]
    encode = lambda data: base64.b64encode(data).decode()
    openssh = b"openssh-key-v1\0" + bytes(range(60))
    pem = f"-----BEGIN OPENSSH PRIVATE KEY-----\n{encode(openssh)}\n-----END OPENSSH PRIVATE KEY-----\n"
    wrapped = encode(pem.encode())
    assert kinds(f"id: {wrapped}") == ["key64"] and not kinds(encode(pem.replace("b3Bl", "AAAA").encode()))
    assert "keyhex" in kinds(openssh.hex()) and "keyhex" in kinds(pem.encode().hex())
    escaped = json.dumps({"key": pem, "n": 1})
    assert "pem" in kinds(escaped) and "pem" in kinds(json.dumps(escaped)) and "pem" in kinds(pem.replace("\n", "\\r\\n"))
    url = lambda text: base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")
    for header in ('{"alg":"HS256"}', '{ "alg": "HS256"}', '{\n  "alg": "HS256"\n}', ' {"alg":"HS256"}'):
        token = f"{url(header)}.{url('{ }')}.c2ln"
        assert secrets.spans(f"see {token} there") == [("jwt", 4, 4 + len(token))]
        assert secrets.spans(f"a.example.{token}.{token}") == [("jwt", 10, 10 + len(token)), ("jwt", 11 + len(token), 11 + 2 * len(token))]
    assert secrets.spans(f"x-{url('{"alg":"HS256"}')}.{url('{}')}.")[0][:2] == ("jwt", 2)
    assert not kinds("one.two.three. www.example.org and " + "ey." * 2000)


def test_language(spark, docs, none):
    told = {r.doc_id: (r.language, r.accepted) for r in language.of_documents(docs).collect()}
    assert all(told[x] == ("und", False) for x in (1, 2, 7, 8))
    assert language.of_documents(none).count() == 0 and language.accepted_documents(none).columns == none.columns
    vocabulary = {"en": "the and with that tion ing".split(), "de": "der und schen keit lich ung".split(), "fr": "les que eaux ment oir des".split()}
    draw = random.Random(3)
    text = lambda lang, n: " ".join("".join(draw.choices(vocabulary[lang], k=2)) for _ in range(n))
    rows = [(n, text(lang, 40), lang, f"www.{lang}.example.org") for n, lang in enumerate(list(vocabulary) * 20)]
    rows += [(100, "ung", None, "www.de.example.org"), (101, None, "fr", None), (102, text("fr", 30), "en", None),
             (103, "zqxjk vwpfy " * 30, None, None), (104, "ly", None, "shop.fr")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    got = {r.doc_id: r.language for r in language.of_documents(frame).collect()}
    assert all(got[n] == rows[n][2] for n in range(60))
    assert (got[100], got[101], got[102], got[103], got[104]) == ("de", "und", "fr", "und", "fr")
    kept = language.accepted_documents(frame.selectExpr("*", "1 AS language", "2 AS declared"))
    assert kept.columns == [*frame.columns, "language", "declared"] and {r.doc_id for r in kept.collect()} == set(range(60)) | {100, 102, 104}
    pages = spark.createDataFrame(
        [(n, f"https://www.{lang}.example.org/{n}", f'<html lang="{lang}-XX"><body><article><p>{t}</p></article></body></html>')
         for n, t, lang, _ in rows[:60]] + [(70, None, None), (71, "http://x.de/", "<p>ungkeit lichder</p>")], "page_id int, url string, html string")
    found = {r.page_id: r.language for r in language.of_pages(pages).collect()}
    assert all(found[n] == rows[n][2] for n in range(60)) and found[70] == "und" and found[71] == "de"


def test_language_of_mostly_copied_texts(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 20)
    draw = random.Random(5)
    text = lambda letters, n: " ".join("".join(draw.choices(letters, k=4)) for _ in range(n))
    copied = text("abcde", 30)
    rows = [(n, copied if n >= 30 else text("abcde", 30), "en", "a") for n in range(6000)]
    rows += [(10_000 + n, text("vwxyz", 30), "de", "a") for n in range(30)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    languages, table = language.fit(frame.selectExpr("text", "lang AS declared"))
    assert languages == ["de", "en"]
    seen = {k: (table[:, k] > table[:, k].min()).sum() for k in range(2)}
    assert seen[1] > 0.8 * seen[0]  # English, too, is learned from SAMPLE different texts
    assert {r.doc_id: r.language for r in language.of_documents(frame).collect()} == {r[0]: r[2] for r in rows}


def test_every_language_is_learned(spark):
    draw = random.Random(6)
    tags = [f"{a}{b}" for a in "abcdefghij" for b in "qrstuvwxy"][:70]
    letters = {tag: draw.sample("abcdefghijklmnopqrstuvwxyz", 5) for tag in tags}
    rows = [(n, " ".join("".join(draw.choices(letters[tag], k=4)) for _ in range(60)), tag, None) for n, tag in enumerate(tags * 4)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    found = {r.doc_id: (r.language, r.accepted) for r in language.of_documents(frame).collect()}
    assert found == {r[0]: (r[2], True) for r in rows}


def test_html(spark):
    def page(n, main, extra=""):
        return (n, f"http://h.org/{n}", f"<html><head><title>t</title></head><body><header>Site</header><nav>Home<a>About</a></nav>{extra}"
                f"<div id='sidebar'>side</div>{main}<div class='comments'><p>nice post</p></div><form>f</form><footer>foot</footer></body></html>")

    bare = "<div>Share this story with all of your many friends now</div>"
    rows = [page(n, f"<article><header><h1>Title {n}</h1></header><p>Body&nbsp; one &amp; <b>two</b><br>three {n}<p>next<script>x='</p>'</script></article>") for n in range(3)]
    rows += [(10 + n, f"http://g.org/{n}", f"<body>{bare}<p>{words(n, 30)}</p>{bare}") for n in range(5)]
    rows += [(20 + n, f"http://k.org/{n}", f"<article><p>{words(50 + n, 30)}</p><p>{words(99, 12)}</p></article>") for n in range(6)]
    rows += [(30 + n, f"http://m.org/{n}", f"<article><p>{words(77, 30)}</p><p>{words(78, 30)}</p></article>") for n in range(6)]
    rows += [(40, None, None), (41, "", ""), (42, "http://z.org", "plain < text &lt;p&gt; <b"), (43, "http://z.org", f"<p>{LONG}</p>"), (43, "http://z.org", f"<p>{LONG}</p>")]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = htmltext.extract(frame.selectExpr("*", "1 AS text", "2 AS host", "3 AS keys"))
    assert set(got.columns) == {"page_id", "url", "keys", "text"}
    found = {r.page_id: r.text for r in got.collect()}
    assert got.count() == len(rows)
    assert [found[n] for n in range(3)] == [f"Title {n}\n\nBody one & two three {n}\n\nnext" for n in range(3)]
    assert [found[10 + n] for n in range(5)] == [words(n, 30) for n in range(5)]
    assert [found[20 + n] for n in range(6)] == [words(50 + n, 30) for n in range(6)]
    assert all(found[30 + n] == words(77, 30) + "\n\n" + words(78, 30) for n in range(6))
    assert found[40] == found[41] == "" and found[42] == "plain < text <p> <b" and found[43] == LONG
    assert htmltext.extract(frame.where("false")).count() == 0


def test_paragraphs(docs, none, spark):
    removed = {r.doc_id: r.n_removed for r in paragraphs.repeated_paragraphs(docs).collect() if r.n_removed}
    assert removed.keys() == {4, 5, 9} and all(n > 1 for n in removed.values())
    assert paragraphs.repeated_paragraphs(none).count() == 0 and paragraphs.tuned_bands(0.8, 3, 0.997) == 9
    line = words(5, 60)
    edited = line.replace(line.split()[30], "other", 1)
    short = "a short line that very many documents share with each other"
    rows = [(1, f"{line}\n{short}\n{words(6, 9)}", 0), (2, f"{short}\n{words(8, 40)}\n{edited}\n{words(9, 40)}", 0), (3, None, 0),
            (4, line, 1), (4, line, 1), (5, f"{short}\n{words(10, 50)}", 0), (6, f"{words(11, 30)} {words(11, 30)}", 0)]
    cleaned = sorted((r.doc_id, r.text or "", r.row) for r in
                     paragraphs.without_repeats(spark.createDataFrame(rows, "doc_id int, text string, row int")).collect())
    kept = {doc: text for doc, text, _ in cleaned}
    assert len(cleaned) == len(rows) and cleaned[3] == cleaned[4]
    assert [kept[n] for n in (1, 5, 6)] == [rows[0][1], rows[5][1], rows[6][1]] and kept[3] == ""
    assert kept[2] == rows[1][1].replace(edited + "\n", "") and kept[4] == ""


def test_a_shared_run_of_fifty_words_begins_a_passage_in_both():
    for seed in range(60):
        run = words(500 + seed, 50)
        texts = [f"{words(seed, 20 + seed)} {run} {words(900 + seed, 10 + seed)}", f"{words(700 + seed, 33)}\n{run}\n{words(800 + seed, 5)}"]
        one, two = ({x[2:] for x in paragraphs.passages(text)[0]} for text in texts)
        assert one & two


def test_passages_come_by_place_and_words_are_hashed_alike(monkeypatch):
    text = f"{words(41, 60)}\n{words(42, 30)} É\t\x0bÄ {'x' * 5000} {words(41, 60).upper()}\r\n\n{words(43, 23)}\n"
    found = [x[:2] for x in paragraphs.passages(text)[0]]
    assert found == sorted(found) and {(0, 60), (60, 153)} <= set(found)
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    for size in (1 << 20, 64):
        monkeypatch.setattr(wording, "STEP_BYTES", size)
        starts, hashes = wording.word_hashes(data)
        tokens = text.encode().lower().split()
        assert [data[n : n + len(x)].tobytes().lower() for n, x in zip(starts.tolist(), tokens)] == tokens and len(starts) == len(tokens)
        alike = dict(zip(tokens, hashes.tolist()))
        assert [alike[x] for x in tokens] == hashes.tolist() and len(set(alike.values())) == len(alike)


def test_passages_that_overlap_widely_are_looked_at_together(spark):
    own = LONG.split()
    starts = {x[0] for x in paragraphs.passages(LONG)[0][:-1]}
    for at in sorted(n for n in starts if n > 40 and n + 1 in starts):  # one document begins passages at both, the other only at the second
        rows = [(1, " ".join(own[at + 1 : at + 60])), (2, " ".join(own[at - 40 : at + 60]))]
        one, two = ({x[0]: x[2:] for x in paragraphs.passages(text)[0][::-1] if x[1] - x[0] == 24} for _, text in rows)
        if two.get(41) == one.get(0) and 40 in two:
            break
    else:
        raise AssertionError("no such passages")
    got = {r.doc_id: {tuple(x) for x in r.removed} for r in
           paragraphs.repeated_paragraphs(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[1] == set() and {(40, 64), (41, 65)} <= got[2]


def test_simhash(docs, none, spark, monkeypatch):
    expected = simhash_components([(k, v) for k, v in TEXTS.items()])
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    assert {r.doc_id: (format(r.fp % (1 << 64), "016x"), r.component_id) for r in got} == expected
    assert simhash.near_duplicates(none).count() == 0
    draw = random.Random(8)
    prints = {draw.getrandbits(64) - (1 << 63) for _ in range(30)}
    for fp in list(prints):
        for _ in range(20):
            near = fp % (1 << 64)
            for bit in draw.sample(range(64), draw.randint(0, 4)):
                near ^= 1 << bit
            prints.add(near - (1 << 64) if near >> 63 else near)
    frame = spark.createDataFrame([(x,) for x in prints], "fp bigint")
    from tests_llm_brute import Sets
    exact = Sets(prints)
    for a in prints:
        for b in prints:
            if a < b and bin((a ^ b) % (1 << 64)).count("1") <= 2:
                exact.join(a, b)
    for most in (64, 3):
        monkeypatch.setattr(simhash, "PAIRS_UP_TO", most)
        found = Sets(prints)
        for r in simhash.links(frame).collect():
            assert bin((r.a ^ r.b) % (1 << 64)).count("1") <= 2
            found.join(r.a, r.b)
        assert {x: exact.find(x) for x in prints} == {x: found.find(x) for x in prints}


def test_copies_pick_their_texts_once(docs, monkeypatch):
    texts, kept = [], copies.stored

    def recorded(frame, name, **options):
        out = kept(frame, name, **options)
        texts.extend([out] * ("text" in frame.columns and name != "crowded-texts"))
        return out

    compared_with, confirmed = [], copies.confirmed
    monkeypatch.setattr(copies, "stored", recorded)
    monkeypatch.setattr(copies, "confirmed", lambda pairs, held: compared_with.append(held) or confirmed(pairs, held))
    assert copies.one_of_each_group(docs).count() > 0
    assert len(texts) == 1 and compared_with
    assert all(sorted(x.inputFiles()) == sorted(texts[0].inputFiles()) for x in compared_with)


def test_copies(docs, none, spark, monkeypatch):
    got = copies.one_of_each_group(docs.selectExpr("*", "1 AS row", "2 AS words"))
    ids = sorted(r.doc_id for r in got.collect())
    assert ids == [1, 3, 6, 8, 9, 10, 11] and got.columns == [*docs.columns, "row", "words"]
    assert copies.one_of_each_group(none).columns == none.columns
    base, rows = words(21, 150), []
    draw = random.Random(2)
    for n in range(150):
        tokens = base.split()
        for at in draw.sample(range(150), draw.randint(0, 4)):
            tokens[at] = f"w{n}x{at}"
        rows.append((n, " ".join(tokens)))
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    roots = near_components(dict(rows))
    for rounds in (1, 3):
        monkeypatch.setattr(copies, "ROUNDS", rounds)
        kept = {r.doc_id for r in copies.one_of_each_group(frame).collect()}
        assert kept == {n for n in roots if roots[n] == n}


def test_fingerprints_are_searched_first(spark, monkeypatch):
    base = words(22, 400).split()
    rows = [(n, " ".join([*base[: 2 * n], f"x{n}", *base[2 * n + 1 :]])) for n in range(40)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    prints = {n: copies.signature(np.unique(simhash.shingle_hashes(t, 5)))[0] for n, t in rows}
    near = Sets(prints)
    for a in prints:
        for b in prints:
            if bin((prints[a] ^ prints[b]) % (1 << 64)).count("1") <= 2:
                near.join(a, b)
    linked = Sets(prints)
    signed = spark.createDataFrame([(n, [x, 0]) for n, x in prints.items()], "row bigint, sign array<bigint>")
    for r in copies.fingerprint_pairs(signed).collect():
        linked.join(r.a, r.b)
    assert {n: linked.find(n) for n in prints} == {n: near.find(n) for n in prints}
    groups = len({near.find(n) for n in prints})
    assert groups < 40
    monkeypatch.setattr(copies, "links", lambda filed, confirm, texts, found: found)  # without the wider blocks
    assert copies.one_of_each_group(frame).count() == groups


def test_crowded_files_move_texts(spark, monkeypatch):
    base, rows, draw = words(23, 150).split(), [], random.Random(3)
    for n in range(120):
        tokens = list(base)
        for at in draw.sample(range(150), draw.randint(2, 9)):
            tokens[at] = f"w{n}x{at}"
        rows.append((n, " ".join(tokens)))
    frame = spark.createDataFrame(rows, "row bigint, text string")
    signs = {n: copies.signature(np.unique(simhash.shingle_hashes(t, 5))) for n, t in rows}
    left = spark.createDataFrame([(1, n, signs[n], n) for n, _ in rows], "file bigint, row bigint, sign array<bigint>, part bigint")
    roots = near_components(dict(rows))
    for cell in (256, 16):  # one cell, and many
        monkeypatch.setattr(copies, "CELL", cell)
        found = Sets(roots)
        for r in copies.crowded_links(left, lambda wanted: frame.join(wanted, "row")).collect():
            found.join(r.a, r.b)
        assert {n: found.find(n) for n in roots} == roots and len(set(roots.values())) > 20


@pytest.mark.parametrize("kind", ["scattered", "truncated", "appended"])
def test_blocks_find_every_kind_of_edit(kind):
    draw, found, looked_at, met = random.Random(8), 0, 0, 0
    while met < 150:
        size = draw.randint(60, 400)
        tokens = [f"w{draw.randint(0, 5000)}" for _ in range(size)]
        other = list(tokens)
        if kind == "scattered":
            for at in draw.sample(range(size), max(1, size // 50)):
                other[at] = "changed"
        elif kind == "truncated":
            other = tokens[: int(size * draw.uniform(0.8, 0.9))]
        else:
            other += [f"x{n}" for n in range(int(size * draw.uniform(0.1, 0.22)))]
        one, two = (np.unique(simhash.shingle_hashes(" ".join(x), 5)) for x in (tokens, other))
        alike = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
        if not 0.8 <= alike < 0.9:
            continue
        met += 1
        found += bool(set(copies.block_values(one)) & set(copies.block_values(two)))
        looked_at += sum(bin((a ^ b) % (1 << 64)).count("1") for a, b in zip(copies.signature(one), copies.signature(two))) <= copies.MAX_DISTANCE
    assert found >= 0.97 * met and looked_at == met


def test_neighbours(spark):
    draw = np.random.default_rng(5)
    points = draw.normal(size=(300, 8))
    points[150:250] = points[7]
    table = {n: points[n].tolist() for n in range(300)}
    odd = {400: None, 401: [0.0] * 8, 402: [float("nan"), *[1.0] * 7], 403: [None, *[1.0] * 7], 404: [1.0] * 3, 405: [float("inf"), *[1.0] * 7]}
    rows = [(k, v, 1) for k, v in {**table, **odd}.items()] + [(3, table[3], 1), (None, table[4], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int")
    exact = nearest(list(table), points, [n for n in table if n % 50 == 0])
    got = {}
    for r in sorted(neighbours.nearest(frame, frame.where("vec_id % 50 = 0")).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got.keys() == exact.keys()
    assert np.mean([v in got[q] for q in exact for v in exact[q]]) >= 0.9 and got[150] == exact[150] == [7, 151, 152, 153, 154]
    few = frame.where("vec_id < 3")
    assert sorted((r.query_id, r["rank"]) for r in neighbours.nearest(few, few).collect()) == [(q, k) for q in range(3) for k in (1, 2)]
    assert neighbours.nearest(frame.where("false"), frame).count() == 0


def test_decontamination(docs, none, spark):
    items = [(1, " ".join(LONG.split()[500:530])), (2, "End"), (3, None), (4, "!!"), (5, BASE.upper()), (6, words(70, 20))]
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in decontamination.leaks(docs.selectExpr("*", "0 AS key", "0 AS w"), bench).collect()}
    assert got == leaks(TEXTS.items(), items) and (6, 1) in got and (9, 2) in got and (5, 5) in got
    left = decontamination.without_leaks(docs, bench)
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 7, 8, 10, 11] and left.columns == docs.columns
    assert decontamination.leaks(none, bench).count() == 0 and decontamination.leaks(docs, bench.where("false")).count() == 0
    assert decontamination.without_leaks(docs, bench.where("item_id > 2 AND item_id < 5")).count() == len(ROWS)


def test_bpe(docs, none):
    library = Tokenizer.from_file(VOCABULARY)
    clash = docs.selectExpr("*", "1 AS ids", "2 AS decoded", "3 AS extra")
    got = bpe.encode_decode(clash, VOCABULARY)
    assert got.columns == [*docs.columns, "extra", "ids", "decoded"]
    found = got.collect()
    assert len(found) == len(ROWS)
    for r in found:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode_decode(none, VOCABULARY).count() == 0
    draw = random.Random(1)
    pool = "aAbBcCéÉßÄ'’ \n\t12³!?.,<|>endoftextΣσİı̧́ǅ‍⁣€™中🙂­͸Ᲊ"
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 80))) for _ in range(2000)] + ["Hi <|endoftext|>there's", "ab" * 900 + "!?" * 400]
    encoder = bpe.encoder(VOCABULARY)
    assert [encoder.encode(t) for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    parts = [draw.randrange(60) for _ in range(300)]
    assert encoder.merge_scanning(list(parts)) == encoder.merge_heap(list(parts))
    assert hashlib.sha256(b"").hexdigest() in {r.decoded_sha256 for r in bpe.digests(got).collect()}
