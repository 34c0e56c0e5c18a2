"""Repeated runs of the pages of one host: known cases, a brute-force twin, and pages made to be slow."""

from __future__ import annotations

import time
from collections import defaultdict

import numpy as np
import pytest

from gritstone.llm import htmltext


def run_of(name, n):
    return " ".join(f"{name}{k}" for k in range(n))


def extracted(spark, bodies):
    rows = [(n, f"http://h.org/{n}", f"<html><body>{body}</body></html>") for n, body in enumerate(bodies)]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string").repartition(3)
    return [r.text for r in sorted(htmltext.extract(frame).collect(), key=lambda r: r.page_id)]


def test_copies_of_a_page_keep_their_text(spark):
    body = f"<p>{run_of('a', 40)}</p><p>{run_of('b', 40)}</p>"
    plain = f"{run_of('a', 40)}\n\n{run_of('b', 40)}"
    assert extracted(spark, [body, body, f"<p>{run_of('c', 30)}</p>"]) == [plain, plain, run_of("c", 30)]
    versions = [f"<p>{run_of('a', 40)} day{n}</p>" for n in range(2)]
    assert extracted(spark, versions) == [f"{run_of('a', 40)} day{n}" for n in range(2)]
    marked = [f"<article><p>{run_of('a', 40)} day{n}</p></article>" for n in range(6)]
    assert extracted(spark, marked) == [f"{run_of('a', 40)} day{n}" for n in range(6)]


def test_what_follows_a_shared_beginning_stays(spark):
    got = extracted(spark, [f"<p>{run_of('s', 8)} {run_of(f'u{n}x', 12)}</p>" for n in range(2)])
    assert got == [run_of(f"u{n}x", 12) for n in range(2)]


def test_a_run_in_the_middle_of_a_block_goes(spark):
    got = extracted(spark, [f"<p>{run_of(f'u{n}x', 6)} {run_of('s', 40)} {run_of(f'v{n}x', 50)}</p>" for n in range(6)])
    assert got == [f"{run_of(f'u{n}x', 6)} {run_of(f'v{n}x', 50)}" for n in range(6)]


def test_marked_and_unmarked_pages_meet(spark):
    shared = f"<p>{run_of('s', 30)}</p>"
    got = extracted(spark, [f"<article>{shared}<p>{run_of(f'u{n}x', 60)}</p></article>" for n in range(4)] + [f"{shared}<p>{run_of('w', 60)}</p>"])
    assert got == [run_of(f"u{n}x", 60) for n in range(4)] + [run_of("w", 60)]


def test_hosts_do_not_meet(spark):
    rows = [(n, f"http://h{n}.org/", f"<p>{run_of('s', 30)}</p><p>{run_of(f'u{n}x', 60)}</p>") for n in range(5)]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string")
    assert all(r.text.startswith("s0 ") for r in htmltext.extract(frame).collect())


def covered_by(streams, length):
    """For each stream the tokens inside windows of ``length`` that stand in another stream, too."""
    holders = defaultdict(set)
    for n, tokens in enumerate(streams):
        for at in range(len(tokens) - length + 1):
            holders[tuple(tokens[at : at + length])].add(n)
    out = []
    for tokens in streams:
        inside = set()
        for at in range(len(tokens) - length + 1):
            if len(holders[tuple(tokens[at : at + length])]) > 1:
                inside |= set(range(at, at + length))
        out.append(inside)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_runs_against_brute_force(spark, seed):
    draw = np.random.default_rng(seed)
    shared = [[f"s{k}w{j}" for j in range(size)] for k, size in enumerate((9, 14, 29, 33, 60, 120))]
    streams, bodies = [], []
    for n in range(12):
        own = [f"p{n}t{j}" for j in range(400)]
        for k in draw.choice(len(shared), 3, replace=False):
            cut = draw.integers(0, 400)
            part = shared[k][draw.integers(0, 3) :]
            own[cut:cut] = part
        streams.append(own)
        border = int(draw.integers(1, len(own)))
        bodies.append(f"<div><p>{' '.join(own[:border])}</p><p>{' '.join(own[border:])}</p></div>")
    sure, possible = covered_by(streams, htmltext.MIN_TOKENS + htmltext.REACH - 1), covered_by(streams, htmltext.MIN_TOKENS)
    for n, text in enumerate(extracted(spark, bodies)):
        left = text.split()
        gone = {at for at, token in enumerate(streams[n]) if token not in set(left)}
        assert sure[n] <= gone <= possible[n]
        assert left == [token for at, token in enumerate(streams[n]) if at not in gone]
    assert any(sure)


@pytest.mark.parametrize("made", [
    lambda n: "<div>" * n + "</section>" * n, lambda n: "<a " * n, lambda n: '<a =">" ' * n, lambda n: "<!" * n,
    lambda n: "<b hidden><div>" + "<i hidden>" * n + "</b>" * n, lambda n: "<script " * n])
def test_hostile_pages_take_linear_time(made):
    start = time.perf_counter()
    htmltext.blocks(made(60_000))
    assert time.perf_counter() - start < 6


def test_stray_quotes_and_unclosed_tags_keep_the_text():
    page = """<p class=x">te"xt</p><p>a <b title="x>y">q</b> 5 <c and d"""
    assert htmltext.blocks(page)[0] == ['te"xt', "a q 5 <c and d"]
