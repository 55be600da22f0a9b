from __future__ import annotations

import datetime as dt
import random
import textwrap

import numpy as np
import pytest

from tidecast.llm import graph_search, licenses, url_filters


def nearest(rows, queries, k):
    """Exact answer by comparing everything."""
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    out = {}
    for i, v in queries:
        found = sorted((-float((x * np.array(v, float)).sum()), j) for j, x in ok if j != i)
        out[i] = [(j, -s) for s, j in found[:k]]
    return out


def vectors(n=1500, d=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    x = centres[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, d))
    x[200:260] = x[7]  # a group of equal vectors
    x *= rng.uniform(0.5, 2, (n, 1)) * (np.arange(n)[:, None] < 1200) + 1.0 * (np.arange(n)[:, None] >= 1200)
    return [(i, v.tolist()) for i, v in enumerate(x)]


def test_search_finds_most_of_the_nearest(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = graph_search.build_index(df, shard_points=400)
    assert index.select("shard").distinct().count() > 2
    assert index.selectExpr("sum(size(ids))").first()[0] >= 1440 and index.count() <= 1500
    found = graph_search.search(index, df.where("vec_id % 20 = 0")).collect()
    queries = [r for r in rows if r[0] % 20 == 0]
    exact = nearest(rows, queries, 20)
    hits = 0
    for i, _ in queries:
        mine = sorted((r for r in found if r.query_id == i), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        vector = np.array(rows[i][1])
        for r in mine:
            assert r.vec_id != i and r.score == pytest.approx(float((np.array(rows[r.vec_id][1]) * vector).sum()))
        hits += len({r.vec_id for r in mine} & {j for j, _ in exact[i]})
    assert hits >= 0.95 * 20 * len(queries)


@pytest.mark.parametrize("long", [None, 100.0, 1e6, 1e25])
def test_recall_does_not_depend_on_lengths(spark, long):
    """Lengths over six powers of ten, or one vector that is longer than all others by far."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1600, 12))
    if long is None:
        x *= 10 ** rng.uniform(-3, 3, (1600, 1))
    else:
        x[11] *= long
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = rows[::20]
    found = graph_search.search(graph_search.build_index(df, shard_points=800), df.where("vec_id % 20 = 0")).collect()
    exact = nearest(rows, queries, 20)
    hits = len({(r.query_id, r.vec_id) for r in found} & {(i, j) for i, _ in queries for j, _ in exact[i]})
    assert len(found) == 20 * len(queries) and hits >= 0.95 * len(found)


def test_equal_vectors_and_small_tables_are_exact(spark):
    nan = float("nan")
    rows = [(i, [1.0, 2.0]) for i in range(30)] + [(100, [0.0, 0.0]), (101, None), (102, [1.0, nan]), (103, [None, 1.0]), (104, [1.0, 2.0, 3.0]),
            (None, [1.0, 2.0]), (105, [-1.0, 0.5]), (106, []), (107, [float("inf"), 1.0]), (5, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, shard int, ids int")
    found = graph_search.search(graph_search.build_index(df), df.where("vec_id in (0, 5, 25, 105, 101)")).collect()
    for q in (0, 5, 25):
        mine = sorted((r["rank"], r.vec_id) for r in found if r.query_id == q)
        assert {v for _, v in mine} == set([i for i in range(30) if i != q][:20])
    assert sorted(r.vec_id for r in found if r.query_id == 105) == list(range(20))
    assert not [r for r in found if r.query_id == 101]
    empty = df.limit(0)
    assert graph_search.search(graph_search.build_index(empty), empty).collect() == []
    assert graph_search.search(graph_search.build_index(df), empty).collect() == []


def test_fewer_candidates_than_asked(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(6)], "vec_id long, embedding array<double>")
    found = graph_search.search(graph_search.build_index(df), df).collect()
    assert len(found) == 30


def test_pruning_keeps_diverse_neighbours():
    x = graph_search.lifted(np.array([[0.0, 0], [1, 0], [1.01, 0], [1.02, 0.01], [-1, 0], [0, 1.5]]))
    kept = graph_search.robust_prune(x, np.array([0]), np.array([[1, 2, 3, 4, 5, -1]]), 5, 1.2)[0]
    assert set(kept[kept >= 0].tolist()) & {1, 2, 3} and {4, 5} <= set(kept.tolist())
    assert len({1, 2, 3} & set(kept.tolist())) == 1


def test_licences_in_any_spelling(spark):
    mit = dict(licenses.KNOWN[:1])["MIT"]
    variant = "Copyright (c) 2020 Some One\nAll rights reserved.\n\n/* " + mit.upper().replace("SUBLICENSE", "SUB-LICENCE").replace("\n", "\n * ") + " */"
    rows = [
        (0, mit), (1, variant), (2, mit + " More."), (3, "Text before.\nReleased under the M.I.T.  Licence!\nText after."),
        (4, "released under the mit license"), (5, None), (6, ""), (7, "© 2021 Somebody"), (8, "Licensed under CC BY-NC 4.0.\n\nLicensed under\nCC BY 4.0."),
        (0, mit), (None, "Released under the MIT License."), (9, "word " * 100_000 + "\nSPDX-License-Identifier: MIT"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row string")
    got = licenses.find_licenses(df, licenses.known_licenses(spark)).collect()
    by = {r.doc_id: (r.whole_license, r.notices, r.n_notices) for r in got}
    assert len(got) == len(rows)
    assert by[0][0] == by[1][0] == "MIT" and by[2][0] is None
    assert by[4] == ("MIT", "MIT", 1) and by[None] == ("MIT", "MIT", 1)
    assert by[5] == by[6] == by[7] == (None, "", 0)
    assert by[8] == (None, "CC-BY-4.0,CC-BY-NC-4.0", 2)
    assert by[9] == (None, "MIT", 1)
    assert by[3] == (None, "", 0)  # "M.I.T." is three words


def test_known_texts_wrapped_at_any_width(spark):
    """Lines of the body that begin with "copyright" stay, copyright lines go."""
    head = "Copyright (c) 2024 Somebody\nCopyright The Authors\nCopyright Holder: Me\n\n"
    cases = [(name, t) for name, t in licenses.KNOWN if len(t) > 200]
    rows = [(i * 1000 + w, head + "\n\n".join(textwrap.fill(p, w) for p in t.split("\n"))) for i, (_, t) in enumerate(cases) for w in range(20, 121)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.whole_license for r in licenses.find_licenses(df, licenses.known_licenses(spark)).collect()}
    assert got == {i: cases[i // 1000][0] for i, _ in rows}


def test_no_licences_known(spark, docs, empty):
    none = licenses.known_licenses(spark).limit(0)
    assert licenses.find_licenses(docs, none).where("n_notices > 0").count() == 0
    assert licenses.find_licenses(docs, none).count() == docs.count()
    assert licenses.find_licenses(empty, licenses.known_licenses(spark)).collect() == []


def moment(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def test_entries_active_at_fetch_time(spark):
    rnd = random.Random(8)
    hosts = ["a.example.com", "b.example.com", "example.org", "x.y.example.net"]
    names = hosts + ["example.com", "example.net", "a.example.com/en", "example.org/fr"]
    entries = [(rnd.choice("pq"), rnd.choice(names), rnd.choice(["add", "remove"]), moment(rnd.randrange(9000))) for _ in range(300)]
    entries += [entries[0], ("p", None, "add", moment(1)), (None, "example.com", "add", moment(1)), ("p", "example.com", "add", None)]
    captures = [(i, f"HTTP{rnd.choice(['', 's'])}://{rnd.choice(hosts).upper()}/{rnd.choice(['en', 'fr', ''])}/p?q", moment(rnd.randrange(10_000))) for i in range(400)]
    captures += [(i, "http://a.example.com/en/x", e[3]) for i, e in enumerate(entries[:50], 1000)]
    captures += [(2000, None, moment(5)), (2001, "no url", moment(5)), (2002, "http://a.example.com/en/x", None), (0, "http://example.org/", moment(8000))]
    pages = spark.createDataFrame([(*c, "z") for c in captures], "page_id long, url string, fetched timestamp_ntz, pattern string")
    listed = spark.createDataFrame([(*e, 1) for e in entries], "list string, pattern string, action string, ts timestamp_ntz, n int")
    got = sorted((r.page_id, r.n_active, r.first_pattern or "", r.blocked) for r in url_filters.active_entries(pages, listed).collect())
    expected = []
    for i, url, at in captures:
        host, _, rest = (url or "").lower().partition("://")[2].partition("/")
        labels = host.split(".")
        asks = {".".join(labels[k:]) for k in range(max(1, len(labels) - 1))} if host else set()
        segment = (url or "").partition("://")[2].partition("/")[2].partition("/")[0]
        asks |= {f"{host}/{segment}"} if host and segment else set()
        active = []
        for key in {(e[0], e[1]) for e in entries if None not in e} if at else ():
            past = [(e[3], e[2] == "remove") for e in entries if None not in e and (e[0], e[1]) == key and e[3] <= at]
            if key[1] in asks and past and not max(past)[1]:
                active.append(key[1])
        expected.append((i, len(active), min(active, default=""), bool(active)))
    assert got == sorted(expected)
    assert sum(e[3] for e in expected) > 50


def test_url_filter_on_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", moment(1))], "page_id long, url string, fetched timestamp_ntz")
    listed = spark.createDataFrame([("p", "a.b", "add", moment(0))], "list string, pattern string, action string, ts timestamp_ntz")
    assert [r.n_active for r in url_filters.active_entries(pages, listed.limit(0)).collect()] == [0]
    assert url_filters.active_entries(pages.limit(0), listed).collect() == []
    assert [r.n_active for r in url_filters.active_entries(pages, listed).collect()] == [1]
