"""Exact dedup, the Jaccard join and line dedup against plain versions and SQL."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from catalog.compare import connect
from stockcast.llm import exact_dedup, graph, line_dedup, queries, shingle_join
from stockcast.llm.oracles import ORACLES
from tests.llm import plain
from tests.llm.conftest import SF, as_rows, frame


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    db = connect(SF)
    db.register("got", queries.REGISTRY[name](spark, SF).toArrow())
    db.execute(f"create temp table want as {ORACLES[name]}")
    columns = ", ".join(d[0] for d in db.execute("select * from want limit 0").description)
    assert db.execute("select count(*) from got").fetchone() == db.execute("select count(*) from want").fetchone()
    assert not db.execute(f"select {columns} from got except all select {columns} from want").fetchall()


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**48 - 1), min_size=1, max_size=300))
def test_golomb_round_trip(values):
    own = np.array(sorted(values), np.int64)
    assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(own, 48), len(own), 48) == own).all()


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("block_rows", [exact_dedup.BLOCK_ROWS, 3])
def test_exact_groups_of_edge_rows(spark, edge, block_rows):
    rows = as_rows(edge)
    got = [tuple(r) for r in exact_dedup.exact_groups(edge, block_rows=block_rows).collect()]
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(normalised(text), []).append(doc_id)
    order = lambda x: (x is None, x or 0)
    want = sorted(((d, min(groups[normalised(t)], key=order), len(groups[normalised(t)])) for d, t in rows), key=str)
    assert sorted(((d, k, n) for d, k, n, _, _ in got), key=str) == want
    assert sum(kept for *_, kept, _ in got) == len(groups)


def test_few_fingerprint_bits_still_give_whole_results(spark, documents):
    """With 26 bits different texts share fingerprints; their bytes tell them apart."""
    got = {tuple(r) for r in exact_dedup.exact_groups(documents, bits=26).collect()}
    assert got == {tuple(r) for r in exact_dedup.exact_groups(documents).collect()}


@pytest.mark.parametrize("block_rows", [exact_dedup.BLOCK_ROWS, 3])
def test_drop_exact_copies(spark, edge, block_rows):
    left = exact_dedup.drop_exact_copies(edge, block_rows)
    assert left.schema == edge.schema
    texts = [normalised(t) for _, t in as_rows(left)]
    assert len(texts) == len(set(texts)) == len({normalised(t) for _, t in as_rows(edge)})
    order = lambda x: (x is None, x or 0)
    least = {}
    for doc_id, text in as_rows(edge):
        least[normalised(text)] = min(least.get(normalised(text), doc_id), doc_id, key=order)
    assert {normalised(t): d for d, t in as_rows(left)} == least


def test_dropping_passes_all_columns_through(spark):
    """Ids and texts of other types, names of the operator's own, odd names and nested values."""
    rows = spark.createDataFrame(
        [(1, "a b", "x", [1], {"k": 1.5}, 0), (2, "a  b", None, None, None, None), (3, "c", "y", [], {}, 2)],
        "doc_id int, text string, own_id string, `odd.name ``x` array<int>, own_text map<string,double>, at int",
    )
    left = exact_dedup.drop_exact_copies(rows)
    assert left.schema == rows.schema
    assert sorted(tuple(r) for r in left.collect()) == sorted(tuple(r) for r in rows.where("doc_id != 2").collect())


def test_only_texts_of_suspects_are_exchanged(spark, documents):
    """Texts meet the bitmaps in the buckets they were written in; what leaves that join is the suspects."""
    rows, bitmaps = exact_dedup._marked_blocks(exact_dedup._renamed(documents, False)[0], 48, 64)
    texts = exact_dedup._suspect_texts(rows, bitmaps)
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "Sort" not in plan.replace("SortMerge", "Sort")
    groups = {}
    for _, text in as_rows(documents):
        groups[normalised(text)] = groups.get(normalised(text), 0) + 1
    want = sorted(t for t, n in groups.items() if n > 1 for _ in range(n))
    assert sorted(bytes(r["norm"]).decode() for r in texts.collect()) == want
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("stockcast_")]


def test_empty_tables(spark, empty):
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.drop_exact_copies(empty).count() == 0
    assert shingle_join.near_duplicates(empty).count() == 0
    assert shingle_join.keep_one_per_group(empty).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string, lines string, host string, text string")
    assert line_dedup.drop_boilerplate(pages, "page_id", line_dedup.host_of("url"), line_dedup.page_text("html")).count() == 0


def test_near_duplicates_of_documents(spark, documents):
    want = plain.jaccard_groups(as_rows(documents))
    assert {r[0]: (r[1], r[2]) for r in shingle_join.near_duplicates(documents).collect()} == want


def test_near_duplicates_of_edge_rows(spark, unique):
    df = spark.createDataFrame(unique, "doc_id long, text string")
    assert {r[0]: (r[1], r[2]) for r in shingle_join.near_duplicates(df).collect()} == plain.jaccard_groups(unique)


def test_chains_and_thresholds(spark):
    """Each text is near its neighbours only; some pairs lie just at, some just below the threshold."""
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[6 * k : 6 * k + 60])) for k in range(50)]
    rows += [(1000 + k, " ".join([*words[100 : 104 + 28], *[f"v{k}{j}" for j in range(k)]])) for k in range(14)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: (r[1], r[2]) for r in shingle_join.near_duplicates(df, block=3).collect()} == plain.jaccard_groups(rows)


def around_the_limit(count, seed=3):
    """Copies of one text with some words replaced each: about as many pairs reach the threshold as do not."""
    draw = random.Random(seed)
    base = [f"w{k}" for k in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, count):
        own = list(base)
        for at in draw.sample(range(120), draw.choice((1, 2, 3, 4))):
            own[at] = f"x{k} {at}".replace(" ", "y")
        rows.append((k, " ".join(own)))
    return rows


@pytest.mark.parametrize("hub_rounds", [0, 3])
@pytest.mark.parametrize("portion", [shingle_join.BLOCK_SHINGLES, 500])
def test_groups_around_the_limit(spark, monkeypatch, hub_rounds, portion):
    monkeypatch.setattr(shingle_join, "HUB_ROUNDS", hub_rounds)
    monkeypatch.setattr(shingle_join, "BLOCK_SHINGLES", portion)
    rows = around_the_limit(60)
    df = frame(spark, [(*r, None, None, None) for r in rows])
    assert {r[0]: (r[1], r[2]) for r in shingle_join.near_duplicates(df, block=16).collect()} == plain.jaccard_groups(rows)


def test_rows_of_the_last_round_grow_with_the_members(spark, monkeypatch):
    """However many pairs the bitmaps allow, a group gives a few links for each of its members."""
    monkeypatch.setattr(shingle_join, "HUB_ROUNDS", 0)
    made = []
    original = shingle_join._rest_links
    monkeypatch.setattr(shingle_join, "_rest_links", lambda *args: made.append(original(*args)) or made[-1])
    for count in (40, 80, 160):
        shingle_join.near_duplicates(frame(spark, [(*r, None, None, None) for r in around_the_limit(count)])).count()
    for count, links in zip((40, 80, 160), made, strict=True):
        assert count / 2 <= links.count() <= 3 * count


def test_forest_connects_what_links_connect():
    """Whatever the order and the components known before, the links found give the components of all links."""
    draw = random.Random(9)
    for _ in range(30):
        sets = []
        for _ in range(draw.randint(2, 14)):
            near = sets and draw.random() < 0.7
            base = set(draw.choice(sets)) if near else {draw.getrandbits(64) for _ in range(draw.randint(3, 40))}
            for x in draw.sample(sorted(base), min(len(base) - 1, draw.randint(0, 4))):
                base.discard(x)
                base.add(draw.getrandbits(64))
            sets.append(base)
        sets.sort(key=len)
        arrays = [np.array(sorted(x), np.uint64) for x in sets]
        side = lambda at: {"keys": np.array(at), "sizes": np.array([len(sets[k]) for k in at]), "roots": np.array(at),
                           "maps": [shingle_join.bitmap(arrays[k]) for k in at], "arrays": [arrays[k] for k in at]}
        cut = draw.randint(1, len(sets) - 1)
        every = [shingle_join.forest(side(list(range(len(sets)))), None, 75, 100)]
        parts = [shingle_join.forest(side(list(range(cut))), None, 75, 100), shingle_join.forest(side(list(range(cut, len(sets)))), None, 75, 100),
                 shingle_join.forest(side(list(range(cut))), side(list(range(cut, len(sets)))), 75, 100)]
        links = [(a, b) for a in range(len(sets)) for b in range(a) if 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])]

        def groups(edges):
            root = list(range(len(sets)))
            for _ in sets:
                for a, b in edges:
                    root[a] = root[b] = min(root[a], root[b])
            return root

        for found in (every, parts):
            assert groups([e for x, y in found for e in zip(x, y, strict=True)]) == groups(links)


def test_rows_without_an_id_stay(spark, edge):
    left = shingle_join.keep_one_per_group(edge)
    assert left.columns == edge.columns and left.where("doc_id is null").count() == 2


def test_repeated_and_missing_ids_count_by_their_text(spark):
    near = lambda k: " ".join([*(f"w{j}" for j in range(60)), f"end{k}"])
    far = lambda k: " ".join(f"{k}v{j}" for j in range(40))
    rows = [(1, near(1)), (5, near(2)), (5, far("a")), (None, near(3)), (7, far("b")), (7, far("b") + " x"), (8, far("c")), (8, far("c")),
            (None, far("d")), (None, far("d") + " y"), (None, far("e")), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = as_rows(shingle_join.keep_one_per_group(df))
    assert {(1, near(1)), (5, far("a")), (8, far("c")), (None, far("e")), (None, None)} <= set(left)
    assert len([k for k, _ in left if k == 7]) == 1 and len([t for _, t in left if t and "dv" in t]) == 1 and len(left) == 7
    got = sorted((tuple(r) for r in shingle_join.near_duplicates(df).collect()), key=str)
    want = [(1, 57, 1), (5, 57, 1), (5, 36, 5), (None, 57, 1), (7, 36, 7), (7, 37, 7), (8, 36, 8), (8, 36, 8), (None, 36, None),
            (None, 37, None), (None, 36, None), (None, 0, None)]
    assert got == sorted(want, key=str)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=200), st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60))
def test_bitmaps_bound_the_intersection(a, b):
    b = b | set(list(a)[: len(a) // 2])
    apart = shingle_join.differing(*(shingle_join.bitmap(np.array(sorted(x), np.uint64)) for x in (a, b)))
    assert (len(a) + len(b) - apart) // 2 >= len(a & b)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 400))
def test_prefix_is_long_enough(n):
    """A set that shares nothing of the prefix shares too little."""
    rest = n - shingle_join.prefix_length(n)
    assert not shingle_join.close(rest, n, max(rest, -(-3 * n // 4)))


def test_components(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 230)] + [(229, 3), (50, 51), (51, 50), (9, 9)]
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys([3, 7, *range(200, 230)], 3), 50: 50, 51: 50}


def test_boilerplate_edges(spark):
    rows = [(k, "http://A.example/x", f"<p>menu</p><p>own {k}</p>", "x") for k in range(10)]
    rows += [(100, None, "<p>menu</p>", "x"), (101, "http://b.example", None, "x"), (102, "http://b.example", "", None), (5, "http://a.example/y", "<b>menu", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, lines string")
    got = line_dedup.drop_boilerplate(df, "page_id", line_dedup.host_of("url"), line_dedup.page_text("html"), ratio=0.5)
    found = sorted((r.page_id, r.host, r.n_lines, r.n_dropped, r.text.split()) for r in got.collect())
    assert found == sorted(
        [(k, "a.example", 2, 1, ["own", str(k)]) for k in range(10)]
        + [(100, "", 1, 0, ["menu"]), (101, "b.example", 0, 0, []), (102, "b.example", 0, 0, []), (5, "a.example", 1, 1, [])]
    )


@pytest.mark.parametrize("count", range(1, 11))
def test_boilerplate_of_small_hosts(spark, count):
    """Production settings: a host's own lines stay whatever its size; a line of three pages or more goes."""
    rows = [(k, "http://a.example/", f"<p>menu</p><p>own {k}</p>" + "<i>pair</i>" * (k < 2)) for k in range(count)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = line_dedup.drop_boilerplate(df, "page_id", line_dedup.host_of("url"), line_dedup.page_text("html"))
    for r in got.collect():
        kept = ["menu"] * (count < 3) + [f"own {r.page_id}"] + ["pair"] * (r.page_id < 2)
        assert [x for x in r.text.split("\n") if x] == kept
        assert (r.n_lines, r.n_dropped) == (2 + (r.page_id < 2), int(count >= 3))


def test_long_pages_and_open_markup(spark):
    """Pages of many lines, the same on each but for one; scripts and comments that are never closed."""
    long = "".join(f"<p>line {k}</p>" for k in range(3000))
    rows = [(k, "http://a.example/", long + f"<p>own {k}</p>") for k in range(4)]
    rows += [(10 + k, "http://b.example/", "<script <!-- " * 2000 + f"end {k}") for k in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = line_dedup.drop_boilerplate(df, "page_id", line_dedup.host_of("url"), line_dedup.page_text("html"))
    found = {r.page_id: (r.n_lines, r.n_dropped, r.text.strip()) for r in got.collect()}
    assert all(found[k] == (3001, 3000, f"own {k}") for k in range(4))
    assert all(found[10 + k][1] == 0 and found[10 + k][2].endswith(f"end {k}") for k in range(2))


def test_line_dedup_runs_without_python(spark):
    plan = queries.op10_line_dedup(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow|CartesianProduct", plan)


def test_extra_columns(spark, edge):
    assert set(exact_dedup.exact_groups(edge).columns) == {"doc_id", "keep_id", "group_size", "kept", "text_sha256"}
    assert shingle_join.near_duplicates(frame(spark, [(1, "a", None, None, None)])).collect()[0][:] == (1, 1, 1)
