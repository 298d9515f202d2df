"""Exact and near duplicates against brute force."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import components, exact_dedup, near_join
from tests.llm.cases import empty, frame, rows


def least(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def test_exact_groups_of_awkward_rows(spark):
    groups = {}
    for i, t, *_ in rows():
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
        groups.setdefault(digest, []).append(i)
    want = sorted(repr((i, least(ids), len(ids), i == least(ids), d)) for d, ids in groups.items() for i in ids)
    for share in (0.0, 0.5, 1.0):
        got = exact_dedup.exact_dedup(frame(spark), history_share=share)
        assert sorted(repr(tuple(r)) for r in got.collect()) == want
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_kept_rows_keep_their_columns(spark):
    docs = frame(spark)
    kept = exact_dedup.kept_rows(docs)
    assert kept.columns == docs.columns
    ids = sorted(repr(r["doc_id"]) for r in kept.collect())
    assert "6" not in ids and "9" not in ids and "1" not in ids and "5" in ids and ids.count("15") == 2


def test_index_answers_later_batches(spark):
    old = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id long, text string")
    new = spark.createDataFrame([(1000 + i, f"text  {i}") for i in range(400, 600)], "doc_id long, text string")
    index = exact_dedup.build_index(exact_dedup.digests(old), 4)
    found = exact_dedup.look_up(exact_dedup.digests(new), index, 4)
    joined = exact_dedup.digests(new).join(found, "digest")
    got = {r["id"]: (r["keep_id"], r["group_size"]) for r in joined.collect()}
    assert got == {1000 + i: (i, 2) if i < 500 else (1000 + i, 1) for i in range(400, 600)}


def shingle_set(text, size=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute(data, percent=80):
    sets = [shingle_set(t) for _, t, *_ in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(data)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    groups = {}
    for i in range(len(data)):
        groups.setdefault(find(i), []).append(data[i][0])
    return sorted(repr((data[i][0], len(sets[i]), least(groups[find(i)]))) for i in range(len(data)))


def test_near_join_of_awkward_rows(spark):
    got = near_join.near_join(frame(spark))
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows())
    assert near_join.near_join(empty(spark)).count() == 0


def copies(seed, n=260):
    """Groups of copies with more and more changes, and texts built of shared passages."""
    r = random.Random(seed)
    word = lambda: f"w{r.randint(0, 4000)}"
    passages = [[word() for _ in range(60)] for _ in range(4)]
    data, i = [], 0
    while i < n:
        base = [word() for _ in range(r.randint(3, 150))]
        for _ in range(r.choice([1, 1, 2, 5, 30])):
            t = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                t[r.randrange(len(t))] = word()
            if r.random() < 0.2:
                t = t[: r.randint(1, len(t))]
            if r.random() < 0.3:
                t += r.choice(passages)
            data.append((i, " ".join(t)))
            i += 1
    return data


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("small", [{}, {"chunk_sets": 4, "one_task": 0}, {"chunk_sets": 25, "chunk_shingles": 4000}])
def test_near_join_is_brute_force(spark, seed, small):
    data = copies(seed)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert sorted(repr(tuple(r)) for r in near_join.near_join(df, **small).collect()) == brute(data)


def test_resolved_links_connect_what_links_connect():
    r = random.Random(9)
    for _ in range(30):
        m = r.randint(2, 60)
        base = list(range(100))
        sets = []
        for _ in range(m):
            s = set(r.sample(base, r.randint(60, 100)))
            sets.append(s | {1000 + r.randint(0, 300) for _ in range(r.randint(0, 12))})
        often = {t: sum(t in s for s in sets) for s in sets for t in s}
        lists = [sorted((t for t in s if often[t] > 1), key=lambda t: (often[t], t)) for s in sets]
        n = np.array([len(s) for s in sets])
        links = near_join.resolved(n, np.array([len(x) for x in lists]), np.array([t for x in lists for t in x], np.uint64), 80)
        a, b = ([x for x, _ in links], [y for _, y in links])
        for x, y in links:
            assert 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])
        node, root = components.forest(np.array(a + [0]), np.array(b + [0]))
        got = dict(zip(node.tolist(), root.tolist(), strict=True))
        for x, y in combinations(range(m), 2):
            if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                assert got[x] == got[y]


@pytest.mark.parametrize("one_task", [0, 1000])
def test_components(spark, one_task):
    r = random.Random(4)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {x["node"]: x["root"] for x in components.components(df, one_task).collect()}
    node, root = components.forest(*(np.array([e[k] for e in edges if e[0] != e[1]]) for k in (0, 1)))
    assert got == dict(zip(node.tolist(), root.tolist(), strict=True))
    assert components.components(df.where(F.lit(False))).count() == 0


def test_one_of_each_group_stays(spark):
    docs = frame(spark)
    kept = near_join.one_of_each(docs)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and 5 in ids and not {6, 9} & set(ids) and {0, 1, 2} <= set(ids)


def test_a_chain_of_many_sets_is_one_component(spark):
    """20 000 texts, each like its neighbours alone, and 300 in a chain of their own: far more than a task holds."""
    line = lambda name, i: " ".join(f"{name}{k}" for k in range(2 * i, 2 * i + 60))
    data = [(i, line("w", i)) for i in range(20_000)] + [(50_000 + i, line("v", i)) for i in range(300)] + [(90_000, line("w", 60_000))]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(8)
    got = near_join.near_join(df, chunk_sets=250).groupBy("component_id").count().collect()
    assert sorted(tuple(r) for r in got) == [(0, 20_000), (50_000, 300), (90_000, 1)]


def test_a_shingle_of_all_documents_comes_once_a_block(spark):
    """Boilerplate in every text: each block sends it to its bucket once, however many documents it has."""
    boiler = " ".join(f"b{k}" for k in range(30))
    docs = spark.createDataFrame([(i, f"{boiler} " + " ".join(f"x{i}y{k}" for k in range(6))) for i in range(400)], "id long, text string").coalesce(1)
    blocks = near_join._blocks(docs, 5, 256).collect()
    sent = sum(len(r["packed"]) // 6 + len(r["often"]) // 6 for r in blocks if r["times"] != b"own")
    assert sent == 26 + 400 * 6 and {int(t) for r in blocks if r["times"] != b"own" for t in np.frombuffer(r["times"], "<u4")} == {400}
