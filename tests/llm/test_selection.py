"""Mixing, toxicity, licenses and the pipeline."""

import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from quire.llm import licenses, mixing, packing, toxicity
from quire.llm.queries import tokenizer
from tests.llm.cases import empty, frame, rows
from tests.llm.test_dedup import shingle_set

SF = "/root/testdata/sf0.01"


def shares(sizes):
    """Targets by filling up, source by source."""
    names = sorted((k for k in sizes if k is not None), key=lambda k: [ord(c) for c in k]) + [None] * (None in sizes)
    weight = {k: i % 3 + 1 for i, k in enumerate(names)}
    left, full, out = float(sum(sizes.values())), set(), {}
    while True:
        free = [k for k in names if k not in full]
        w = sum(weight[k] for k in free)
        over = [k for k in free if left * weight[k] / w >= 3 * sizes[k]] if free else []
        if not over:
            return out | {k: left * weight[k] / w for k in free}
        for k in over:
            full.add(k)
            out[k] = 3.0 * sizes[k]
        left = sum(sizes.values()) - sum(out.values())


@pytest.mark.parametrize("seed", range(4))
def test_mix(spark, seed):
    r = random.Random(seed)
    data = [(i, "w " * r.randint(0, 60), r.choice(["a", "b", "c", "é", None, "a"] if seed else ["x", "y"]), ) for i in range(600)] + [(1000, None, "tiny"), (1001, "w", "tiny")]
    got = mixing.mix(spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5)).collect()
    sizes = defaultdict(int)
    for _, t, s in data:
        sizes[s] += len((t or "").split())
    want, source, taken = shares(sizes), {i: s for i, _, s in data}, defaultdict(int)
    assert len(got) == len(data)
    for x in got:
        s = source[x["doc_id"]]
        assert x["source_size"] == sizes[s] and x["target"] == pytest.approx(want[s])
        assert x["taken"] == x["copies"] * x["size"] and 0 <= x["copies"] <= 3
        taken[s] += x["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * 60 + 1


def test_mix_of_awkward_rows(spark):
    docs = frame(spark)
    first, second = (sorted(repr(tuple(r)) for r in mixing.mix(d).collect()) for d in (docs, docs.repartition(7)))
    assert first == second and len(first) == len(rows())
    assert mixing.mix(empty(spark)).count() == 0
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    times = Counter()
    for r in mixing.mix(docs).collect():
        times[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == +times


@pytest.mark.parametrize("ids", [[None] * 10, [7] * 10, [1, 1, None, None, 2, 2, 3, 3, 3, 3]])
def test_rows_without_an_id_of_their_own_keep_their_copies(spark, ids):
    """Ten rows in a small part of all words, with other texts: all copies that mix() gives come out."""
    data = [(i, f"a b {k}", "b") for k, i in enumerate(ids)] + [(100 + k, "w " * 20, "a") for k in range(9)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
    copies = sum(r["copies"] for r in mixing.mix(docs).where("size = 3").collect())
    out = [r for r in mixing.mixed_rows(docs).collect() if r["source"] == "b"]
    assert len(out) == copies > 0 and {r["text"] for r in out} <= {t for _, t, _ in data}


def test_toxic_texts_are_found_held_out(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice(["an", "er", "th", "in", "on", "re", "st", "ou"]) for _ in range(r.randint(1, 4)))
    bad = ["idiot", "worthless", "vequ", "lowei"]
    data, labels = [], []
    for i in range(1500):
        t = [word() for _ in range(r.randint(5, 200))]
        toxic = r.random() < 0.3
        for _ in range(r.randint(1, 4) if toxic else 0):
            b = r.choice(bad)
            t[r.randrange(len(t))] = b if len(b) > 4 and b != "lowei" else b + word()
        data.append((i, " ".join(t)))
        labels.append((i, int(toxic)))
    got = toxicity.toxicity(spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    known = dict(labels)
    held = [x for x in got if x["held_out"]]
    assert all(x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1) and x["predicted"] == int(x["score"] >= 0.7) and 0 <= x["score"] <= 1 for x in got)
    right = sum(x["predicted"] == known[x["doc_id"]] for x in held) / len(held)
    assert right >= 0.97 and len(held) > 400


def test_toxicity_of_awkward_rows(spark):
    labels = spark.createDataFrame([(0, 1), (3, 0), (5, 0), (16, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    docs = frame(spark)
    got = toxicity.toxicity(docs, labels)
    assert got.count() == len(rows()) and got.where("score IS NULL OR isnan(score)").count() == 0
    none = toxicity.toxicity(docs, labels.where("false"))
    assert none.where("score <> 0 OR predicted <> 0").count() == 0 and none.count() == len(rows())
    assert toxicity.toxicity(empty(spark), labels).count() == 0
    assert toxicity.without_toxic(docs, labels.where("false")).count() == len(rows())


def test_clean_words_do_not_hide_toxic_ones():
    own = iter(range(1000, 100_000))
    text = lambda *common: np.array(sorted([*common, *(next(own) for _ in range(30))]))
    data = [text(1, 2) for _ in range(100)] + [text(2, 9) for _ in range(50)] + [text(4, 9) for _ in range(50)]
    m = toxicity.fit([(d, np.ones(len(d), int)) for d in data], np.array([False] * 100 + [True] * 100))
    assert set(m.buckets.tolist()) >= {9} and (m.weights > 0).all()


def plain_scores(texts, model):
    """Scores by dictionaries of n-grams, hashed one by one."""
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    top, step, spread = 1 << 64, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
    out = []
    for t in texts:
        chars, found = [32 if c in "\t\n\v\f\r\xa0" else ord(c) for c in f" {t.lower()} "], Counter()
        for n in toxicity.ORDERS:
            for i in range(len(chars) - n + 1):
                h = 0
                for c in chars[i : i + n]:
                    h = (h * step + c) % top
                h = (h + n) * spread % top
                found[(h ^ h >> 32) * step % top >> 32] += 1
        s = model.bias + sum(weight[b] * (1 + np.log(k)) for b, k in found.items() if b in weight)
        out.append(1 / (1 + np.exp(-s)))
    return out


def labelled(sf):
    """(texts, toxic, held out) of the labelled documents."""
    import pyarrow.parquet as pq

    known = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"/root/testdata/{sf}/labels.parquet").to_pylist()}
    docs = [r for r in pq.read_table(f"/root/testdata/{sf}/documents.parquet").to_pylist() if r["doc_id"] in known]
    return docs, np.array([known[r["doc_id"]] > 0 for r in docs]), np.array([zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in docs])


@pytest.mark.parametrize(("sf", "recall", "false_alarms"), [("sf0.01", 0.75, 0.02), ("sf0.1", 0.9, 0.01)])
def test_toxicity_of_held_out_documents(spark, sf, recall, false_alarms):
    """At 0.01, 33 toxic texts are learned from. At 0.1, 10 of the 144 held-out ones share no n-gram with other toxic ones."""
    from quire.llm.queries import op2_toxicity

    docs, toxic, held = labelled(sf)
    got = {r["doc_id"]: r for r in op2_toxicity(spark, f"/root/testdata/{sf}").collect()}
    found = np.array([got[d["doc_id"]]["predicted"] == 1 for d in docs])
    assert found[toxic & held].mean() >= recall and found[~toxic & held].mean() <= false_alarms
    if sf == "sf0.01":
        rows = spark.createDataFrame([(d["doc_id"], d["text"]) for d in docs], "id long, text string")
        labels = spark.createDataFrame([(d["doc_id"], int(t)) for d, t, h in zip(docs, toxic, held, strict=True) if not h], "doc_id long, toxic int")
        model = toxicity.train(rows, labels)
        some = docs[:40]
        assert plain_scores([d["text"] for d in some], model) == pytest.approx([got[d["doc_id"]]["score"] for d in some], rel=1e-9)


def test_sample_is_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * (5000 if i % 10 else 400_000)) for i in range(200)], "id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    got = toxicity.sample_of(docs, labels, 4000, 320_000).collect()
    assert max(len(r["text"]) for r in got) == 5000
    for t in (0, 1):
        assert 150_000 <= sum(len(r["text"]) for r in got if r["toxic"] == t) <= 160_000


def test_copies_count_once():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 32, 300)
    copies = [np.unique(np.concatenate([base[:290], r.integers(0, 1 << 32, 10)])) for _ in range(20)]
    others = [np.unique(r.integers(0, 1 << 32, 300)) for _ in range(20)]
    assert toxicity.unlike([*copies, *others]) == [0, *range(20, 40)]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_license_places(spark):
    docs = frame(spark)
    got = sorted(repr(tuple(r)[:6]) for r in licenses.license_scan(docs).collect())
    want = []
    for i, t, *_ in rows():
        w, at, labels = WORD.findall((t or "").translate(LOWER)), [], set()
        for phrase, label in licenses.BASE:
            p = phrase.split()
            for k in range(len(w) - len(p) + 1):
                if w[k : k + len(p)] == p:
                    at.append(k)
                    labels.add(label)
        want.append(repr((i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))))
    assert got == sorted(want)
    assert licenses.license_scan(empty(spark)).count() == 0


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0 (the License)", "apache,apache-2.0"),
        ("GNU Lesser General Public License version 2.1", "lgpl-2.1"),
        ("under the GNU General Public License", "gpl"),
        ("SPDX-License-Identifier: MIT", "mit"),
        ("https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa-4.0"),
        ("CC BY-NC", "cc-by,cc-by-nc"),
        ("All rights reserved.", "proprietary"),
        ("mit dem Zug", ""),
        ("no license here", ""),
    ],
)
def test_license_labels(spark, text, labels):
    r = licenses.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["labels"] == labels and (r["score"] > 0) == bool(labels)


def test_license_rules():
    rules = licenses.rules()
    assert len(rules) > 450 and [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)
    assert len({r.name for r in rules}) == len(rules) and all(min(map(len, r.keywords)) >= 3 for r in rules)
    own = [r for r in rules if not r.name.startswith("spdx:") and re.search(r"[(\[?]", r.pattern.pattern.decode().removesuffix("(?= )").replace("(?:www )?", "").replace("https?", ""))]
    assert len(own) > 200


def spelled(parsed):
    """All strings that a rule's expression stands for; open repeats are taken at their least and once more."""
    out = [""]
    for op, x in parsed:
        op = str(op)
        if op == "LITERAL":
            more = [chr(x)]
        elif op == "IN":
            more = [chr(c) for o, a in x for c in ([a] if str(o) == "LITERAL" else [a[0]])]
        elif op == "BRANCH":
            more = [s for branch in x[1] for s in spelled(branch)]
        elif op == "SUBPATTERN":
            more = spelled(x[3])
        elif op == "MAX_REPEAT":
            more = [s * n for s in spelled(x[2]) for n in {x[0], min(x[0] + 1, x[1])}]
        else:
            assert op in ("ASSERT", "ASSERT_NOT"), op
            more = [""]
        out = [a + b for a in out for b in more]
    return out


@pytest.mark.parametrize("rule", licenses.rules(), ids=lambda r: r.name)
def test_license_rule_fires(rule):
    """Each spelling of each rule is found, by the rule or by one before it over the same words."""
    own = 0
    for text in set(spelled(re._parser.parse(rule.pattern.pattern.decode()))):
        words, n = licenses.normalised(f"see {text} here".encode())
        found = [r for r, a, b in licenses.detections(words) if a <= 1 and b >= n - 2]
        assert found and found[0].priority >= rule.priority, text
        own += rule in found
    assert own


def covered(found):
    """Detections in order of priority, length, place and rule that lie within none accepted before, pair by pair."""
    out = []
    for r, a, b in sorted(found, key=lambda x: (-x[0].priority, -(x[2] - x[1]), x[1], x[0].name)):
        if not any(c <= a and b <= d for _, c, d in out):
            out.append((r, a, b))
    return out


@pytest.mark.parametrize("seed", range(20))
def test_license_containment(seed):
    r = random.Random(seed)
    found = []
    for _ in range(r.randint(1, 120)):
        a = r.randint(0, 60)
        found.append((r.choice(licenses.rules()[::17]), a, a + r.randint(1, 30)))
    assert set(licenses.outermost(found)) == set(covered(found))


def test_licenses_of_a_long_text():
    """A megabyte of clauses: whole, and in time that grows with the length alone."""
    clauses = " ".join(["This program is free software: you can redistribute it and/or modify it", "All rights reserved.", "SPDX-License-Identifier: GPL-2.0-only", "CC BY-SA 4.0", "see the GNU Lesser General Public License version 2.1 or words between"])
    seconds = []
    for times in (500, 5000):
        words, n = licenses.normalised((clauses + "\n").encode() * times)
        began = time.process_time()
        found = licenses.detections(words)
        seconds.append(time.process_time() - began)
        each = n // times
        at = Counter((r.label, a % each) for r, a, _ in found)
        assert set(at.values()) == {times} and {label for label, _ in at} >= {"gpl", "proprietary", "gpl-2.0", "cc-by-sa-4.0", "lgpl-2.1"}
    assert len(clauses) * 5000 > 1_000_000 and seconds[1] < 30 * max(seconds[0], 0.05)


def test_license_detections(spark):
    docs = spark.createDataFrame([(1, "x (c) MIT License, GNU LESSER General Public License v2.1"), (2, None), (None, "All rights\nreserved"), (3, "")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["label"], r["first_word"], r["last_word"]) for r in licenses.license_detections(docs).collect())
    assert got == [("1", "lgpl-2.1", 4, 10), ("1", "mit", 2, 3), ("None", "proprietary", 0, 2)]
    assert licenses.license_detections(empty(spark)).count() == 0


@pytest.mark.parametrize("gap", ["", "-", " "])
def test_license_split_names(spark, gap):
    text = f"Creative Commons Attribution-Non{gap}Commercial-Share{gap}Alike 4.0 and Creative Commons Attribution-No{gap}Derivs 3.0"
    r = licenses.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["labels"] == "cc-by-nc-sa-4.0,cc-by-nd-3.0"


def brute_pipeline(docs, toxic):
    """The first three stages on plain rows, given which ids the classifier rejects."""
    left = sorted((d for d in docs if d["doc_id"] not in toxic), key=lambda d: d["doc_id"])
    seen, unique = set(), []
    for d in left:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", d["text"])
        if key not in seen:
            seen.add(key)
            unique.append(d)
    sets = {d["doc_id"]: shingle_set(d["text"]) for d in unique}
    by_shingle = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by_shingle[x].append(i)
    common = Counter()
    for ids in by_shingle.values():
        for a in ids:
            for b in ids:
                if a < b:
                    common[a, b] += 1
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), k in common.items():
        if 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d["doc_id"] for d in unique if find(d["doc_id"]) == d["doc_id"]}


def test_pipeline(spark):
    from quire.llm.queries import op2_toxicity, table

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    docs = table(spark, SF, "documents")
    toxic = {r["doc_id"] for r in op2_toxicity(spark, SF).where("predicted = 1").collect()}
    df = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        df = stage(spark, df, SF).cache()
        assert df.columns == docs.columns, name
    assert {r["doc_id"] for r in df.select("doc_id").collect()} == brute_pipeline(docs.collect(), toxic)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(df).collect()}
    mixed = corpus_pipeline.mixing(spark, df, SF)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == +Counter(copies)
    n, runs = 0, packing.pack(mixed, tokenizer("word_bpe_49k.json"))
    final = corpus_pipeline.run(spark, SF)
    assert final.columns == runs.columns and final.count() == runs.count() > n


def test_pipeline_takes_awkward_rows(spark):
    df = frame(spark)
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, SF)
        assert df.columns == frame(spark).columns
        kept.append(sorted(repr(r["doc_id"]) for r in df.collect()))
    toxic, exact, near, _ = kept
    # Labels of SF aren't about these ids' texts; none of the texts is like a toxic one there but in its words.
    assert set(exact) <= set(toxic) and set(near) <= set(exact) and near.count("15") == 2 and "6" not in exact and "9" not in exact
    pieces = corpus_pipeline.STAGES[-1][1](spark, df, SF)
    assert {repr(r["doc_id"]) for r in pieces.collect()} == set(kept[-1])


def test_pipeline_takes_an_empty_table(spark):
    df = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, SF)
    assert df.count() == 0
