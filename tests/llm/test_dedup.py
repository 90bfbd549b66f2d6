"""Exact, MinHash and embedding deduplication against brute force."""

import json
import os
import random
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import CLASHES, SCHEMA
from tidemark.llm import common, embedding_dedup, exact_dedup, minhash_dedup


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_a_path_a_star_and_a_cycle(spark, staging):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    found = common.components(staging, spark.createDataFrame(links, "a long, b long"))
    want = roots({x for link in links for x in link}, links)
    assert {r.node: r.component for r in found.collect()} == want


def test_components_of_nothing(spark, staging):
    assert common.components(staging, spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_awkward(awkward, staging):
    found = exact_dedup.exact_duplicates(staging, awkward).collect()
    assert len(found) == 11
    plain = [r for r in found if r.group_size == 4]
    assert {r.keep_id for r in plain} == {1} and [r.doc_id for r in plain if r.kept] == [1]
    empty = [r for r in found if r.keep_id == 2]
    assert len(empty) == 3 and sum(r.kept for r in empty) == 1
    assert Counter(r.kept for r in found)[True] == 6


@pytest.mark.parametrize("bits", [64, 2**16])
def test_exact_does_not_depend_on_the_filter(awkward, staging, monkeypatch, bits):
    monkeypatch.setattr(exact_dedup, "MOST_BITS", bits)
    found = exact_dedup.exact_duplicates(staging, awkward).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found)[(5, 1, 4)] == 2


def test_exact_of_nothing(nothing, staging):
    assert exact_dedup.exact_duplicates(staging, nothing).count() == 0


def test_drop_exact_keeps_columns_and_one_of_each(awkward, staging):
    left = exact_dedup.drop_exact_duplicates(staging, awkward)
    assert left.columns == awkward.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 4, 6, 7, 8]


def words(text, size):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1)) or (frozenset({tuple(found)}) if found else frozenset())


def corpus(seed, groups, copies):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randrange(4, 160))
        for _ in range(rng.randrange(1, copies)):
            text = [w if rng.random() > 0.02 * rng.random() * 2 else rng.choice(vocabulary) for w in base]
            rows.append((len(rows) + 1, " ".join(text), "en", "s"))
    return rows


def brute_components(rows, size, percent):
    sets = [(i, words(t, size)) for i, t, *_ in rows]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y and 100 * len(x & y) >= percent * len(x | y)]
    return roots([i for i, _ in sets], links)


@pytest.mark.parametrize("work", [minhash_dedup.WORK, 20_000])
def test_minhash_against_brute_force(spark, staging, work):
    rows = corpus(3, 60, 9) + [(1000 + i, t, "en", "s") for i, t in enumerate(["", "one", "One", "one two", None, "a b c"])]
    found = minhash_dedup.near_duplicates(staging, spark.createDataFrame(rows, SCHEMA), work=work).collect()
    want = brute_components(rows, 3, 85)
    assert {r.doc_id: r.component_id for r in found} == want
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(words(t, 3)) for i, t, *_ in rows}


def test_minhash_dense_region_is_compared_in_full(spark, staging, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "NEAR", 2)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(120):
        text = list(base)
        for _ in range(rng.randrange(6)):
            text[rng.randrange(80)] = f"x{rng.randrange(10**6)}"
        rows.append((i + 1, " ".join(text), "en", "s"))
    found = minhash_dedup.near_duplicates(staging, spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(rows, 3, 85)


def test_minhash_long_copies_of_a_cluster_beyond_work_stay_connected(spark, staging):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(1000):
        text = list(base)
        text[rng.randrange(400)] = f"x{i}"
        rows.append((i + 1, " ".join(text), "en", "s"))
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    found = minhash_dedup.near_duplicates(staging, docs, work=2_000_000).collect()
    assert {r.component_id for r in found} == {1} and len(found) == 1000


def test_exact_links_of_two_blocks_are_those_across():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.choice(60, 40).astype(np.uint64)) for _ in range(40)]
    links = [(i, j) for j in range(15, 40) for i in range(15) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 45 * len(np.union1d(sets[i], sets[j]))]
    want = roots(range(40), links)
    found = dict(zip(*minhash_dedup.exact_links(sets, np.arange(40), 45, 15), strict=True))
    assert links and {i: found.get(i, i) for i in range(40)} == want


def test_minhash_pairs_at_the_threshold_in_a_shared_passage(spark, staging):
    passage, rows = [f"p{i}" for i in range(80)], []
    for i in range(4000):
        own = [f"x{i}.{k}" for k in range(33)]
        rows.append((2 * i + 1, " ".join(passage + own), "en", "s"))
        if i < 200:
            for k in (5, 15, 25):
                own[k] = f"y{i}.{k}"
            rows.append((2 * i + 2, " ".join(passage + own), "en", "s"))
    assert 100 * len(words(rows[0][1], 3) & words(rows[1][1], 3)) == 85 * len(words(rows[0][1], 3) | words(rows[1][1], 3))
    found = minhash_dedup.near_duplicates(staging, spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i - 1 if i % 2 == 0 else i for i, *_ in rows}


def test_minhash_regions_beyond_a_block(spark, staging, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "REGION", 20)
    monkeypatch.setattr(minhash_dedup, "EXACT_REGION", 20)
    rows = corpus(5, 6, 60)
    found = minhash_dedup.near_duplicates(staging, spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(rows, 3, 85)


def test_minhash_without_a_deeper_level_compares_all_blocks(spark, staging, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "REGION", 20)
    monkeypatch.setattr(minhash_dedup, "EXACT_REGION", 20)
    monkeypatch.setattr(minhash_dedup, "MOST_ORDERS", 12)
    passage, rows = [f"p{i}" for i in range(90)], []
    for i in range(300):
        own = [f"x{i}.{k}" for k in range(23)]
        rows.append((2 * i + 1, " ".join(passage + own), "en", "s"))
        if i % 10 == 0:
            own[5] = own[15] = "y"
            rows.append((2 * i + 2, " ".join(passage + own), "en", "s"))
    assert [v.number for v in minhash_dedup.plan_levels(330, 85)] == [0]
    found = minhash_dedup.near_duplicates(staging, spark.createDataFrame(rows, SCHEMA), block=50).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(rows, 3, 85)


#: Near duplicates in a session of its own, whose event log tells what was shuffled.
LOGGED = """
import json, sys
from pathlib import Path
from pyspark.sql import SparkSession
from tidemark.llm import minhash_dedup
from tidemark.staging import Staging

folder = Path(sys.argv[1])
conf = {
    "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "3", "spark.checkpoint.dir": str(folder / "shared"), "spark.eventLog.enabled": "true",
    "spark.eventLog.dir": folder.as_uri(), "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
}
spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
minhash_dedup.REGION = 20
found = minhash_dedup.near_duplicates(Staging(spark), spark.read.parquet(str(folder / "documents"))).collect()
spark.stop()
events = [json.loads(line) for f in folder.glob("local-*") for line in f.open()]
metrics = [e["Task Metrics"]["Shuffle Write Metrics"] for e in events if e["Event"] == "SparkListenerTaskEnd"]
print(json.dumps({"shuffled": sum(m["Shuffle Bytes Written"] for m in metrics), "found": [(r.doc_id, r.component_id) for r in found]}))
"""


def test_minhash_deeper_regions_do_not_shuffle_all_texts(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(f"{rng.getrandbits(128):x}" for _ in range(600)), "en", "s") for i in range(400)]
    passage = [f"p{i}" for i in range(90)]
    crowd = [" ".join(passage + [f"x{i}.{k}" for k in range(23)]) for i in range(100)]
    rows += [(1000 + i, t, "en", "s") for i, t in enumerate(crowd + [f"{t} end" for t in crowd[:10]] + crowd[5:15])]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents"))
    run = subprocess.run([sys.executable, "-c", LOGGED, str(tmp_path)], stdout=subprocess.PIPE, env={**os.environ, "PYTHONPATH": os.pathsep.join(sys.path)}, check=True)
    seen = json.loads(run.stdout.splitlines()[-1])
    assert dict(seen["found"]) == brute_components(rows, 3, 85)
    assert 0 < seen["shuffled"] < sum(len(t) for _, t, *_ in rows) / 4


def test_region_keys_agree_as_often_as_their_texts():
    rng = np.random.default_rng(1)
    level = minhash_dedup.Level(1, 3, 400)
    base = np.unique(rng.integers(0, 2**63, 400, np.uint64))
    other = np.concatenate([base[:-36], rng.integers(0, 2**63, 36, np.uint64)])
    same = (minhash_dedup.region_keys(base, level) == minhash_dedup.region_keys(other, level)).mean()
    assert abs(same - (364 / 436) ** 3) < 0.08


def test_sketches_agree_where_hashes_do():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 256, (2, 500, minhash_dedup.HASHES)).astype(np.uint8)
    b[:, :60] = a[:, :60]
    pack = lambda rows: np.frombuffer(b"".join(minhash_dedup.sketch(r) for r in rows), np.uint64).reshape(-1, 4)
    assert minhash_dedup.agreeing(pack(a).T, pack(b).T).tolist() == (a % 4 == b % 4).sum(1).tolist()


def test_more_texts_take_deeper_regions_and_more_orders():
    few, many = minhash_dedup.plan_levels(1000, 85), minhash_dedup.plan_levels(10**8, 85)
    assert few[0][1:] == (2, 12) and few[0] < many[0] and len(few) > 3
    for percent in (20, 50, 80, 85, 100):
        for texts in (0, 10**5, 10**8, 10**11):
            levels = minhash_dedup.plan_levels(texts, percent)
            assert levels[0].depth * levels[0].orders <= minhash_dedup.HASHES
            assert all((1 - (percent / 100) ** v.depth) ** v.orders <= minhash_dedup.MISS for v in levels)
            assert all(a.depth < b.depth and a.orders <= b.orders for a, b in zip(levels, levels[1:], strict=False))


def test_minhash_awkward(awkward, nothing, staging):
    found = minhash_dedup.near_duplicates(staging, awkward).collect()
    assert len(found) == 11
    assert {r.component_id for r in found if r.n_shingles == 8} == {1}
    assert sum(r.kept_row for r in found if r.n_shingles == 8) == 1
    assert all(r.component_id == r.doc_id for r in found if r.n_shingles == 0)
    assert minhash_dedup.near_duplicates(staging, nothing).count() == 0


def test_drop_near_keeps_columns(awkward, nothing, staging):
    left = minhash_dedup.drop_near_duplicates(staging, awkward)
    assert left.columns == awkward.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 2, 3, 4, 6, 7, 8]
    assert minhash_dedup.drop_near_duplicates(staging, nothing).count() == 0


def vectors(rng):
    rows = []
    for label in (0, 1):
        centres = rng.standard_normal((12, 16))
        for centre in centres:
            for _ in range(rng.integers(1, 9)):
                rows.append((len(rows), (centre + rng.standard_normal(16) * 0.2).tolist(), label))
    rows += [(len(rows) + k, rows[0][1], 0) for k in range(5)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 16, [nan] + [1.0] * 15, [inf] + [1.0] * 15, [None] + [1.0] * 15, [1e200] * 16, [1e200] * 16, [1.0] * 3]
    rows += [(500 + k, v, 0) for k, v in enumerate(odd)]
    return [*rows, (600, rows[0][1], None), (601, rows[0][1], None), (0, rows[0][1], 0)]


@pytest.mark.parametrize("block", [embedding_dedup.BLOCK, 4])
def test_embeddings_against_brute_force(spark, staging, block):
    rows = vectors(np.random.default_rng(2))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", *[f"1 AS `{c}`" for c in CLASHES if c != "kept"])
    found = embedding_dedup.near_duplicates(staging, df, block=block).collect()
    good = lambda v: bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    count, links = Counter(), []
    for k, (i, v, a) in enumerate(rows):
        for j, w, b in rows[:k]:
            if a is not None and a == b and good(v) and good(w) and len(v) == len(w):
                x, y = np.array(v) / max(map(abs, v)), np.array(w) / max(map(abs, w))
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93:
                    count[k] += 1
                    count[rows.index((j, w, b))] += 1
                    links.append((i, j))
    want = roots({i for i, _, _ in rows}, links)
    assert Counter((r.vec_id, r.component_id) for r in found) == Counter((i, want[i]) for i, _, _ in rows)
    by_id = {i: count[k] for k, (i, _, _) in enumerate(rows) if i != 0}
    assert {r.vec_id: r.n_links for r in found if r.vec_id != 0} == by_id


@pytest.mark.parametrize("halved", [False, True])
def test_suspects_have_a_near_vector_that_they_met_in_no_earlier_table(halved):
    import pandas as pd

    rng = np.random.default_rng(8)
    base = rng.integers(0, 256, (12, 16), dtype=np.uint8)
    sketch = np.repeat(base, 6, axis=0)
    flips = rng.integers(0, 128, (len(sketch), 9))
    for row, places in zip(sketch, flips, strict=True):
        for place in places:
            row[place // 8] ^= 1 << (place % 8)
    codes = rng.integers(0, 3, (len(sketch), 4)).astype("<u4")
    first = rng.random(len(sketch)) < 0.5 if halved else np.ones(len(sketch), bool)
    group = pd.DataFrame({"rep": np.arange(len(sketch)), "t": 2, "low": 0, "high": int(halved), "first": first, "sketch": [r.tobytes() for r in sketch], "codes": [r.tobytes() for r in codes]})
    most = embedding_dedup.most_differing(0.93)
    differ = np.unpackbits(sketch, axis=1)[:, None] != np.unpackbits(sketch, axis=1)[None]
    near = (differ.sum(2) <= most) & (codes[:, None, :2] != codes[None, :, :2]).all(2) & ~np.eye(len(sketch), dtype=bool)
    if halved:
        near &= first[:, None] != first[None]
    found = embedding_dedup.suspects_in(group, most)
    assert sorted(found["rep"]) == np.flatnonzero(near.any(1)).tolist() and 0 < len(found) < len(sketch)


def test_sketches_keep_pairs_at_the_threshold():
    rng, planes = np.random.default_rng(4), np.random.default_rng(5).standard_normal((32, embedding_dedup.SIGNS))
    a = rng.standard_normal((2000, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, 32))
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    assert ((a @ planes > 0) != (b @ planes > 0)).sum(1).max() <= embedding_dedup.most_differing(0.93)


def test_embeddings_of_nothing(spark, staging):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(staging, df).count() == 0


def test_tables_follow_the_number_of_vectors():
    few, many = embedding_dedup.plan_tables(1000), embedding_dedup.plan_tables(10**8)
    assert few < many
    same = 1 - np.arccos(0.93) / np.pi
    assert (1 - same ** many[0]) ** many[1] <= embedding_dedup.MISS
