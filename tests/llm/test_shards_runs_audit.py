"""Sharding, periodic runs and the filter audit against plain versions."""

import hashlib
import itertools
import random
import re
from collections import Counter
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import filter_audit, periodic_runs, sharding
from tidemark.llm.common import QUERIES
from tidemark.staging import Staging

SF = "/root/testdata/sf0.001"
BIG = 2**53


# sharding


def plain_shards(rows, shards):
    """(id, shard, slot) by sorting everything in one list."""
    sources = {}
    for doc_id, text, source in rows:
        key = int(hashlib.md5(f"{sharding.SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:15], 16)
        body = (text or "").encode()
        sources.setdefault((source or "", source is None), []).append((key, crc32(body), len(body) + 16, doc_id))
    spread = []
    for source, held in sources.items():
        for k, row in enumerate(sorted(held, key=lambda r: r[:3]), 1):
            spread.append(((2 * k - 1) / (2 * len(held)), source, row))
    spread.sort(key=lambda r: (r[0], r[1], r[2][:3]))
    out, filled = [], Counter()
    for at, (_, _, row) in enumerate(spread):
        shard = at * shards // len(spread)
        out.append((row[3], row[2], row[1], shard, filled[shard]))
        filled[shard] += 1
    return out


def by_text(rows):
    return sorted(rows, key=str)


def test_shards_equal_the_plain_version(spark, awkward, uncoalesced):
    rows = [(r.doc_id, r.text, r.source) for r in awkward.select("doc_id", "text", "source").collect()]
    for shards in (1, 3, 40):
        found = sharding.shard_rows(Staging(spark), awkward, shards)
        assert by_text(map(tuple, found.collect())) == by_text(plain_shards(rows, shards))


def test_hot_source_and_repeated_rows(spark, uncoalesced):
    rows = [(BIG + 2 * k + 1 if k % 7 else None, "same text" if k % 3 else f"text {k}", "hot" if k % 3 else f"s{k % 5}") for k in range(3000)]
    rows += [(5, "again", None)] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    found = [tuple(r) for r in sharding.shard_rows(Staging(spark), df).collect()]
    assert by_text(found) == by_text(plain_shards(rows, 40))
    counts = Counter(r[3] for r in found)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    hot = Counter(r[3] for r in found if r[2] == crc32(b"same text"))
    assert len(hot) == 40 and max(hot.values()) - min(hot.values()) <= 7


def test_every_shard_has_the_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = sharding.shard_rows(Staging(spark), docs, 8).join(docs.select("doc_id", "source"), "doc_id")
    total = Counter(r.source for r in docs.collect())
    shard = Counter((r.shard, r.source) for r in found.collect())
    for source, n in total.items():
        for k in range(8):
            assert abs(shard[k, source] - n / 8) <= 1 + len(total) / 2 * n / sum(total.values()) + 1


def test_written_shards_hold_all_columns_in_slot_order(spark, awkward, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(Staging(spark), awkward, path, 3)
    back = spark.read.parquet(path)
    assert set(back.columns) == {*awkward.columns, "shard", "slot"}
    assert by_text(map(tuple, back.select(*awkward.columns).collect())) == by_text(map(tuple, awkward.collect()))
    for k in range(3):
        assert sorted(r.slot for r in back.where(f"shard = {k}").collect()) == list(range(back.where(f"shard = {k}").count()))


def test_shards_of_nothing(spark, nothing):
    assert sharding.shard_rows(Staging(spark), nothing).count() == 0


# periodic runs


def plain_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i if j > i else 0
            stretch = words[i : i + length]
            if length >= max(6, 4 * q) and not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found)


def made_up_words(r):
    letters = r.choice([1, 2, 3, 6])
    word = lambda: str(r.randrange(letters)).encode()
    words = [word() for _ in range(r.randrange(90))]
    for _ in range(r.randrange(4)):
        part = [word() for _ in range(r.randrange(1, 30))]
        words += (part * r.randrange(2, 9))[: r.randrange(1, 200)] + [word() for _ in range(r.randrange(5))]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_the_plain_version(seed):
    r = random.Random(seed)
    texts = [made_up_words(r) for _ in range(400)]
    assert sum(map(len, found := periodic_runs.runs_of(texts))) > 100
    assert found == [plain_runs(words) for words in texts]


def test_long_periods_in_a_long_text():
    r = random.Random(3)
    fresh = lambda n: [str(r.randrange(50)).encode() for _ in range(n)]
    words, at = fresh(700), []
    for period, times in ((1, 9), (97, 4), (256, 5), (255, 4), (1000, 4)):
        part = fresh(period)
        at.append((len(words), period, period * times))
        words += part * times + fresh(300)
    found = periodic_runs.runs_of([words])[0]
    assert len(found) == len(at)
    for (start, length, q), (planted_at, period, planted_length) in zip(found, at, strict=True):
        assert q == period and start <= planted_at and start + length >= planted_at + planted_length


def test_selected_positions_depend_on_their_words_alone():
    r = np.random.default_rng(5)
    names = r.integers(0, 2**63, 400).astype(np.uint64)
    twice = np.concatenate([names[:100], names, names[50:]])
    none = np.zeros(len(twice), bool)
    for scale in (2, 8, 32):
        at = set(periodic_runs.synchronising(twice, none, scale).tolist())
        first = {i for i in at if 120 <= i < 480 - scale}
        assert all(not set(range(i, i + scale)).isdisjoint(at) for i in range(len(twice) - 2 * scale))
        alone = set((periodic_runs.synchronising(names, none[:400], scale) + 100).tolist())
        assert first == {i for i in alone if 120 <= i < 480 - scale}


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a, original = g % n, list(words)
        p = 1 + (n - a) // (3 + g % 8)
        for i in range(a, n):
            words[i] = original[a + (i - a) % p]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None, digest(lines), digest(rest))


def test_query_of_runs_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF).collect()]
    assert sorted(found) == sorted(plain_row(r.doc_id, r.text) for r in docs)


def test_runs_of_awkward_rows(spark, awkward, nothing):
    found = periodic_runs.periodic_runs(awkward)
    assert found.columns[:2] == ["doc_id", "n_runs"] and found.count() == awkward.count()
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[2].n_runs == 0 and by_id[2].start is None
    assert by_id[6].n_runs == 1 and by_id[6].period == 10 and by_id[6].length == 15000
    assert periodic_runs.periodic_runs(nothing).count() == 0


def test_ids_come_back_unchanged(spark):
    rows = [(BIG + 1, "a b"), (None, "c " * 9), (BIG + 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert [r.doc_id for r in periodic_runs.periodic_runs(df, plant=True).collect()] == [BIG + 1, None, BIG + 3]
    names = df.selectExpr("cast(doc_id as string) AS name", "text")
    assert [r.name for r in periodic_runs.periodic_runs(names, "name").collect()] == [str(BIG + 1), None, str(BIG + 3)]


def test_blocks_are_bounded_by_their_text(monkeypatch):
    monkeypatch.setattr(periodic_runs, "GATHER", 50)
    texts = pa.array([b"a " * 30, None, b"", b"b " * 10, b"c", b"d" * 40])
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), texts], names=["id", "text"])
    assert [b.num_rows for b in periodic_runs.blocks(batch)] == [1, 4, 1]


# filter audit


def plain_audit(docs, labels):
    masks = {}
    texts = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            texts[text or ""] = min(doc_id, texts.get(text or "", doc_id))
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in range(2))
    for doc_id, text, source in docs:
        body = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", body)
        least = texts.get(body)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", body)) > 5 * len(body),
            "D": bool(re.search(r"[#$%&*|]", body)),
            "E": least is not None and (doc_id is None or least < doc_id),
        }
        masks.setdefault(source or "", []).append(({f for f in fails if fails[f]}, doc_id in good, doc_id in toxic))
    out = []
    for part, rows in masks.items():
        removed_by = Counter()
        lines = []
        for order in itertools.permutations("ABCDE"):
            for step, own in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [r for r in rows if own in r[0] and not r[0] & before]
                removed_by[own] += len(gone)
                kept = sum(not r[0] & (before | {own}) for r in rows)
                redundant = sum(own in r[0] and bool(r[0] & before) for r in rows)
                alone = sum(r[0] == {own} for r in rows)
                lines.append((part, "".join(order), step, kept, len(gone), redundant, alone, sum(r[1] for r in gone), sum(r[2] for r in gone), own))
        out += [(*line[:-1], removed_by[line[-1]]) for line in lines]
    return sorted(out)


LABELS = [(1, 1, 0), (5, None, 1), (5, 1, None), (6, 0, 0), (None, 1, 1), (7, 1, 1), (99, 1, 1)]


def test_audit_equals_the_plain_version(spark, awkward, uncoalesced):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    docs = [(r.doc_id, r.text, r.source) for r in awkward.select("doc_id", "text", "source").collect()]
    found = filter_audit.filter_audit(Staging(spark), awkward, labels)
    assert sorted(map(tuple, found.collect())) == plain_audit(docs, LABELS)


def test_audit_of_many_copies(spark, uncoalesced):
    docs = [(None if k % 5 == 0 else BIG + 2 * k + 1, "hot copy " * 30 if k % 3 else f"Text {k // 9} of few", f"s{k % 2}") for k in range(1500)]
    labels = [(BIG + 2 * k + 1, k % 2, k % 4 == 0) for k in range(0, 1500, 3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(7)
    marks = spark.createDataFrame([(i, int(q), int(t)) for i, q, t in labels], "doc_id long, quality int, toxic int")
    found = filter_audit.filter_audit(Staging(spark), df, marks)
    assert sorted(map(tuple, found.collect())) == plain_audit(docs, labels)


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    docs = [(k, f"text {k // 2 if k % 4 else k} of it", "s") for k in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(filter_audit, "MOST_COUNTERS", 128)
    assert sorted(map(tuple, filter_audit.filter_audit(Staging(spark), df, none).collect())) == plain_audit(docs, [])


def test_sketch_clears_unique_texts_alone(spark):
    texts = [f"text {k}" for k in range(3000)] + ["copy"] * 1000
    rows = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("xxhash64(text) AS hash").repartition(5)
    flags = {r.word: r.again for r in filter_audit.repeated_counters(Staging(spark), rows, 1024).collect()}
    word, bits = filter_audit.raised(filter_audit.F.col("hash"), 1024)
    marked = [(r.word, r.bits) for r in rows.select(word, bits).collect()]
    counts = Counter((w, b) for w, bits in marked for b in range(64) if bits >> b & 1)
    assert {(w, b) for w, again in flags.items() for b in range(64) if again >> b & 1} == {at for at, n in counts.items() if n > 1}


def test_audit_of_nothing(spark, nothing):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(Staging(spark), nothing, labels).count() == 0
