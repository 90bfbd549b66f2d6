"""Learned and iterative operators, and the pipeline, against plain versions that go row by row."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from tidemark.llm import language_id, packing, pii, secret_scan, toxicity
from tidemark.llm.common import table
from tidemark.staging import Staging, shared_root

SF = "/root/testdata/sf0.001"


# languages


def plain_language(net, text):
    """Language and mean probability by loops over windows, positions and filters."""
    if text is None or not any(map(str.isalpha, text)):
        return "und", 0.0
    data, w = text.encode(), {k: v.astype(float) for k, v in net.weights.items()}
    total, count = np.zeros(len(net.langs)), 0
    for at in range(0, len(data), language_id.WINDOW):
        part = data[at : at + language_id.WINDOW]
        window = part.ljust(language_id.WINDOW, b"\0")
        pooled = []
        for k in language_id.WIDTHS:
            responses = []
            for i in range(language_id.WINDOW - k + 1):
                span = np.concatenate([w["bytes"][b] for b in window[i : i + k]])
                responses.append(span @ w[f"w{k}"])
            pooled.append(np.max(responses, axis=0) + w[f"b{k}"])
        z = np.maximum(np.concatenate(pooled), 0) @ w["out"] + w["bias"]
        p = np.exp(z - z.max())
        total += len(part) * p / p.sum()
        count += len(part)
    mean = total / count
    return net.langs[int(mean.argmax())], float(mean.max())


def test_language_equals_the_plain_network(spark):
    net = language_id.Network(["de", "en", "fr"])
    net.start(np.random.default_rng(4))
    rng = random.Random(2)
    letters = "abc deé 中.1"
    texts = [None, "", "12 3", "x"] + ["".join(rng.choices(letters, k=rng.choice([3, 200, 256, 257, 900]))) for _ in range(25)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in language_id.predict(df, net, ["doc_id"]).collect():
        lang, share = plain_language(net, texts[r.doc_id])
        assert r.lang_pred == lang and r.score == pytest.approx(share, abs=2e-5)


def test_training_does_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = language_id.train(docs.coalesce(1), rows_per_lang=10)
    other = language_id.train(docs.repartition(5), rows_per_lang=10)
    assert one.langs == other.langs and all(np.array_equal(one.weights[k], other.weights[k]) for k in one.weights)


# personal data


def plain_bootstrap(seen):
    """Three rounds over dictionaries."""
    seed, kind, edges = {}, {}, set()
    for value, own, resembles, patterns in seen:
        for known, name in ((seed, own), (kind, resembles)):
            if name is not None:
                known[value] = max(name, known.get(value, name))
        edges |= {(value, pattern) for pattern in patterns}
    size = Counter(pattern for _, pattern in edges)
    alike = Counter((pattern, kind.get(value)) for value, pattern in edges)
    scores = {(v, k): 1.0 for v, k in seed.items()}
    for _ in range(pii.ROUNDS):
        sums, sure, scored = defaultdict(float), Counter(), Counter()
        for value, pattern in edges:
            for (v, k), score in scores.items():
                if v == value:
                    sums[pattern, k] += score
                    sure[pattern, k] += score >= pii.SCORE
                    scored[pattern, k] += 1
        trust = {(p, k): s / (scored[p, k] + size[p] - alike[p, k] + 2) for (p, k), s in sums.items() if sure[p, k] >= pii.SURE_INSTANCES and size[p] >= pii.SURE_INSTANCES}
        trust = {at: t for at, t in trust.items() if t >= pii.CONFIDENCE}
        doubt = defaultdict(lambda: 1.0)
        for value, pattern in edges:
            if value not in seed and (pattern, kind.get(value)) in trust:
                doubt[value, kind[value]] *= 1 - trust[pattern, kind[value]]
        scores = {**{(v, k): 1.0 for v, k in seed.items()}, **{at: 1 - d for at, d in doubt.items()}}
    return {(v, k): round(s, 9) for (v, k), s in scores.items() if s >= pii.SCORE and v not in seed}


@pytest.mark.parametrize("seed", range(3))
def test_bootstrap_equals_the_plain_rounds(spark, seed):
    rng = random.Random(seed)
    seen = []
    for k in range(400):
        good = k % 2 == 0
        patterns = [f"{'good' if good else 'any'}{rng.randrange(6)}" for _ in range(2)]
        known = rng.random() < (0.9 if good else 0.3)
        value = f"v{rng.randrange(300)}.{good}"
        seen.append((value, "phone" if known else None, rng.choice(["phone", "email"]) if not known else "phone", patterns))
    df = spark.createDataFrame(seen, "value string, seed string, kind string, patterns array<string>").repartition(5)
    found = {(r.value, r.kind): round(r.score, 9) for r in pii.bootstrap(Staging(spark), df).collect()}
    want = plain_bootstrap(seen)
    assert want and found == want


def test_contexts_find_again_what_the_base_is_not_told(spark):
    """Of the numbers in one context a part is written so that no base pattern sees it: the context finds these."""
    rng = random.Random(7)
    rows, hidden = [], {}
    for k in range(120):
        digits = "".join(rng.choices("0123456789", k=9))
        local = k % 4 == 0
        text = f"Some words before. Please call me at {digits if local else '+49 ' + digits} after lunch, {rng.choice(['dear', 'my'])} friend {k}."
        rows.append((k, text))
        if local:
            hidden[k] = (text.index(digits), text.index(digits) + 9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find(Staging(spark), df).collect()}
    again = sum(f"found_phone:{i}:{j}" in found[k] for k, (i, j) in hidden.items())
    assert again >= 0.9 * len(hidden)
    assert not any("found_" in found[k] for k in found if k not in hidden)


# toxicity


def plain_features(entries, text):
    """The clauses read by one transducer after the other, without composing them."""
    sums, best, clauses = [0.0] * len(toxicity.EVENTS), 0.0, 0
    grammar = toxicity.Grammar(entries)
    for clause in re.split(r"[.!?;:|\n]+", text.lower()):
        words = toxicity.WORD.findall(clause)
        clauses += bool(words)
        states, score = [0] * len(toxicity.GRAMMAR), 0.0
        symbols = [grammar.symbol(word) for word in words]
        for symbol, weight in symbols:
            held = set()
            for k, part in enumerate(toxicity.GRAMMAR):
                arcs = part.arcs.get(states[k], {})
                after, tag = arcs.get(symbol) or arcs.get(-1) or (states[k], None)
                states[k] = after
                held |= {tag} - {None}
            event = toxicity.event_of(symbol, frozenset(held))
            if event >= 0:
                weight = toxicity.weight_of(symbol, weight)
                sums[event] += weight
                score += weight if event in (0, 1, 4, 5) else weight / 2
        best = max(best, score)
    return [*(math.log1p(s) for s in sums), math.log1p(best), math.log1p(20 * sum(sums) / max(1, clauses))]


def test_features_equal_the_plain_transducers():
    rng = random.Random(3)
    words = "you are not an idiot he said will kill never stupid kind mildly grim piece of trash shut up go to hell waste space pay make .".split()
    entries = {"grim": 3.5, "mildly": 2.0, "kin*": 1.6}
    for _ in range(500):
        text = " ".join(rng.choices(words, k=rng.randrange(25)))
        assert toxicity.Grammar(entries).features(text) == pytest.approx(plain_features(entries, text))


# the pipeline


def brute_groups(texts, words=5, percent=80):
    """Smallest id reachable by links of shingle sets, all pairs compared."""
    sets = {}
    for doc_id, text in texts.items():
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        size = min(words, len(found))
        sets[doc_id] = {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()
    group = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    return group


def raw_matches(text):
    found = []
    for kind, pattern, least, part in (*secret_scan.BASE, secret_scan.BARE):
        found += [(kind, m.start(), m.end(), m[part]) for m in re.finditer(pattern, text) if len(m[part]) >= least]
    mixed = lambda v: all(len(re.findall(f"[{c}]", v)) >= n for c, n in (("0-9", 6), ("A-Z", 4), ("a-z", 4)))
    return [m for m in found if m[0] != "bare" or mixed(m[3])]


def masked(text, owners):
    found = raw_matches(text)
    base = [m for m in found if m[0] != "bare"]
    live = [m for m in found if len(owners[m[3]]) <= secret_scan.LIVE_OWNERS]
    live = [m for m in live if m[0] != "bare" or not any(b[1] < m[2] and m[1] < b[2] for b in base)]
    for value in sorted({m[3] for m in live}, key=len, reverse=True):
        text = text.replace(value, secret_scan.MASK)
    return text


def test_pipeline_equals_plain_stages(spark, staging):
    from tokenizers import Tokenizer

    docs = table(spark, SF, "documents")
    all_rows = {r.doc_id: r for r in docs.collect()}
    marks = toxicity.known_labels(table(spark, SF, "labels"))
    scorer = toxicity.train(Staging(spark), docs, marks)
    texts = {i: r.text for i, r in all_rows.items() if scorer.score(r.text or "") < toxicity.THRESHOLD}
    first = {}
    for i in sorted(texts):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i] or ""), i)
    texts = {i: texts[i] for i in first.values()}
    group = brute_groups({i: t or "" for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if group[i] == i}
    owners = defaultdict(set)
    for r in all_rows.values():
        for m in raw_matches(r.text or ""):
            owners[m[3]].add(r.source)
    texts = {i: masked(t or "", owners) for i, t in texts.items()}
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, t in texts.items():
        ids = [*whole.encode(t, add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            cut = ids[k : k + 2048]
            want[i, k // 2048] = (k, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    fill = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048
    assert len(texts) < len(all_rows) and any(secret_scan.MASK in t for t in texts.values())


def test_an_example_that_many_copied_stays_after_its_copies_went(spark):
    rows = [(k, f"Docs say: token = examplevalue{'0' * 6} here.", "en", f"s{k}") for k in range(5)] + [(9, "token = ownervalue111111", "en", "s9")]
    whole = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    left = whole.where("doc_id in (0, 9)")
    alone = {r.doc_id: r.text for r in secret_scan.mask_live(Staging(spark), left).collect()}
    known = {r.doc_id: r.text for r in secret_scan.mask_live(Staging(spark), left, census=whole).collect()}
    assert secret_scan.MASK in alone[0] and known[0] == rows[0][1]
    assert secret_scan.MASK in alone[9] and secret_scan.MASK in known[9]


def test_a_run_leaves_only_the_stages_results(spark):
    root = Path(shared_root(spark).removeprefix("file://"))
    before = set(root.iterdir())
    corpus_pipeline.run(spark, SF).count()
    (left,) = set(root.iterdir()) - before
    assert len(list(left.iterdir())) == len(corpus_pipeline.STAGES)
