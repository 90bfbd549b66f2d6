"""Text operators against brute force, round trips and held-out accuracy."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.conftest import CLASHES, SCHEMA
from tidemark.llm import byte_bpe, language_id, license_scan, packing, pii, secret_scan, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


# byte-level BPE


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("longest", [6, 20, 200])
def test_bpe_equals_tiktoken_on_random_texts(tiktoken_encoding, longest):
    rng = random.Random(longest)
    letters = " '\n\t\x0b\x85 　 stlrevmdaZ09.,!é中ñ١_-\x1cćİ🙂"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(longest))) for _ in range(3000)]
    for text, found in zip(texts, byte_bpe.encode(texts, RANKS), strict=True):
        assert [int(i) for _, ids, _ in found for i in ids.split()] == tiktoken_encoding.encode_ordinary(text), text
        assert b"".join(raw for _, _, raw in found).decode() == text


def test_bpe_merges_long_slices_alike(tiktoken_encoding):
    text = "".join(random.Random(1).choice("abcthe") for _ in range(3000))
    assert byte_bpe.codec(RANKS).merge(text.encode()) == tiktoken_encoding.encode_ordinary(text)


def test_scan_of_transition_functions_equals_a_loop():
    rng = np.random.default_rng(5)
    functions = rng.integers(0, byte_bpe.STATES, (10_000, byte_bpe.STATES)).astype(np.uint8)
    want, state = [], 0
    for f in functions:
        want.append(state)
        state = f[state]
    assert byte_bpe._scan(functions, np.uint8(0)).tolist() == want


def test_bpe_awkward(awkward, nothing, tiktoken_encoding):
    found = byte_bpe.encoded(awkward, RANKS).collect()
    assert len(found) == 11 and byte_bpe.encoded(nothing, RANKS).count() == 0
    texts = {r.doc_id: r.text or "" for r in awkward.collect() if r.doc_id}
    for r in found:
        if r.doc_id:
            ids = tiktoken_encoding.encode_ordinary(texts[r.doc_id])
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# packing


def test_word_ids_equal_whole_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rng, mine = random.Random(4), packing.WordIds(path)
    letters = " \t\n\x1c\x85 éÉAİΣσs'tlve1²中<|endoftext|>.,̈ﬁ"
    for _ in range(2000):
        parts = ["".join(rng.choice(letters) for _ in range(rng.randrange(20))) for _ in range(rng.randrange(1, 4))]
        text = rng.choice(["", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", " <|endoftext|>.", "<|endoftext|><|endoftext|>"]).join(parts)
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_packing_is_gapless_and_whole(spark, staging):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    cut = packing.pieces(documents(spark), path, with_ids=True)
    packed = packing.pack(staging, cut, group=64)
    rows = packed.collect()
    whole = Tokenizer.from_file(path)
    texts = {r.doc_id: r.text or "" for r in documents(spark).collect()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
    assert by_doc.keys() == texts.keys()
    for doc_id, parts in by_doc.items():
        parts.sort(key=lambda r: r.piece)
        assert [r.length for r in parts[:-1]] == [2048] * (len(parts) - 1)
        ids = np.frombuffer(b"".join(r.ids for r in parts), "<u4").tolist()
        assert ids == [*whole.encode(texts[doc_id], add_special_tokens=False).ids, 0]
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0, *(r.length for r in parts[:-1])]).tolist()
        assert sum(r.length for r in parts) <= 2048
    least = -(-sum(r.length for r in rows) // 2048)
    assert len(by_sequence) <= least + -(-len(rows) // 64) + 1
    assembled = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert assembled == {k: b"".join(r.ids for r in parts) for k, parts in by_sequence.items()}


def test_local_search_empties_bins_by_swaps_and_moves():
    lengths = [55, 40, 60, 45]
    after = packing.improve([[0, 1], [2], [3]], lengths, 100)
    assert sorted(sorted(lengths[i] for i in b) for b in after) == [[40, 60], [45, 55]]
    offers = lambda *items: packing.Offers(list(items), [50, 30, 25, 60, 20, 15])
    taken, given = packing.exchange(offers(0), offers(1, 2), 10)
    assert (sorted(taken), given) == ([1, 2], [0])
    assert packing.exchange(offers(3), offers(4, 5), 40) == ([4], [])
    rng = random.Random(3)
    for _ in range(50):
        lengths = [rng.randrange(1, 90) for _ in range(60)]
        before = packing.best_fit(lengths, 100)
        after = packing.improve([list(b) for b in before], lengths, 100)
        assert sorted(i for b in after for i in b) == list(range(60)) and len(after) <= len(before)
        assert all(0 < sum(lengths[i] for i in b) <= 100 for b in after)


def test_pairs_of_all_items_are_offered():
    lengths = [1] * 40 + [3] * 40 + [700, 710, 5, 9]
    offers = packing.Offers(list(range(len(lengths))), lengths)
    assert offers.pair(1410) == (1410, [80, 81]) and offers.pair(1409)[0] == 719
    assert offers.pair(2)[0] == 2 and offers.pair(1) == (0, []) and offers.single(8)[0] == 5


def test_packing_awkward(awkward, nothing, staging):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(staging, packing.pieces(awkward, path)).collect()
    assert sum(r.doc_id is None for r in rows) == 2
    assert [r.length for r in rows if r.doc_id == 2] == [1]
    assert packing.pack(staging, packing.pieces(nothing, path)).count() == 0


# licences


def brute_licences(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    return len(words), sorted((k, i) for k, p in phrases.items() for i in range(len(words)) if words[i : i + len(p)] == p)


def test_licences_against_brute_force(spark):
    rng = random.Random(8)
    bits = "cc by CC-BY all rights All Rights reserved. general public license GENERAL PUBLIC LICENSE v3 gnu mit the x É".split()
    rows = [(i, " ".join(rng.choices(bits, k=rng.randrange(40))), "en", "s") for i in range(300)]
    for r in license_scan.scan(spark.createDataFrame(rows, SCHEMA)).collect():
        n, places = brute_licences(rows[r.doc_id][1])
        base = sorted((p.label, p.start) for p in r.places if p.label in ("cc-by", "gpl", "reserved"))
        assert (r.n_words, base) == (n, places)


def test_licences_of_whole_lines_and_awkward_texts(spark, awkward, nothing):
    rows = [(1, "Released under the MIT License.", "en", "s"), (2, "the mit, a license", "en", "s"), (3, "This work is licensed under the GNU General Public License, version 3.", "en", "s")]
    found = {r.doc_id: {p.label: p.coverage for p in r.places} for r in license_scan.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[1] == {"mit": 1.0} and found[2] == {}
    assert found[3]["gpl-3"] == 1.0 and found[3]["gpl"] == 1.0
    usual = """MIT License

    Copyright (c) 2020 Someone

    Permission is hereby granted, free of charge, to any person obtaining a copy
    of this software and associated documentation files (the "Software"), to deal
    in the Software without restriction"""
    fee = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
    rows = [(1, usual, "en", "s"), (2, fee, "en", "s"), (3, usual.replace("free of", "for a"), "en", "s"), (4, usual + usual, "en", "s")]
    found = {r.doc_id: sorted((p.label, p.start, p.coverage > 0.8) for p in r.places) for r in license_scan.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {1: [("mit", 6, True)], 2: [("isc", 10, True)], 3: [], 4: [("mit", 6, True), ("mit", 40, True)]}
    assert all(not r.places for r in license_scan.scan(awkward).collect())
    assert license_scan.scan(nothing).count() == 0


# secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(("assign", "access", "hex")[k], i, j) for i, k, j in sorted(found)]


def test_secrets_against_brute_force(spark, staging):
    rng = random.Random(6)
    bits = ["token", "PassWord", "secret", "api_key", "=", ": ", '"', "'", " ", "é🙂", "AKIA", "ABCDEF0123456789", "0123456789abcdef", "deadbeef", "x", "abcdefghijkl"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randrange(25))), "en", f"s{i % 3}") for i in range(400)]
    for r in secret_scan.scan(staging, spark.createDataFrame(rows, SCHEMA)).collect():
        base = [(s.kind, s.start, s.end) for s in r.spans or [] if s.kind != "bare"]
        assert base == brute_secrets(rows[r.doc_id][1])


def test_owners_part_examples_from_live_values(spark, staging):
    copied, own, bare = "token = examplevalue0000", "token = ownervalue1111", "Zk3Qw9Er7Tb5Yn2Um4Ix6Op8As1D"
    rows = [(i, f"some {copied} here", "en", f"s{i}") for i in range(4)] + [(9, f"my {own} and {bare} and {copied}", "en", "s9"), (10, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r.spans for r in secret_scan.scan(staging, docs).collect()}
    assert [(s.value, s.live, s.owners) for s in found[9]] == [("ownervalue1111", True, 1), (bare, True, 1), ("examplevalue0000", False, 5)]
    masked = {r.doc_id: r.text for r in secret_scan.mask_live(staging, docs).collect()}
    assert masked[9] == f"my token = [secret] and [secret] and {copied}"
    assert masked[0] == rows[0][1] and masked[10] is None


def test_secrets_awkward(awkward, nothing, staging):
    assert [r.spans for r in secret_scan.scan(staging, awkward).collect()] == [None] * 11
    masked = secret_scan.mask_live(staging, awkward)
    assert masked.columns == awkward.columns
    assert sorted(map(str, masked.collect())) == sorted(map(str, awkward.collect()))
    assert secret_scan.scan(staging, nothing).count() == 0 == secret_scan.mask_live(staging, nothing).count()


# personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP, CARD = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_pii(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def checks(s):
        return sum((d if k % 2 == 0 else 2 * d - 9 * (d > 4)) for k, d in enumerate(map(int, reversed(s)))) % 10 == 0

    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) < 256 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and checks(digits(m[0]))]
    return found + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


@pytest.mark.parametrize("letters", ["a@.b-1", "1. 2-+()", "0123456789 -", "+1 (2).-a@b.c"])
def test_base_spans_against_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        assert pii.base_spans(text) == brute_pii(text), text


def test_contexts_reveal_what_the_base_misses(spark, staging):
    valid = ["4111111111111111", "5500005555555559", "4012888888881881", "378282246310005", "6011111111111117", "3530111333300000", "5105105105105100", "4222222222222220000"]
    valid = [v for v in valid if pii.luhn(v)] + [f"{n}{next(d for d in '0123456789' if pii.luhn(f'{n}{d}'))}" for n in range(40000000000000, 40000000000030)]
    rows = [(i, f"billed to card number {v} today", "en", "s") for i, v in enumerate(valid)]
    rows += [(900, "billed to card number 4111111111111112 today", "en", "s"), (901, "part 4111111111111113 of it", "en", "s")]
    found = {r.doc_id: r for r in pii.find(staging, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[900].spans == "found_card:22:38" and found[900].n_found == 1
    assert found[901].spans == "" and found[0].spans == found[0].base


def test_contexts_reveal_values_with_spaces_and_obfuscated_mail(spark, staging):
    card = lambda n: f"{n}{next(d for d in '0123456789' if pii.luhn(f'{n}{d}'))}"
    known = [("billed to card number", [card(n) for n in range(400000000000000, 400000000000030)])]
    known += [("reach me on phone", [f"+4917155501{n}" for n in range(10, 40)]), ("write to mail", [f"user{n}@example.com" for n in range(30)])]
    unseen = [("billed to card number", "card", "4111 1111 1111 1112"), ("billed to card number", "card", "4111-1111 1111-1112")]
    unseen += [("reach me on phone", "phone", v) for v in ("0171 555 0142", "(555) 123-4567", "0171.555 0143", "(0171)5550144 22")]
    unseen += [("write to mail", "email", v) for v in ("john[at]example.com", "john(at)example.com")]
    rows = [(1000 * k + n, f"{lead} {v} today", "en", "s") for k, (lead, values) in enumerate(known) for n, v in enumerate(values)]
    rows += [(9000 + n, f"{lead} {v} today", "en", "s") for n, (lead, _, v) in enumerate(unseen)]
    rows += [(9900, "part 4111 1111 1111 1113 of it, by john[at]example.org", "en", "s")]
    found = {r.doc_id: r.spans for r in pii.find(staging, spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {9000 + n: f"found_{kind}:{len(lead) + 1}:{len(lead) + 1 + len(v)}" for n, (lead, kind, v) in enumerate(unseen)}
    assert {i: s for i, s in found.items() if i >= 9000} == {**want, 9900: ""}


def test_pii_awkward(awkward, nothing, staging):
    assert [r.spans for r in pii.find(staging, awkward).collect()] == [""] * 11
    assert pii.find(staging, nothing).count() == 0


# language


def test_language_on_held_out_rows(spark):
    from tidemark.llm.common import QUERIES
    from tidemark.llm import queries  # noqa: F401

    truth = {r.doc_id: r.lang for r in documents(spark, "/root/testdata/sf0.01").collect()}
    found = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in found if r.held_out and truth[r.doc_id]]
    assert len(found) == 1000 and all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in found)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_awkward(awkward, nothing):
    net = language_id.train(awkward)
    found = {r.doc_id: r.lang_pred for r in language_id.predict(awkward, net, ["doc_id", "kept"]).collect()}
    assert [found[i] for i in (2, 3, 4)] == ["und"] * 3 and found[6] != "und"
    assert language_id.train(nothing) is None
    assert {r.lang_pred for r in language_id.predict(awkward, None, ["doc_id"]).collect()} == {"und"}
    assert language_id.predict(nothing, net, ["doc_id"]).count() == 0


# toxicity


def test_composed_automaton_tells_clauses_apart():
    grammar = toxicity.Grammar({})
    event = lambda text: {name for name, x in zip(toxicity.EVENTS, grammar.features(text), strict=False) if x}
    assert event("the idiot") == {"insult"}
    assert event("you idiot") == {"targeted"}
    assert event("you are not an idiot") == {"negated"}
    assert event("they said idiot") == {"reported"}
    assert event("not here. idiot") == {"insult"}
    assert event("i will kill it") == {"threat"} and event("never will kill") == {"softened"}
    assert event("kill time") == set() and event("") == set()


def test_toxicity_on_held_out_rows(spark):
    from tidemark.llm.common import QUERIES

    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = QUERIES["op8_toxicity"](spark, sf).collect()
    held = [(labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels]
    assert len(found) == 1000 and all(r.predicted == int(r.score >= 0.3) for r in found)
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_toxicity_awkward(spark, awkward, nothing, staging):
    marks = spark.createDataFrame([(1, 1), (6, 0), (7, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    for scorer in (toxicity.train(staging, awkward, marks), toxicity.train(staging, awkward, marks.limit(0))):
        found = toxicity.score(awkward, scorer, ["doc_id"]).collect()
        assert len(found) == 11 and all(0 <= r.score <= 1 for r in found)
        assert toxicity.score(nothing, scorer, ["doc_id"]).count() == 0
        assert toxicity.drop_toxic(awkward, scorer).columns == awkward.columns
    assert "score" in CLASHES
