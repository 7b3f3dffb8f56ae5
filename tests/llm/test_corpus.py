"""Filter interactions, collocations and language-model scores: brute force on small tables."""

import math
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from concordat.llm import collocations as phrases
from concordat.llm import mixing
from concordat.llm.collocations import collocations
from concordat.llm.interactions import audit, judged
from concordat.llm.mixing import lm_scores

SPACE = r"[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


# --- filter interactions

LONG = " ".join(f"w{i}" for i in range(120))
FILTERED = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (4, "Same same", None), (5, "same same same", ""), (6, None, "en"), (7, "", "en"), (8, "", None), (9, LONG + " #", "de"), (9, LONG + " #", "de"),
    (10, "A" * 300, "en"), (11, "x " * 150, "en"), (None, LONG, "en"), (None, LONG, None), (12, "w " * 40_000 + "END", "fr"), (13, LONG + "\x0bX\x1cY", "fr"), (14, LONG + " #", "en"),
]
MARKS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, 0, 1), (9, 1, 1), (11, None, 1), (None, 1, 1), (99, 1, 1)]


def failures(rows):
    first = {}
    for k, t, _ in rows:
        if k is not None:
            first[t or ""] = min(first.get(t or "", k), k)
    for k, t, lang in rows:
        t, w = t or "", words(t)
        yield k, lang or "", {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": k is not None and k > first[t],
        }


def test_interactions_match_the_filters_run_in_every_order(spark):
    docs = spark.createDataFrame([(*r, 1.5, "clash") for r in FILTERED], "doc_id long, text string, lang string, rows double, part string")
    labels = spark.createDataFrame(MARKS, "doc_id long, quality int, toxic int")
    good, toxic = {k for k, q, _ in MARKS if k and q == 1}, {k for k, _, x in MARKS if k and x == 1}
    want, shares, rows = {}, Counter(), list(failures(FILTERED))
    for part in {p for _, p, _ in rows}:
        for order in permutations("ABCDE"):
            left = [(k, f) for k, p, f in rows if p == part]
            for step, x in enumerate(order, 1):
                gone = [(k, f) for k, f in left if f[x]]
                left = [(k, f) for k, f in left if not f[x]]
                mine = [f for _, p, f in rows if p == part and f[x]]
                shares[part, x] += len(gone)
                want[part, "".join(order), step] = (len(left), len(gone), len(mine) - len(gone), sum(sum(f.values()) == 1 for f in mine), sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone))
    got = audit(judged(docs, labels)).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost) == want[r.part, r.filter_order, r.step]
        assert r.filter == r.filter_order[r.step - 1] and r.shapley == shares[r.part, r.filter]


def test_interactions_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert audit(judged(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int"))).collect() == []


# --- collocations


def brute_collocations(rows, least, most):
    f, size = {}, Counter()
    for text, lang in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            size[lang or "und"] += len(w)
            for m in (1, 2, 3):
                for i in range(len(w) - m + 1):
                    f.setdefault(lang or "und", Counter())[tuple(w[i : i + m])] += 1
    out = []
    for lang, n in f.items():
        frequent = {p: a for p, a in n.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in frequent.items()):
                continue
            score, k = min((1000000 * a * a // (n[p[:k]] * n[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), n[p[:k]], n[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, size[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(7)
    vocabulary = ["The", "of", "new", "york", "été", "x\x1cy", "a", "b", "中文", "of.", "New", "York,", "\t", "city\n"]
    rows = [(" ".join(rng.choice(vocabulary, rng.integers(0, 60))), [None, "en", "de", "und"][i % 4]) for i in range(80)]
    return rows + [(None, "en"), ("", None), ("new york city " * 3000, "en"), ("new york city", "fr"), ("same pair " * 4, "it"), ("same pair " * 4, "it"), (" .,;\n", "es")]


@pytest.mark.parametrize("held", [10, 1_000_000])
def test_collocations_match_brute_force(spark, texts, monkeypatch, held):
    monkeypatch.setattr(phrases, "HELD_ROWS", held)
    monkeypatch.setattr(phrases, "HELD_BUCKETS", held)
    docs = spark.createDataFrame([(*r, "clash", 1) for r in texts], "text string, lang string, phrase string, n int")
    for most in (2000, 3):
        got = sorted(tuple(r) for r in collocations(docs, least=4, most=most).collect())
        assert got == brute_collocations(texts, 4, most)


def test_collocations_of_nothing(spark):
    assert collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert collocations(spark.createDataFrame([(None, None), ("a b", "en")], "text string, lang string")).collect() == []


def test_scores_are_exact_where_products_pass_64_bits(spark):
    grams = spark.createDataFrame([("en", "a", 1, 4_000_000_007), ("en", "b", 1, 3_000_000_019), ("en", "a b", 2, 2_999_999_929)], "lang string, phrase string, words int, n long")
    (r,) = phrases.ranked_candidates(grams, spark.createDataFrame([("en", 8_000_000_000)], "lang string, words long"), 50, 10).collect()
    assert r.score == 1000000 * 2_999_999_929**2 // (4_000_000_007 * 3_000_000_019)


def test_bitmaps_mark_what_is_frequent(spark):
    grams = spark.createDataFrame([("en", w, 9) for w in ("the", "the end", "中 文 x")] + [("de", "the", 9)], "lang string, phrase string, n long")
    bits = phrases.marked(grams, 5)
    assert np.unpackbits(bits).sum() == 4
    import pyarrow as pa

    held = phrases.Words(pa.array(["the end. 中 文 x"]), pa.array(["en"]))
    assert phrases.holds(bits, held.grams(1)).tolist() == [True, False, False, False, False]
    assert phrases.holds(bits, held.grams(2)).tolist() == [True, False, False, False] and phrases.holds(bits, held.grams(3)).tolist() == [False, False, True]


# --- language-model scores


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def is_held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    english, german = ["the", "of", "and", "in", "house", "ing", "ther"], ["der", "die", "und", "von", "haus", "lich", "übung"]
    rows = []
    for i in range(160):
        vocabulary = english if i % 2 else german
        rows.append((i, " ".join("".join(rng.choice(vocabulary, 1 + (rng.random() < 0.4))) for _ in range(60)).capitalize()))
    rows += [(None, "The end"), (None, None), (500, None), (501, ""), (502, "z" * 70_000 + " the"), (503, "A\x0bb\x1cc\x85d " * 3), (3, rows[3][1]), (504, "the " * 64), (505, "y" * 63 + " " + "y" * 64 + " " + "y" * 65)]
    docs = spark.createDataFrame([(*r, "clash", 2.0) for r in rows], "doc_id long, text string, score string, n_tokens double")
    return rows, lm_scores(docs).collect()


def test_base_scores_match_brute_force(scored):
    rows, got = scored
    trained = Counter(w for k, t in rows if not is_held(k) for w in [*words(lowered(t)), "\n"])
    n, different = sum(trained.values()), len(trained)
    want = Counter()
    for k, t in rows:
        tokens = [*words(lowered(t)), "\n"]
        base = sum(math.log10((trained[w] + 1) / (n + different + 1)) for w in tokens)
        want[k, is_held(k), len(tokens), sum(trained[w] > 0 for w in tokens), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want


def test_scores_are_better_than_the_base_and_alike_for_equal_texts(scored):
    rows, got = scored
    held = [r for r in got if r.held_out and r.n_tokens > 20]
    assert len(held) > 10 and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(-np.inf < r.score < 0 and r.bits_per_byte > 0 for r in got)
    assert len({round(r.score, 6) for r in got if r.n_tokens == 1}) == 1
    assert len({round(r.score, 6) for r in got if r.doc_id == 3}) == 1
    for (r,) in ([r for r in got if r.doc_id == 502], [r for r in got if r.doc_id == 505]):
        assert r.n_bytes == {502: 70_000 + 1 + 4 + 1, 505: 64 + 65 + 66 + 1}[r.doc_id]


def plain_contexts(item, topic):
    """Contexts of each byte of an item in plain words: whole beginnings, without and with the topic."""
    text, later = mixing.spelling(item), item[:1] == "\t"
    return [((later, text[:i]), (later, text[:i], topic)) for i in range(len(text))], text


def test_counts_across_stretches_match_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    items = {"".join(rng.choice(list("abé"), rng.integers(1, 7))) for _ in range(300)} | {"\n", "\x0b" + "a" * 70, "a" * 64, "\taaaaaa", "\tb", "\x1ca"}
    rows = [(x, t, int(rng.integers(0, 4))) for x in sorted(items) for t in range(3) if rng.random() < 0.6]
    tree = mixing.byte_tree(np.bincount(np.frombuffer("".join(items).encode(), np.uint8), minlength=256))
    monkeypatch.setattr(mixing, "STRETCH", 60)
    pairs = spark.createDataFrame(rows, "item string, topic int, c long").repartition(3)
    found, short = mixing.stretched(pairs, spark.sparkContext.broadcast(tree))
    seen, starts = Counter(), np.cumsum(tree.sizes) - tree.sizes
    for x, t, c in rows:
        contexts, text = plain_contexts(x, t)
        for both, byte in zip(contexts, text):
            for k in range(starts[byte], starts[byte] + tree.sizes[byte]):
                for context in both:
                    seen[context, int(tree.nodes[k]), bool(tree.bits[k])] += c
    table = found.toArrow()
    parts = sorted(set(table.column("part").to_pylist()))
    assert len(parts) > 5
    checked = 0
    import pyarrow as pa

    for p in parts:
        own = mixing.Evidence(tree, short.astype(np.float32), table.filter(pa.array([v == p for v in table.column("part").to_pylist()])))
        at = 0
        for x, t in zip(own.items, own.topic.tolist()):
            contexts, text = plain_contexts(x, t)
            for both, byte in zip(contexts, text):
                for k in range(starts[byte], starts[byte] + tree.sizes[byte]):
                    for n, context in zip(own.n[-2:, at], both):
                        assert n.tolist() == [seen[context, int(tree.nodes[k]), b] for b in (False, True)]
                    at += 1
        assert at == len(own.bits.bit)
        checked += at
    assert checked == sum(tree.sizes[b] for x, _, _ in rows for b in mixing.spelling(x))


def test_probabilities_of_bytes_add_up_to_one():
    rng = np.random.default_rng(1)
    tree = mixing.byte_tree(rng.integers(0, 50, 256))
    half = np.full(256, 0.0)
    for b in range(256):
        k = slice(int(tree.sizes[:b].sum()), int(tree.sizes[: b + 1].sum()))
        half[b] = 0.5 ** len(tree.nodes[k])
    assert abs(half.sum() - 1) < 1e-9
    paths = {tuple(zip(tree.nodes[k].tolist(), tree.bits[k].tolist())) for b in range(256) for k in [slice(int(tree.sizes[:b].sum()), int(tree.sizes[: b + 1].sum()))]}
    assert len(paths) == 256


def test_mixer_learns_what_a_plain_loop_learns():
    rng = np.random.default_rng(2)
    mixer, n = mixing.Mixer(), 500
    x, gate, node, bit, count = rng.normal(size=(n, mixing.PREDICTORS)), rng.integers(0, 3, n), rng.integers(0, 255, n), rng.random(n) < 0.5, rng.integers(1, 5, n).astype(float)
    w, squares = np.full((3, mixing.PREDICTORS), 0.3), np.full((3, mixing.PREDICTORS), 1e-6)
    for _ in range(3):
        mixer.learn(x, gate, node, bit, count)
        for g in range(3):
            slope = np.zeros(mixing.PREDICTORS)
            for i in np.flatnonzero(gate == g):
                slope += (bit[i] - 1 / (1 + math.exp(-float(w[g] @ x[i])))) * count[i] * x[i]
            slope /= count[gate == g].sum()
            squares[g] += slope**2
            w[g] += 0.1 * slope / np.sqrt(squares[g])
    assert np.allclose(mixer.w[:3], w) and np.isclose(mixer.maps.sum(), 3 * count.sum())


def test_topics_are_classes_of_words_that_lead_the_same_texts():
    import pyarrow as pa

    pairs = [("the", "the", 50), ("of", "of", 40), ("der", "der", 30), ("die", "die", 30), ("of", "the", 35), ("der", "die", 25), ("der", "the", 1)]
    classes = mixing.topic_classes(pairs)
    assert classes == {"the": 1, "of": 1, "der": 2, "die": 2} and mixing.topic_classes([]) == {}
    held = mixing.Texts(pa.array(["die x the of y", None, "The"]))
    assert held.topics(classes).tolist() == [0, 2, 2, 1, 1, 1, 0, 0, 1]


def test_scores_of_nothing_and_without_training(spark):
    schema = "doc_id long, text string"
    assert lm_scores(spark.createDataFrame([], schema)).collect() == []
    key = next(k for k in range(100) if is_held(k))
    (r,) = lm_scores(spark.createDataFrame([(key, "some words")], schema)).collect()
    assert r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 and r.score < 0


# --- large members of archives


@pytest.mark.parametrize("seed", range(4))
def test_a_large_member_is_parsed_as_it_is_inflated(monkeypatch, seed):
    import gzip
    import hashlib

    from concordat.llm import warc

    rng = np.random.default_rng(seed)

    def record(block):
        return b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Block-Digest: sha1:" + hashlib.sha1(block).hexdigest().encode() + b"\r\nContent-Length: " + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    blocks = [rng.bytes(int(rng.integers(0, 90_000))) + b"WARC/1.0\r\n" * int(rng.integers(0, 3)) for _ in range(12)]
    parts = list(map(record, blocks))
    for k in (3, 4, 9):
        if rng.random() < 0.7:  # a digest that differs, a length that is wrong
            parts[k] = parts[k].replace(b"sha1:", b"sha1:0", 1)[:-1] if rng.random() < 0.5 else parts[k].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    member = gzip.compress(b"".join(parts), 1)
    tell = lambda data: [(r.start, r.end, r.block) if isinstance(r, warc.Record) else r for r in warc.salvage(data)]
    archives = [member + gzip.compress(record(b"after")), member[: len(member) // 2], b"noise" + member[: len(member) // 3] + b"\x00" * 40 + member[len(member) // 3 :] + record(b"plain")]
    want = list(map(tell, archives))
    monkeypatch.setattr(warc, "MEMBER_BYTES", 1000)
    monkeypatch.setattr(warc, "WINDOW", 10_000)
    assert list(map(tell, archives)) == want and sum(len(x) for x in want) > 12
