"""Joins, vectors, scores, pages, archives and the pipeline: brute force, round trips and edge cases."""

import gzip
import hashlib

import numpy as np
import pytest

from concordat.llm.common import components
from concordat.llm.html import extract_main_text, main_text
from concordat.llm.itq import embedding_dedup
from concordat.llm.ngram import least_matches, ngram_join
from concordat.llm.quality import quality_scores
from concordat.llm.warc import as_records, parse_record, read_warc, salvage, write_warc


def linked_groups(sets, alike):
    links = {i: {j for j in sets if j != i and alike(sets[i], sets[j])} for i in sets}
    roots = {}
    for i in sorted(sets):
        todo = [i] if i not in roots else []
        while todo:
            u = todo.pop()
            if u not in roots:
                roots[u] = i
                todo += links[u]
    return links, roots


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (201, 200), (300, 300), (None, 5)]
    rows = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(rows[i] == 0 for i in [*range(41), 100]) and rows[200] == rows[201] == 200 and 300 not in rows


def test_pruning_keeps_what_may_still_be_similar():
    least = least_matches(0.8, 1e-6)
    assert least[0] == 0 and all(0 <= b - a <= 1 for a, b in zip(least, least[1:])) and 20 < least[80] < 64


def test_ngram_join_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    texts = {}
    for g in range(12):
        words = [f"w{x}" for x in rng.integers(0, 4000, 60)]
        for k in range(6):
            copy = list(words)
            for _ in range(int(rng.integers(0, 5))):
                copy[int(rng.integers(0, 60))] = f"n{rng.integers(0, 9999)}"
            texts[len(texts)] = " ".join(copy)
    texts |= {72: "short text", 73: "short  TEXT", 74: "", 75: None, 76: "   ", 77: texts[0], 78: texts[0] + " tail", 79: "é " * 30000}
    rows = [(i, t, "x", True) for i, t in texts.items()]
    got = {r.doc_id: r for r in ngram_join(spark.createDataFrame(rows, "doc_id long, text string, cls string, kept boolean")).collect()}
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links, roots = linked_groups(sets, lambda a, b: bool(a and b) and 5 * len(a & b) >= 4 * len(a | b))
    for i in texts:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(links[i]), roots[i], roots[i] == i)


def test_ngram_join_of_large_groups(spark, monkeypatch):
    import concordat.llm.ngram as ngram

    monkeypatch.setattr(ngram, "CHUNK", 16)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([*words[:40], f"x{i}", *words[41:]])) for i in range(70)]
    got = ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.n_links == 69 and r.component_id == 0 for r in got)  # 71 of 81 shingles shared


def test_ngram_join_of_nulls_and_nothing(spark):
    assert ngram_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = ngram_join(spark.createDataFrame([(None, "one two"), (5, "one two"), (5, "one two"), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.n_links, r.component_id or -1) for r in rows) == [(-1, 0, -1), (-1, 2, 5), (5, 2, 5), (5, 2, 5)]


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 32))
    near = x[:60] + 0.25 * rng.standard_normal((60, 32)) * np.linalg.norm(x[:60], axis=1, keepdims=True) / np.sqrt(32)
    every = np.vstack([x, near, x[:5], x[:3] * 7]).astype(np.float32)
    odd = [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0, 2.0], [2.0, 4.0]]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(every)] + [(1000 + i, v, "x") for i, v in enumerate(odd)]
    got = {r.vec_id: r for r in embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>, cls string")).collect()}
    u = every.astype(float) / np.linalg.norm(every.astype(float), axis=1, keepdims=True)
    close = u @ u.T >= 0.9
    truth = close.sum(1) - 1
    mine = np.array([got[i].n_links for i in range(len(every))])
    assert (mine <= truth).all() and mine.sum() >= 0.9 * truth.sum()
    assert all(got[1000 + i].n_links == 0 and got[1000 + i].component_id == 1000 + i for i in range(6))
    assert got[1006].n_links == 1 and got[1007].component_id == 1006
    assert embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_scores_tell_held_out_labels(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.85 * len(rows)


def test_scores_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, 2), (1, "", 2), (2, "same text", 2), (3, "same text", 2), (4, "w " * 250000, 2)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (2, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    assert len(got) == 5 and got[2].score == got[3].score and all(0 <= r.score <= 1 for r in got.values())
    assert quality_scores(docs.limit(0), labels.limit(0)).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Menu %d</a></ul></nav><div class="ad">Buy %d</div>
<article><h1>Head &amp; %d</h1><p><b>Bold %d.<br><p>Second   one &lt;x&gt;.</article><div id="comments"><p>nice</p></div><footer>&copy; foot</footer>"""


def test_pages(spark):
    rows = [(i, f"http://h{i % 2}.org/{i}", PAGE % (i, i, i, i), 1) for i in range(12)]
    rows += [(100, None, None, 1), (101, "::bad::", "", 1), (102, "http://h0.org/x", "just text", 1), (103, "http://z.org", '<div id="content"><h2>A</h2><p>Long enough text of the page itself.</div><div class="sidebar">x</div>', 1), (3, "http://h1.org/3", PAGE % (3, 3, 3, 3), 1)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id < 100:
            assert r.text == f"Head & {r.page_id}\n\nBold {r.page_id}.\n\nSecond one <x>."
        assert r.n_chars == len(r.text)
    texts = {r.page_id: r.text for r in got}
    assert texts[100] == texts[101] == "" and texts[102] == "just text" and texts[103] == "A\n\nLong enough text of the page itself."
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert main_text("<p>" * 3000 + "deep") == "deep"


def test_copies_keep_their_article_and_texts_repeat_by_place(spark):
    page = '<body><div id="content"><h2>%s</h2><p>%s</p><p>Same line</p></div></body>'
    copies = [(i, f"http://c.org/{i}", page % ("Head", "One long article that stands on three of the four pages.")) for i in range(3)]
    rows = [*copies, (3, "http://c.org/3", page % ("Other", "Another long article of a page that has no copy at all."))]
    rows += [(10 + i, f"http://m.org/{i}", page % (f"Head {i}", f"A long article number {i} of a host whose pages differ.")) for i in range(6)]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "Head\n\nOne long article that stands on three of the four pages.\n\nSame line" for i in range(3))
    assert all(got[10 + i] == f"Head {i}\n\nA long article number {i} of a host whose pages differ.\n\nSame line" for i in range(6))


def test_attributes_and_unclosed_elements_lose_no_text():
    for attribute in ('style="overflow:hidden"', 'aria-hidden="false"', 'class="overflow-hidden"', 'title="a hidden thing"', "data-x=hidden"):
        assert main_text(f"<body><div {attribute}><p>Text of the page.</p></div></body>") == "Text of the page."
    for attribute in ("hidden", 'hidden=""', "HIDDEN id=x"):
        assert main_text(f"<body><div><p>Text of the page.</p></div><div {attribute}><p>Not to be seen.</p></div></body>") == "Text of the page."
    for cut in ('<svg class="x"/>', "<svg class=x />", "<math/>", "<object />", "<div><button>Press</div>", "<div><noscript>No</div>", "<div><svg><title>x</div>"):
        assert main_text(f"<body><article><p>First part.</p>{cut}<p>Second part.</p></article></body>") == "First part.\n\nSecond part."
    assert main_text("<body><article><p>First part.</p><script>if (a < b) { '<p>no</p>' }</script><p>Second part.</p></article></body>") == "First part.\n\nSecond part."


def test_a_varied_host_is_not_capped(spark):
    odd = lambda i: "".join(chr(97 + int(d)) for d in f"{i:04d}")
    page = '<body><div id="wrap"><div class="strip">Offer %s of the day</div><div id="content"><p>A long article with the number %s in it, and some more words.</p></div></div>%s</body>'
    rows = [(i, f"http://v.org/{i}", page % (odd(i), odd(i), f'<b class="x"></b><div id="{odd(i)}"></div><ul id="{odd(i)}"></ul>')) for i in range(600)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 600 and all(r.text == f"A long article with the number {odd(r.page_id)} in it, and some more words." for r in got)


def test_a_record_with_a_very_long_url_is_read_back(spark, tmp_path):
    url = "http://h.org/" + "x" * 100_000
    write_warc(as_records(spark.createDataFrame([(1, url, "<p>Text.</p>")], "page_id long, url string, html string")), str(tmp_path / "long"))
    got = read_warc(spark, str(tmp_path / "long")).collect()
    assert [(r.kind, r.target_uri, r.payload.decode()) for r in got] == [("record", url, "<p>Text.</p>")]






def test_archives_round_trip(spark, tmp_path):
    same = "é" * 800
    rows = [(1, "http://a/1", same), (5, "http://a/5", same), (3, None, same), (7, "http://a/7", "small"), (8, "http://a/8", "small"), (9, "u", None), (10, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "u", same)]
    write_warc(as_records(spark.createDataFrame(rows, "page_id long, url string, html string")), str(tmp_path / "w"))
    back = read_warc(spark, str(tmp_path / "w")).collect()
    assert all(r.kind == "record" for r in back) and len(back) == len(rows)
    by = {r.record_id: r for r in back}
    for i, _, text in rows:
        r, payload = by[f"<urn:x-page:{'none' if i is None else i}>"], (text or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        revisits = text == same and i != 5
        assert (r.record_type, r.refers_to) == (("revisit", "<urn:x-page:5>") if revisits else ("response", None))
        assert revisits or bytes(r.payload) == payload
    none = spark.createDataFrame([], "page_id long, url string, html string")
    write_warc(as_records(none), str(tmp_path / "none"))
    assert read_warc(spark, str(tmp_path / "none")).count() == 0


def record(body, kind="resource"):
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\nContent-Length: {len(body)}\r\nWARC-Block-Digest: sha1:{hashlib.sha1(body).hexdigest()}\r\n\r\n".encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("zipped", [False, True])
def test_salvage_logs_gaps_and_goes_on(zipped):
    bodies = [b"first", b"WARC/1.1\r\nWARC-Type: x\r\n\r\n", b"third" * 50, b"fourth", b"fifth"]
    parts = [gzip.compress(record(b)) if zipped else record(b) for b in bodies]
    whole = b"".join(parts)
    assert [r.block for r in salvage(whole)] == bodies
    hurt = bytearray(whole)
    at = len(parts[0]) + len(parts[1]) + len(parts[2]) - 30
    hurt[at] ^= 0xFF
    found = list(salvage(bytes(hurt)))
    gaps = [x for x in found if isinstance(x, tuple)]
    assert [r.block for r in found if not isinstance(r, tuple)] == [bodies[0], bodies[1], bodies[3], bodies[4]]
    assert [(a, b) for a, b, _ in gaps] == [(len(parts[0]) + len(parts[1]), sum(map(len, parts[:3])))]
    cut_short = list(salvage(whole[:-10]))
    assert len([r for r in cut_short if not isinstance(r, tuple)]) == 4 and cut_short[-1][1] == len(whole) - 10
    noisy = b"noise \x1f\x8b\x08 noise" + whole
    assert list(salvage(noisy))[0][:2] == (0, len(noisy) - len(whole))
    assert list(salvage(b"")) == [] and isinstance(parse_record(b"x", 0), str)


def test_pipeline_stages_match_brute_force(spark, sf_dir, tmp_path):
    import corpus_pipeline as pipeline

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(150)
    extra = docs.where("doc_id = 3")
    docs.union(extra).coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in pipeline.STAGES:
        before, columns = docs, docs.columns
        docs = pipeline.durable(stage(spark, before, str(tmp_path)), "t")
        seen.append((name, before.count(), docs.count()))
        if name != "best-fit packing":
            assert docs.columns == columns
        if name == "n-gram Jaccard join":
            sets = {}
            for r in before.collect():
                w = r.text.lower().split()
                sets.setdefault(r.doc_id, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))})
            _, roots = linked_groups(sets, lambda a, b: 5 * len(a & b) >= 4 * len(a | b))
            assert sorted(r.doc_id for r in docs.collect()) == sorted(set(roots.values()))
    assert all(after <= before for name, before, after in seen[:3]) and seen[-1][2] >= seen[-1][1]
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    judged = pipeline.quality_rules(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    kept = {r.doc_id for r in judged.collect()}
    long_enough = {r.doc_id for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect() if len(r.text.split()) >= 20}
    assert (good & long_enough) <= kept


BIG = 1152921504606846977
PROSE = [" ".join(f"word{i * 50 + k}" for k in range(40)) + "." for i in range(8)]


def test_pipeline_stages_of_odd_rows(spark, tmp_path):
    import corpus_pipeline as pipeline

    spark.createDataFrame([(BIG, 1), (BIG + 1, 1), (5, 0), (None, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    names = "doc_id long, text string, n_words string, kept string, score string, predicted string, row string, key string, cls string, length string, rows string"
    rows = [(BIG, PROSE[0]), (None, PROSE[1]), (BIG + 1, PROSE[2]), (5, PROSE[3]), (5, PROSE[3]), (5, PROSE[4]), (1, PROSE[5]), (2, PROSE[5] + " tail"), (None, None), (7, ""), (8, PROSE[6] + " " + "long " * 3), (None, PROSE[5])]
    docs = spark.createDataFrame([(*r, *["mine"] * 9) for r in rows], names)
    for name, stage in pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path)).collect()
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        if name == "quality rules":
            assert sorted((r.doc_id or 0, r.text) for r in got) == sorted((i or 0, t) for i, t in rows if t)
        elif name == "quality classifier":
            assert {(r.doc_id, r.text) for r in got} <= set(rows)
        elif name == "n-gram Jaccard join":
            assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted([(BIG, PROSE[0]), (0, PROSE[1]), (BIG + 1, PROSE[2]), (5, PROSE[3]), (5, PROSE[4]), (1, PROSE[5]), (0, ""), (7, ""), rows[10]])
        else:
            assert sorted(r.doc_id or 0 for r in got) == sorted(i or 0 for i, _ in rows)
        if name != "best-fit packing":
            assert all(tuple(r)[2:] == ("mine",) * 9 for r in got), name


def test_big_ids_beside_nulls_stay_as_they_are(spark):
    import public_tokenizers

    from concordat.llm.bpe import encode_documents

    docs = spark.createDataFrame([(BIG, "some text"), (None, "some text"), (BIG + 2, None)], "doc_id long, text string").coalesce(1)
    for got in (
        encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
        ngram_join(docs),
        quality_scores(docs, spark.createDataFrame([(BIG, 1)], "doc_id long, quality int")),
    ):
        assert {r.doc_id for r in got.collect()} == {BIG, None, BIG + 2}
    assert {r.doc_id for r in encode_documents(docs.selectExpr("cast(doc_id as string) doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()} == {str(BIG), None, str(BIG + 2)}


def test_cores_count_what_brute_force_counts(spark, monkeypatch):
    import concordat.llm.itq as itq
    import concordat.llm.ngram as ngram

    monkeypatch.setattr(ngram, "CHUNK", 12)
    rng = np.random.default_rng(9)
    texts = {}
    for g in range(2):
        words = [f"g{g}w{i}" for i in range(120)]
        for k in range(60):
            copy = list(words)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(0, 120))] = f"n{rng.integers(0, 10**6)}"
            texts[len(texts)] = " ".join(copy)
    got = {r.doc_id: r for r in ngram_join(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(116)} for i, t in texts.items()}
    links, roots = linked_groups(sets, lambda a, b: 5 * len(a & b) >= 4 * len(a | b))
    for i in texts:
        assert (got[i].n_links, got[i].component_id) == (len(links[i]), roots[i])

    monkeypatch.setattr(itq, "CHUNK", 12)
    x = np.vstack([c + s * rng.standard_normal((50, 24)) for c, s in ((rng.standard_normal(24) * 3, 0.3), (rng.standard_normal(24) * 3, 0.9))])
    got = {r.vec_id: r for r in embedding_dedup(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    truth, mine = (u @ u.T >= 0.9).sum(1) - 1, np.array([got[i].n_links for i in range(len(x))])
    assert (mine <= truth).all() and mine.sum() >= 0.9 * truth.sum() and (mine[:50] == truth[:50]).all()


def test_no_damage_raises(spark):
    rng = np.random.default_rng(8)
    plain = record(b"first " * 20) + record("zweiter é".encode() * 30) + record(b"x")
    for whole in (plain, gzip.compress(plain), b"".join(gzip.compress(record(bytes([65 + i]) * 50)) for i in range(5))):
        for _ in range(400):
            hurt = bytearray(whole)
            for _ in range(int(rng.integers(1, 6))):
                hurt[int(rng.integers(0, len(hurt)))] = int(rng.integers(0, 256))
            hurt = bytes(hurt[: int(rng.integers(1, len(hurt) + 1))])
            spans = [(r.start, r.end) if not isinstance(r, tuple) else r[:2] for r in salvage(hurt)]
            assert all(0 <= a <= b <= len(hurt) for a, b in spans) and sum({s: s[1] - s[0] for s in spans}.values()) == len(hurt)
    for length in ("²", "9" * 5000, "-1", "1.0"):
        assert parse_record(f"WARC/1.1\r\nContent-Length: {length}\r\n\r\nx\r\n\r\n".encode(), 0) == "no length"


def test_a_damaged_member_gives_the_records_before_the_damage():
    bodies = [bytes([97 + i]) * 5000 + hashlib.sha512(bytes([i])).digest() * 40 for i in range(6)]
    whole = gzip.compress(b"".join(map(record, bodies)))
    cut_short = list(salvage(whole[: len(whole) // 2]))
    found = [r.block for r in cut_short if not isinstance(r, tuple)]
    assert 1 <= len(found) < 6 and found == bodies[: len(found)] and [x[2] for x in cut_short if isinstance(x, tuple)] == ["gzip member cut short"]
    parts = [record(b) for b in bodies]
    inside = gzip.compress(parts[0] + parts[1].replace(b"bbbb", b"bxbb", 1) + parts[2])
    found = list(salvage(inside))
    assert [r.block for r in found if not isinstance(r, tuple)] == [bodies[0], bodies[2]] and found[-1][:2] == (0, len(inside))


def test_archives_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    import os

    import concordat.llm.warc as warc

    monkeypatch.setattr(warc, "ARCHIVE", 40_000)
    rows = [(i, f"http://h/{i}", f"{i} " * (20 if i % 5 else 3000)) for i in range(60)]
    write_warc(as_records(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)), str(tmp_path / "b"), per_file=20)
    sizes = [os.path.getsize(tmp_path / "b" / f) for f in os.listdir(tmp_path / "b") if f.startswith("part-")]
    assert max(sizes) <= 45_000 and len(sizes) >= 4
    assert {r.record_id for r in read_warc(spark, str(tmp_path / "b")).where("kind = 'record'").collect()} == {f"<urn:x-page:{i}>" for i in range(60)}


def test_articles_are_not_lost_by_class_names(spark):
    article = '<article><h1>Head {0}</h1><div class="share-price"><p>The share price of number {0} rose a little today.</p></div><section class="notice-board"><p>The board number {0} gave notice.</p></section></article>'
    page = "<html><body><nav><a href=x>Menu</a></nav>" + article + '<div class="comments"><p>Nice number {0}</p></div></body></html>'
    want = "Head {0}\n\nThe share price of number {0} rose a little today.\n\nThe board number {0} gave notice."
    rows = [(i, f"http://s.org/{i}", page.format(i)) for i in range(8)] + [(100, "http://alone.org/", page.format(100))]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == want.format(i) for i, *_ in rows)


def test_templates_find_articles_without_names(spark):
    """A host without article elements or telling names: the template's slots decide. A page judged alone gets more than the article."""
    rng = np.random.default_rng(6)
    say = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 5000, n)) + "."
    rows, want = [], {}
    for i in range(24):
        paragraphs = [say(int(rng.integers(20, 60))) for _ in range(int(rng.integers(2, 6)))]
        links = "".join(f"<li><a href=x>{say(3)}</a></li>" for _ in range(int(rng.integers(2, 9))))
        rows.append((i, f"http://n.org/{i}", f'<html><body><div id="a"><ul>{links}</ul></div><div id="b"><p>{say(8)}</p></div><div id="c"><h2>{say(4)}</h2>{"".join(f"<p>{p}</p>" for p in paragraphs)}<div id="d"><a href=x>{say(9)}</a></div></div><div id="e"><p>{say(12)}</p></div></body></html>'))
        want[i] = paragraphs
    got = {r.page_id: r.text.split("\n\n") for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i][1:] == want[i] for i in want)
    assert sum(main_text(h).split("\n\n")[1:] != want[i] for i, _, h in rows) > 0


def brute_force_classes(sources):
    """Paths by their occurrence vectors over all pages, of those on half of the pages."""
    from concordat.llm.html import Page

    pages = [Page(s).tokens for s in sources]
    vectors = {}
    for path in {p for t in pages for p in t}:
        vector = tuple(t.get(path, 0) for t in pages)
        if 2 * sum(n > 0 for n in vector) >= len(pages):
            vectors.setdefault(vector, set()).add(path)
    return {frozenset(v) for v in vectors.values()}


def test_classes_are_those_of_whole_vectors(spark):
    from concordat.llm.html import COUNTS, occurrences, templates

    rng = np.random.default_rng(12)
    sources = []
    for i in range(20):
        rows = "".join(f"<li><a href=x>l{k}</a></li>" for k in range(int(rng.integers(1, 5))))
        extra = "<div id=x><p>z</p></div>" if rng.random() < 0.3 else ""
        sources.append(f"<body><div id=m><ul>{rows}</ul></div><div id=t>{extra}<h3>t</h3>" + "<p>some text</p>" * int(rng.integers(1, 4)) + f"</div><div id=f>{i}</div></body>")
    pages = spark.createDataFrame([(f"http://q.org/{i}", s) for i, s in enumerate(sources)], "url string, html string")
    held = {}
    for batch in occurrences(iter(pages.toArrow().to_batches())):
        for r in batch.to_pylist():
            if r["text"] == 0 and 2 * r["pages"] >= 20:
                held.setdefault((r["one"], r["two"], r["n"]), set()).add(r["path"])
    assert {frozenset(v) for v in held.values()} == brute_force_classes(sources) and len(COUNTS) == 8
    (found,) = templates(pages).collect()
    assert found.root == "body/div.t" and {"body/div.m", "body/div.t", "body/div.f"} <= set(found.order)


def test_word_vectors_match_a_loop(spark):
    import concordat.llm.quality as quality

    texts = ["The cat sat, on the mat.", "a b c d e a b", "", "one", "The cat sat, on the mat.", "x-y z!! über 12"]
    tokens, (place, sign) = quality.Tokens(), quality.index_vectors()
    total = np.zeros((quality.ROWS, quality.PARTS))
    for t in texts:
        ids, _ = tokens.rows([t])
        for i in range(len(ids)):
            for j in range(max(0, i - quality.REACH), min(len(ids), i + quality.REACH + 1)):
                if i != j:
                    for k in range(quality.NONZERO):
                        total[ids[i], place[ids[j], k]] += sign[ids[j], k]
    norm = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    unit = norm(total)
    seen = unit.any(1)
    want = np.where(seen[:, None], norm(unit - unit[seen].mean(0)), 0)
    got = quality.word_vectors(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    assert np.allclose(got, want, atol=1e-5)
    v = got[tokens.rows(["a b c d e a b"])[0]].astype(float)
    x = quality.pool(quality.Tokens(), got, ["a b c d e a b"])[0]
    assert np.allclose(x[: quality.PARTS], v.mean(0), atol=1e-5) and np.allclose(x[quality.PARTS : 2 * quality.PARTS], v.std(0), atol=1e-4) and np.isclose(x[-2], 5 / 7)


def test_scores_of_repeated_keys_do_not_depend_on_the_order_of_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i % 40, " ".join(f"w{x}" for x in rng.integers(0, 30 if i % 2 else 60, 30))) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    one, two = ({(r.doc_id, r.score) for r in quality_scores(spark.createDataFrame(x, "doc_id long, text string"), labels).collect()} for x in (rows, rows[::-1]))
    assert one == two


def test_a_very_long_page(spark):
    rows = [(1, "http://l.org/1", "<body><article>" + "<p>Paragraph of the page.</p>" * 60_000 + "</article></body>"), (1, "http://l.org/1", "<p>short</p>")]
    got = sorted((r.page_id, r.n_chars) for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert got == [(1, 5), (1, 60_000 * 22 + 59_999 * 2)]


def test_repeated_pages_and_ties_of_archives(spark, tmp_path):
    same = "z" * 1500
    rows = [(4, "u", same), (4, "u", same), (2, "u", same), (2, None, "small")]
    write_warc(as_records(spark.createDataFrame(rows, "page_id long, url string, html string")), str(tmp_path / "r"))
    got = sorted((r.record_id, r.record_type, r.refers_to) for r in read_warc(spark, str(tmp_path / "r")).collect())
    assert [x[1] for x in got] == ["response", "revisit", "response", "response"] and got[1][2] == "<urn:x-page:4>"
