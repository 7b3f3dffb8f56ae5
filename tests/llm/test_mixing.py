"""The mixer learns from all training texts."""

import numpy as np

from concordat.llm import mixing


def test_the_mixer_learns_from_every_stretch(spark, monkeypatch):
    seen = {}

    def kept(df, f, schema):
        if schema.startswith("cell"):
            seen["parts"] = df.select("part").distinct().count()
            seen["items"] = df.where("item IS NOT NULL").count()
        return of(df, f, schema)

    of = mixing.in_arrow
    monkeypatch.setattr(mixing, "in_arrow", kept)
    monkeypatch.setattr(mixing, "STRETCH", 20)
    pairs = spark.range(900).selectExpr("concat('w', lpad(id, 4, '0')) AS item", "0 AS topic", "id % 5 AS c")
    scored = mixing.train(pairs, mixing.byte_tree(np.ones(256, np.int64)))
    assert seen["parts"] > 128 and seen["items"] == 720
    assert scored.count() == 900


def test_counts_of_a_stretch_are_found_in_few_passes_whatever_bytes_it_has(monkeypatch):
    rng = np.random.default_rng(7)
    items = sorted({"".join(rng.choice(list("ab\x01\x1f!é"), rng.integers(1, 6))) for _ in range(200)} | {"\n", "a" * 64, "\tab", "\t\x01a"})
    rows = [(x, t) for x in items for t in range(3) if rng.random() < 0.7]
    count, topic = rng.integers(0, 5, len(rows)), np.array([t for _, t in rows])
    tree, calls, mix = mixing.byte_tree(np.bincount(np.frombuffer("".join(items).encode(), np.uint8), minlength=256)), [], mixing.mix64
    bits = mixing.Bits(tree, [x for x, _ in rows], topic)
    monkeypatch.setattr(mixing, "mix64", lambda x: (calls.append(len(x)), mix(x))[1])
    for topical in (False, True):
        seen, keys = {}, []
        for k, (x, t) in enumerate(rows):
            own = bits.bit[bits.first[k] : bits.first[k] + bits.length[k]].tolist()
            keys += [(x[0] == "\t", t if topical else 0, tuple(own[:d])) for d in range(len(own))]
        for key, bit, k in zip(keys, bits.bit.tolist(), bits.item.tolist()):
            seen.setdefault(key, [0, 0])[bit] += int(count[k])
        out = np.stack([~bits.bit, bits.bit], 1).astype(np.float32) * count.astype(np.float32)[bits.item][:, None]
        bits.follow(topical, count, (np.zeros(0, np.uint64), np.zeros((0, 2))), out)
        assert out.tolist() == [seen[k] for k in keys]
    assert len(calls) < 10
