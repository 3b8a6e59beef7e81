import random

import numpy as np
import pytest
import xxhash
from helpers import awkward_documents, empty_like, frame, prose

from kiln.llm import simhash_dups as S


def plain_fingerprint(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    w = (text or "").encode().translate(low).split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_force(prints, radius):
    """Component (smallest id) of every (id, fingerprint)."""
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= radius:
                label[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(len(prints))]


def test_fingerprints_match_plain_python():
    for text in (None, "", "  \n", "One", "one  TWO", "É ü\x0bß a", "a b c", prose(1, 20_000), "x " * 500):
        assert S.fingerprint(text.encode() if text is not None else None) == plain_fingerprint(text)


@pytest.mark.parametrize("radius, long_list", [(2, 4096), (2, 3), (3, 3), (0, 4096)])
def test_components_match_brute_force(spark, monkeypatch, radius, long_list):
    """Near fingerprints, a large group in one partition's value, and noise."""
    monkeypatch.setattr(S, "LIST", long_list)
    r = random.Random(radius)
    prints = []
    for _ in range(30):
        base = r.getrandbits(64)
        for _ in range(8):
            x = base
            for _ in range(r.randrange(6)):
                x ^= 1 << r.randrange(64)
            prints.append(x)
    prints += [(0x1234 << 48) | (r.getrandbits(6) << r.randrange(40)) for _ in range(150)]
    rows = [(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(prints)]
    classes = frame(spark, rows, "doc_id long, bits long").groupBy("bits").count()
    found = {(r.a, r.b) for r in S.links(classes, radius).collect()}
    signed = sorted({x for _, x in rows})
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius}
    assert found == want and (want or not radius)


def test_units_always_add_up():
    r = np.random.default_rng(1)
    x = r.integers(0, 1 << 63, 200).astype(np.uint64)
    for m in (2, 3, 4):
        layout = S.partitions(np.zeros((64, 64)), m)
        assert sorted(b for bits in layout for b in bits) == list(range(64))
        shares = [[S._near_shares(np.bincount(S.gather(x, s).astype(int), minlength=1 << len(s)), 2)
                   for s in S._sub_blocks(bits)] for bits in layout]
        units, cost = S.allocate(x, layout, shares, len(x), 2)
        assert (units.sum(axis=1) == 3).all() and (units >= 0).all() and np.isfinite(cost).all()
    # a partition in which all agree is not probed
    x[:] = (x >> np.uint64(22)) << np.uint64(22)
    layout = [list(range(22)), list(range(22, 43)), list(range(43, 64))]
    shares = [[S._near_shares(np.bincount(S.gather(x, s).astype(int), minlength=1 << len(s)) * 1_000_000, 2)
               for s in S._sub_blocks(bits)] for bits in layout]
    assert (S.allocate(x, layout, shares, len(x) * 1_000_000, 2)[0][:, 0] == 0).all()


def test_awkward_documents(spark):
    docs = awkward_documents(spark)
    got = S.simhash_components(docs).collect()
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    want = [(d, f"{x:016x}", c) for (d, x), c in zip(rows, brute_force(rows, 2))]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert S.simhash_components(empty_like(docs)).collect() == []
    lost = frame(spark, [(None, "a b c d"), (None, "a b c d"), (None, None)], "doc_id long, text string")
    assert [r.component_id for r in S.simhash_components(lost).collect()] == [None] * 3


def test_a_document_without_id_links_others(spark):
    from kiln.llm.components import components
    a, b, c = 0b0011, 0b1111, 0b111111  # a and c are linked through b only
    classes = frame(spark, [(a, 7), (b, None), (c, 9)], "bits long, low long")
    found = {r.node: r.component for r in components(S.links(classes, 2)).collect()}
    assert found == {a: a, b: a, c: a}
