import random

import pyarrow as pa
from helpers import awkward_documents, empty_like, frame, prose

from kiln.llm import near_dups
from kiln.llm.components import components
from kiln.llm.near_dups import _block_links, _functions, _signature, near_duplicate_components, one_per_group, shingle_set


def brute_force(docs: dict) -> dict:
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    sets = {}
    for d, t in docs.items():
        w = (t or "").encode().translate(low).split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    label = {d: d for d in docs}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x = len(sets[a] & sets[b])
            if x and 100 * x >= 85 * len(sets[a] | sets[b]) and find(a) != find(b):
                a_, b_ = find(a), find(b)
                label[max(a_, b_)] = min(a_, b_)
    return {d: (len(sets[d]), find(d)) for d in docs}


def edited(text: str, seed: int, n: int) -> str:
    r, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[r.randrange(len(words))] = f"edit{r.random()}"
    return " ".join(words)


def test_components_match_brute_force(spark):
    docs, i = {}, 0
    for group in range(6):  # groups of near copies around the threshold, chains and copies
        base = prose(100 + group, 60 + 60 * group)
        for copy in range(25):
            docs[i] = edited(base, i, copy % (2 + group))
            i += 1
    for extra in range(60):
        docs[i] = prose(1000 + extra, 5 + extra)
        i += 1
    docs[i], docs[i + 1], docs[i + 2] = "Two words", "two  WORDS", ""
    rows = frame(spark, [(d, t) for d, t in docs.items()], "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicate_components(rows).collect()}
    assert got == brute_force(docs)


def test_lists_with_many_components_are_compared(spark):
    # copies that miss the hub but match each other: only the block step can link them
    base = prose(7, 120)
    docs = {0: base}
    for k in range(12):
        half = edited(base, 50 + k, 5)
        docs[1 + 2 * k], docs[2 + 2 * k] = half, edited(half, 900 + k, 1)
    rows = frame(spark, list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicate_components(rows).collect()}
    assert got == brute_force(docs)


def test_block_links_join_components_once():
    adds, factors = _functions(128)
    text = prose(9, 100).encode()
    texts = [text, text + b" tail", prose(10, 100).encode(), text]
    sets = [shingle_set(t) for t in texts]
    group = {"node": [1, 2, 3, 4], "label": [1, 2, 3, 4], "key": [7] * 4, "keys": [[7], [7, 9], [7], [9, 7]], "asks": [True] * 4,
             "n_shingles": [len(s) for s in sets],
             "low": [_signature(s, adds, factors).astype("u1").tobytes() for s in sets]}
    # 2 and 4 share list 9 before list 7, so they do not meet here
    texts = pa.chunked_array([texts])
    assert sorted(map(sorted, _block_links(group, texts, 94, 85))) == [[1, 2], [1, 4]]
    group["keys"] = [[9, 7], [9, 7], [7], [9, 7]]
    assert _block_links(group, texts, 94, 85) == []


def test_long_lists_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 8)
    test_lists_with_many_components_are_compared(spark)


def test_lists_of_long_texts_are_cut_by_their_sizes(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_SHINGLES", 500)
    monkeypatch.setattr(near_dups, "BATCH_BYTES", 2_000)
    test_lists_with_many_components_are_compared(spark)


def test_awkward_rows(spark):
    df = awkward_documents(spark)
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicate_components(df).collect()]
    assert len(got) == df.count()
    by_id = {g[0]: g for g in got if g[0] is not None}
    assert by_id[2][2] == by_id[3][2] == 1 and by_id[1][3] and not by_id[2][3]
    assert by_id[4] == (4, 0, 4, True) and by_id[5] == (5, 0, 5, True) and by_id[6] == (6, 0, 6, True)
    assert by_id[8] == (8, 1, 8, True) and by_id[9] == (9, 1, 8, False)
    assert [g for g in got if g[0] is None and g[2] is not None] == []
    kept = one_per_group(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == [1, 4, 5, 6, 7, 8, 10, 11] and ids.count(None) == 2
    assert near_duplicate_components(empty_like(df)).count() == 0


def test_one_id_with_several_texts_is_one_document(spark):
    a, b = prose(20, 80), prose(21, 80)
    rows = frame(spark, [(5, a), (5, b), (7, a), (3, b), (5, a)], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in near_duplicate_components(rows).collect())
    assert got == [(3, 3), (5, 3), (5, 3), (5, 3), (7, 3)]
    assert [r.doc_id for r in one_per_group(rows).collect()] == [3]


def test_components_of_a_long_chain(spark):
    edges = frame(spark, [(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0
