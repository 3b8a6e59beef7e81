import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from helpers import empty_like, frame

from kiln.llm import vector_codes as V
from kiln.llm.oracles import OP13
from kiln.llm.queries import op13_vector_codes

SF = "/root/testdata/sf0.001"


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """k-means with a full search in Python integers; ``rows`` are (id, vector) of one length."""
    kept = [(i, [math.floor(4096 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    seeds = sorted((i, v) for i, v in kept if i is not None)[:entries]
    books = [[v[p * width:(p + 1) * width] for _, v in seeds] for p in range(parts)]

    def assign():
        out = []
        for _, v in kept:
            d = [[sum((a - b) ** 2 for a, b in zip(v[p * width:(p + 1) * width], e)) for e in books[p]] for p in range(parts)]
            out.append([(x.index(min(x)), min(x)) for x in d])
        return out

    for _ in range(rounds):
        chosen = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p * width:(p + 1) * width] for (_, v), c in zip(kept, chosen) if c[p][0] == e]
                if own:
                    books[p][e] = [sum(col) // len(own) for col in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{c:02x}" for c, _ in a), sum(d for _, d in a)) for (i, _), a in zip(kept, assign())], digest


def test_reassigning_equals_a_full_search():
    r = np.random.default_rng(3)
    for spread in (3, 30, 3000):  # many ties, some, none
        points = r.integers(-spread, spread, (400, 4))
        entries = r.integers(-spread, spread, (9, 4))
        own, _ = V.nearest(points, entries)
        for k in range(6):
            new = entries.copy()
            new[:k + 1] += r.integers(-spread // 2, spread // 2 + 1, (k + 1, 4))
            new[-1] = new[0]  # equal entries: the lower index wins
            moved = (new != entries).any(axis=1)
            got = V.reassign(points, own, new, moved)
            want = V.nearest(points, new)
            assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
            own, entries = got[0], new


def test_query_matches_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    cur = con.execute(OP13)
    df = op13_vector_codes(spark, SF)
    want = sorted(cur.fetchall())
    assert sorted(tuple(r) for r in df.select(*[d[0] for d in cur.description]).collect()) == want and want


def test_awkward_vectors(spark):
    r = random.Random(5)
    clean = [(i, [r.uniform(-1, 1) for _ in range(16)]) for i in range(60)]
    clean += [(100 + i, clean[7][1]) for i in range(40)]  # a group of copies
    clean += [(None, clean[3][1])]
    nan, inf = float("nan"), float("inf")
    odd = [(200, None), (201, [None] + [0.0] * 15), (202, [nan] * 16), (203, [-inf] + [0.0] * 15), (-5, None)]
    rows = [(i, v, "a" if k % 3 == 0 else None if k % 3 == 1 else "b", "x") for k, (i, v) in enumerate(clean + odd)]
    df = frame(spark, rows, "vec_id long, embedding array<double>, label string, code string").repartition(3)
    got = V.vector_codes(df).collect()
    want, digest = plain_codes(clean + odd)
    assert sorted(((r.vec_id, r.code, r.error) for r in got), key=str) == sorted(want, key=str)
    assert {r.codebooks_sha256 for r in got} == {digest}
    sums = {}
    for r in got:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == sums[r.label] for r in got) and set(sums) == {"a", "b", None}
    assert V.vector_codes(empty_like(df)).collect() == []


def test_few_vectors_other_lengths_and_no_ids(spark):
    kind = "vec_id long, embedding array<float>, label int"
    got = V.vector_codes(frame(spark, [(2, [1.0] * 10, 1), (1, [0.5] * 10, 1), (1, [0.25] * 10, 1), (9, [1.0] * 3, 1),
                                       (8, [], None)], kind)).collect()
    by_id = {(r.vec_id, r.code): (r.error, r.label_error) for r in got}
    assert by_id[2, "01" * 8][0] == 0 and by_id[9, None] == (None, by_id[2, "01" * 8][1]) and by_id[8, None] == (None, 0)
    none = V.vector_codes(frame(spark, [(None, [1.0] * 8, 1)], kind)).collect()
    assert [(r.code, r.error, r.label_error) for r in none] == [(None, None, 0)]
    with pytest.raises(Exception, match="beyond"):
        V.vector_codes(frame(spark, [(1, [1e9] * 8, 1)], kind)).collect()
