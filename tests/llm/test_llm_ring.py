import zlib
from collections import Counter, defaultdict
from hashlib import md5

from helpers import awkward_documents, empty_like, frame

from kiln.llm.ring import assign_shards


def position(*values) -> int:
    return int(md5("\x1f".join("\x00" if v is None else str(v) for v in values).encode()).hexdigest()[:8], 16)


def owners(ids, shards, virtual):
    """Rows per shard by the rule itself: in every turn all arcs in ring order offer what they have left."""
    points = sorted((position(s, v), s) for s in range(shards) for v in range(virtual))
    arc_of = lambda p: next((k for k, (q, _) in enumerate(points) if q >= p), 0)
    left = Counter(arc_of(position(i)) for i in ids)
    room = [len(ids) // shards + (s < len(ids) % shards) for s in range(shards)]
    split = defaultdict(list)
    for turn in range(shards):
        for arc in range(len(points)):
            walk = list(dict.fromkeys(points[(arc + j) % len(points)][1] for j in range(len(points))))
            take = min(left[arc], room[walk[turn]])
            if take > 0:
                left[arc] -= take
                room[walk[turn]] -= take
                split[arc].append((walk[turn], take))
    return {arc: s for arc, s in split.items()}, arc_of


def test_ring_follows_the_rule(spark):
    ids = list(range(997))
    df = frame(spark, [(i, f"text {i}") for i in ids], "doc_id long, text string")
    got = assign_shards(df, "doc_id", "text", shards=5, virtual_nodes=8).collect()
    split, arc_of = owners(ids, 5, 8)
    counts = defaultdict(Counter)
    for r in got:
        counts[arc_of(position(r.doc_id))][r.shard] += 1
    assert {a: dict(c) for a, c in counts.items()} == {a: dict(s) for a, s in split.items()}
    check(got, 5, [(i, f"text {i}") for i in ids])


def check(got, shards, rows):
    counts = Counter(r.shard for r in got)
    assert sum(counts.values()) == len(rows)
    per = [counts.get(s, 0) for s in range(shards)]
    assert max(per) - min(per) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(per[s]))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want


def test_few_keys_move_when_a_shard_is_added(spark):
    df = frame(spark, [(i, "x") for i in range(2000)], "doc_id long, text string")
    place = lambda n: {r.doc_id: r.shard for r in assign_shards(df, "doc_id", "text", shards=n).collect()}
    before, after = place(8), place(9)
    assert sum(before[d] != after[d] for d in before) < 0.5 * len(before)  # a new hash of all keys moves 8 in 9


def test_awkward_rows(spark):
    df = awkward_documents(spark)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    out = assign_shards(df, "doc_id", "text", shards=4)
    assert set(out.columns) == {*df.columns, "text_crc32"}
    check(out.collect(), 4, rows)
    check(assign_shards(df, "doc_id", "text", shards=16, keep_text=False).collect(), 16, rows)
    assert assign_shards(empty_like(df), "doc_id", "text", shards=4).count() == 0


def test_one_key_with_all_rows(spark):
    df = frame(spark, [(1, "same")] * 500, "doc_id long, text string")
    check(assign_shards(df, "doc_id", "text", shards=16, keep_text=False).collect(), 16, [(1, "same")] * 500)
