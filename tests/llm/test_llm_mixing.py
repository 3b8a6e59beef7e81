import re
from collections import defaultdict

from helpers import awkward_documents, empty_like, frame, prose
from pyspark.sql import functions as F

from kiln.llm.mixing import mix_sources, mixed_documents, word_count


def expected_targets(sizes: dict) -> dict:
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in sizes if s not in capped)
        now = {s for s in sizes if s not in capped and weight[s] * rest > 3 * sizes[s] * free}
        if not now:
            return {s: 3.0 * sizes[s] if s in capped else weight[s] * rest / max(free, 1) for s in sizes}
        capped |= now


def check(df, rows):
    got = rows.collect()
    texts = [(r.doc_id, r.source, r.text) for r in df.select("doc_id", "source", "text").collect()]
    sizes, per_doc = defaultdict(int), []
    for d, s, t in texts:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] += n
        per_doc.append((d, n, s))
    targets = expected_targets(sizes)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r["size"], r.target) for r in got), key=key) == sorted(
        ((d, n, targets[s]) for d, n, s in per_doc), key=key)
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.target, r.source_size] += r.taken
    for (target, size), words in taken.items():
        n = sum(1 for s in sizes if targets[s] == target and sizes[s] == size)
        assert abs(words - n * target) <= max(8, 0.03 * n * target), (target, size, words)
    return got


def test_targets_and_taken(spark):
    rows = [(i, ("s%d" % (i % 7)) if i % 7 else None, prose(i, 5 + (i * 37) % 400)) for i in range(210)]
    df = frame(spark, rows, "doc_id long, source string, text string")
    query = lambda: mix_sources(df, word_count(F.col("text"))).docs
    got = check(df, query())
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in query().collect())


def test_small_source_is_capped_at_three_laps(spark):
    rows = [(1, "a", prose(1, 20)), (2, "b", prose(2, 3000)), (3, "c", prose(3, 2000))]
    df = frame(spark, rows, "doc_id long, source string, text string")
    got = {r.doc_id: r for r in check(df, mix_sources(df, word_count(F.col("text"))).docs)}
    assert got[1].taken == 3 * got[1]["size"] == got[1].target


def test_awkward_rows(spark):
    df = awkward_documents(spark)
    check(df, mix_sources(df, word_count(F.col("text"))).docs)
    none = empty_like(df)
    assert mix_sources(none, word_count(F.col("text"))).docs.count() == 0
    assert mixed_documents(none).count() == 0
    mixed = mixed_documents(df)
    assert mixed.columns == df.columns
    assert all(r.text and r.text.strip() for r in mixed.collect())


def test_mixed_documents_follow_the_targets(spark):
    rows = [(i, "s%d" % (i % 3), prose(i, 40)) for i in range(300)]
    df = frame(spark, rows, "doc_id long, source string, text string")
    words = {r["source"]: r["n"] for r in mixed_documents(df).groupBy("source").agg(
        F.sum(word_count(F.col("text"))).alias("n")).collect()}
    total = sum(word_n for word_n in words.values())
    for s, share in (("s0", 5 / 8), ("s1", 2 / 8), ("s2", 1 / 8)):
        assert abs(words[s] / total - share) < 0.03


def test_equal_ids_with_different_texts_keep_their_own_copies(spark):
    rows = [(None if i % 2 else 7, f"word{i} " * 40, "a") for i in range(60)] + [(100, "one two", "b")]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    runs = [sorted(r.text for r in mixed_documents(docs.repartition(n)).collect()) for n in (1, 3, 5)]
    assert runs[0] == runs[1] == runs[2] and set(runs[0]) <= {t for _, t, _ in rows}
