import corpus_pipeline
import duckdb
from helpers import awkward_documents, frame, prose
from pyspark.sql import functions as F

from __spark_entry__ import queries
from kiln.llm.near_dups import one_per_group
from kiln.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_queries_match_duckdb(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLES.items():
        df = queries()[name](spark, SF)
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        plain = lambda v: round(v, 6) if isinstance(v, float) else v
        got = sorted((tuple(plain(v) for v in r) for r in df.select(*names).collect()), key=str)
        assert got == sorted((tuple(plain(v) for v in r) for r in cur.fetchall()), key=str), name


def test_pipeline_against_its_parts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert set(docs.columns) < set(out.columns)
    components = {r.doc_id: r.component_id for r in queries()["op1_near_duplicates"](spark, SF).collect()}
    leaked = {r.doc_id for r in queries()["op5_benchmark_leaks"](spark, SF).collect()}
    ids = {r.doc_id for r in rows}
    assert ids and not ids & leaked and all(components[d] == d for d in ids)
    counts = [sum(r.shard == s for r in rows) for s in range(16)]
    assert max(counts) - min(counts) <= 1
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id] == r.text for r in rows)


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_near_duplicate_stage_links_from_four_fifths_on(spark):
    docs, i = {}, 0
    for group in range(12):  # copies of which many lie between 0.80 and 0.85
        base = prose(500 + group, 150 + 40 * group).split(" ")
        for copy in range(8):
            words = list(base)
            for k in range(copy):
                words[(k + 1) * len(words) // 9] = f"edit{i}x{k}"
            docs[i] = " ".join(words)
            i += 1
    sets, label, between = {d: shingles(t) for d, t in docs.items()}, {d: d for d in docs}, 0
    for a in docs:
        for b in range(a + 1, i):
            x, both = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            between += 80 * both <= 100 * x < 85 * both
            if 100 * x >= 80 * both:
                lo, hi = sorted((label[a], label[b]))
                label = {d: lo if at == hi else at for d, at in label.items()}
    df = frame(spark, list(docs.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, SF).collect()}
    assert between > 20 and got == {d for d in docs if label[d] == d}
    assert got < {r.doc_id for r in one_per_group(df).collect()}


def test_stages_take_awkward_documents(spark):
    docs = awkward_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "shard":
            assert out.columns == docs.columns
        out.count()
        assert stage(spark, docs.limit(0), SF).count() == 0
