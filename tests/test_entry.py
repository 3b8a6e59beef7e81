import math

import duckdb

import __spark_entry__ as E
from paths import SF_SMALL
from kiln.workloads.oracles import ORACLES
from kiln.workloads.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "product_code", "customer_code", "sold_quantity"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql()) <= set(E.queries())


def test_queries_without_the_training_data_operators(monkeypatch):
    import sys
    for name in ("corpus_pipeline", "kiln.llm", "kiln.llm.oracles", "kiln.llm.queries"):
        monkeypatch.delitem(sys.modules, name, raising=False)

    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name in ("corpus_pipeline", "kiln.llm"):
                raise ModuleNotFoundError(name, name=name)

    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(ORACLES)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        return v.isoformat() if hasattr(v, "isoformat") else v
    out = sorted((tuple(n(r[i]) for i in order) for r in rows),
                 key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], out


def test_queries_match_duckdb(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    bad = []
    for name in QUERIES:
        df = E.queries()[name](spark, SF_SMALL)
        s = _canon(df.columns, [tuple(r) for r in df.collect()])
        cur = con.execute(E.oracle_sql()[name])
        o = _canon([d[0] for d in cur.description], cur.fetchall())
        if s != o:
            bad.append(name)
    assert bad == []
