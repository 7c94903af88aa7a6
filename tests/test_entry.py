import importlib

import duckdb

from corpusloom.sources.fixtures import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_and_registry(spark):
    E = importlib.import_module("__spark_entry__")
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracles_match_on_smallest_scale(spark):
    E = importlib.import_module("__spark_entry__")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ["chat_records", "sft_sample_v2", "calib_sample_v1", "mc_arc", "eval_metrics_overall",
                 "kd_rejects", "train_labels", "nm_sparsity", "length_summary"]:
        df = E.queries()[name](spark, SF)
        cols = sorted(df.columns)
        got = sorted(tuple(r[c] for c in cols) for r in df.collect())
        res = con.execute(E.oracle_sql()[name])
        ocols = [d[0] for d in res.description]
        assert sorted(ocols) == cols, name
        want = sorted(tuple(dict(zip(ocols, r))[c] for c in cols) for r in res.fetchall())
        assert got == want, name
