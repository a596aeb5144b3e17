"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from churnlab.sources.tables import TABLES, table_path

from conftest import SF_SMALL

_SQL = E.oracle_sql()
_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
          "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
_Q = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(rows, idx=None):
    out = [tuple(_norm(v) for v in r) for r in rows]
    if idx is not None:
        out = [tuple(r[i] for i in idx) for r in out]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


@pytest.mark.parametrize("name", sorted(_SQL))
def test_matches_oracle(spark, con, name):
    sdf = _Q[name](spark, SF_SMALL)
    res = con.sql(_SQL[name])
    assert sorted(sdf.columns) == sorted(res.columns)
    duck_types = dict(zip(res.columns, map(str, res.types)))
    for f in sdf.schema.fields:
        assert _TYPES.get(f.dataType.simpleString()) == duck_types[f.name], (f.name, f.dataType, duck_types[f.name])
    idx = [res.columns.index(c) for c in sdf.columns]
    assert _rows(sdf.collect()) == _rows(res.fetchall(), idx)


#: Rows of the queries without an oracle, and the range of one of their columns.
_EXPECTED = {
    "train_gbt": (lambda n: n == 19, "importance", 0, 1),
    "train_boosted": (lambda n: n >= 50, "cover", 0, 1e9),
    "score_boosted": (lambda n: n > 10, "score", 0, 1),
    "loss_curve": (lambda n: n == 100, "logloss", 0, 10),
    "score_batch": (lambda n: n > 20, "score", 0, 1),
    "model_job_gate": (lambda n: n == 1, "auc_score", 0, 1),
    "model_job_quality": (lambda n: n == 5, "observed_value", 0, 1),
    "model_job_bias": (lambda n: n == 1, "dppl", -1, 1),
    "tune_gbt": (lambda n: n > 6, "val_logloss", 0, 10),
    "tuned_scores": (lambda n: n > 10, "score", 0, 1),
    "tune_hyperband": (lambda n: n == 9, "val_logloss", 0, 10),
    "hyperband_scores": (lambda n: n > 10, "score", 0, 1),
    "shap_local": (lambda n: n > 19 and n % 19 == 0, "f_x", 0, 1),
    "shap_kmeans": (lambda n: n > 19 and n % 19 == 0, "f_x", 0, 1),
    "shap_global": (lambda n: n == 19, "mean_abs_shap", 0, 1),
    "bias_flip_test": (lambda n: n == 1, "ft", -1, 1),
}


@pytest.mark.parametrize("name", sorted(_EXPECTED))
def test_rows_only_queries(spark, name):
    rows_ok, col, low, high = _EXPECTED[name]
    rows = _Q[name](spark, SF_SMALL).collect()
    assert rows_ok(len(rows)), len(rows)
    assert all(r[col] is None or low <= r[col] <= high for r in rows) and any(r[col] is not None for r in rows)


def test_every_query_has_an_oracle_or_a_check():
    own = {n for n in _Q if not n.startswith("op") and n != "pipeline"}
    assert own == (set(_SQL) & own) | set(_EXPECTED)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[0] == "msno" and df.count() > 0
