"""Registered queries against their SQL on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from loamworks.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = con.execute(registry.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = Counter(tuple(plain(row[names.index(c)]) for c in columns) for row in found.fetchall())
    assert Counter(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(registry.filters.FILTERS))
def test_filters_have_both_outcomes(spark, name):
    assert {r["stays"] for r in registry.QUERIES[f"filter_{name}"](spark, SF).select("stays").distinct().collect()} == {True, False}


@pytest.mark.parametrize("name", [*sorted(registry._CLEANERS), "clean_tag_header"])
def test_cleaners_change_some_texts_and_not_others(spark, name):
    plain = registry.code(spark, SF).select("doc_id", registry.F.sha2("text", 256).alias("plain"))
    same = {r["same"] for r in registry.QUERIES[name](spark, SF).join(plain, "doc_id").select((registry.F.col("hash") == registry.F.col("plain")).alias("same")).distinct().collect()}
    assert same == {True, False} or same == {True} and name == "clean_leading_blank"  # takes off what the query puts before


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
