"""Driver contract: entry() runs, every query has a callable, oracles are
strings, and the cheap source queries match their oracle."""

import pytest

import __spark_entry__ as entry_mod


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "close" in df.columns and "ticker" in df.columns


def test_registry_shapes():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert len(q) > 150
    assert set(o) <= set(q)
    assert all(isinstance(s, str) and s.strip() for s in o.values())


@pytest.mark.parametrize("name", ["S01_src_bars", "S02_src_listing", "S05_src_holders", "G21_confusion_matrix",
                                  "G22_classification_report", "F10_F11_G09_profile_imputation"])
def test_oracle_matches(spark, duck_mid, name):
    from tests.oracle_check import compare

    res = compare(entry_mod.queries()[name](spark, "/root/testdata/sf0.01"), entry_mod.oracle_sql()[name], duck_mid)
    assert res["ok"], res
