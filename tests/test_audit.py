"""Write, audit, publish: what breaks a contract is kept apart and may stop the publication."""

import pytest
from pyspark.sql import functions as F

from regiofact.plans.audit import Contract, ContractBroken, audited, broken_rules, publish_audited, quarantine, sound_rows
from regiofact.sources.releases import read_release

ROWS = [(1, "a", 5.0), (2, "b", -1.0), (2, "c", 7.0), (3, None, None), (None, "e", 3.0), (None, "f", 4.0)]
CONTRACT = Contract(not_null=["name"], unique=[["id"]], between={"v": (0.0, 10.0)}, allowed=3)


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "id int, name string, v double")


def test_rows_name_the_rules_they_break(df):
    found = {(r.id, r.name): r._broken for r in audited(df, CONTRACT).collect()}
    assert found == {
        (1, "a"): [], (2, "b"): ["between v", "unique id"], (2, "c"): ["unique id"], (3, None): ["not_null name"],
        (None, "e"): [], (None, "f"): [],  # a missing key is compared with none
    }
    assert audited(df, Contract()).filter(F.size("_broken") > 0).count() == 0


def test_a_broken_contract_leaves_the_old_table(spark, df, tmp_path):
    root = str(tmp_path / "w")
    release = publish_audited(df, CONTRACT, root, "t")
    assert sorted(r.name for r in sound_rows(spark, root, "t").collect()) == ["a", "e", "f"]
    assert {r.rule: r.n_records for r in broken_rules(quarantine(spark, root, "t", 1)).collect()} == {"between v": 1, "unique id": 2, "not_null name": 1}
    with pytest.raises(ContractBroken) as e:
        publish_audited(df.unionAll(df), CONTRACT, root, "t")
    assert (e.value.number, e.value.broken) == (2, 8) and read_release(spark, root) == release
    assert sound_rows(spark, root, "t").count() == 3 and quarantine(spark, root, "t", 2).count() == 8
    assert publish_audited(df.filter("name = 'a'"), CONTRACT, root, "t").tables == {"t": 2}
    assert [r.id for r in sound_rows(spark, root, "t").collect()] == [1] and sound_rows(spark, root, "t", 1).count() == 3


def test_nothing_and_no_violations(spark, df, tmp_path):
    root = str(tmp_path / "w")
    publish_audited(df.limit(0), CONTRACT, root, "t")
    assert read_release(spark, root).tables == {"t": 1}
    with pytest.raises(ContractBroken):
        publish_audited(df, Contract(not_null=["name"]), root, "other")
