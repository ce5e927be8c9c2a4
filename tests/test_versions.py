"""Versions of a table: what fails before publishing leaves the old one readable."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakewright.catalog import standins
from lakewright.operators.quality import DataQualityError
from lakewright.plans.builds import build_labour
from lakewright.sinks.tables import ConstraintBroken, WriteMismatch, latest_version, publish, publish_version, write_version
from lakewright.sources.files import read_table
from tests.conftest import SMALL
from tests.test_builds import to_csv



def rules():
    return {"positive": F.col("v") > 0, "known": F.col("k").isNotNull()}


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v int")


def test_numbers_increase_and_the_newest_is_read(spark, tmp_path):
    root = str(tmp_path / "t")
    assert latest_version(spark, root) is None
    paths = [publish_version(frame(spark, ("a", n)), root, "versions_view", constraints=rules()) for n in range(1, 13)]
    assert [p.rsplit("-", 1)[1] for p in paths] == [f"{n:012d}" for n in range(1, 13)]
    assert latest_version(spark, root) == paths[-1] and spark.table("versions_view").first()["v"] == 12
    with pytest.raises(WriteMismatch):
        publish(spark, paths[0])


def test_a_broken_rule_and_a_failed_write_change_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    good = publish_version(frame(spark, ("a", 1), (None, None)), root, "rules_view", constraints={"positive": F.col("v") > 0})
    with pytest.raises(ConstraintBroken) as raised:
        publish_version(frame(spark, ("a", -1), (None, 0), ("b", 2)), root, "rules_view", constraints=rules())
    assert raised.value.broken == {"positive": 2, "known": 1}
    with pytest.raises(Exception, match="no such luck"):
        publish_version(frame(spark, ("a", 1)).withColumn("v", F.raise_error(F.lit("no such luck")).cast("int")), root, "rules_view")
    unseen = write_version(frame(spark, ("c", 3)), root)
    assert latest_version(spark, root) == good and spark.table("rules_view").count() == 2
    publish(spark, unseen, "rules_view")
    assert latest_version(spark, root) == unseen and spark.table("rules_view").first()["k"] == "c"


def test_a_version_may_be_computed_from_the_one_before(spark, tmp_path):
    root = str(tmp_path / "t")
    publish_version(frame(spark, ("a", 1)), root, "grown_view", ["k"])
    publish_version(spark.table("grown_view").unionByName(spark.table("grown_view")), root, "grown_view", ["k"])
    assert spark.table("grown_view").count() == 2


def test_a_failed_gate_leaves_the_layers_of_the_last_build(spark, tmp_path):
    province, root = standins.province_arrival(spark, SMALL), str(tmp_path / "lake")
    industry = to_csv(standins.industry_arrival(spark, SMALL), tmp_path / "i")
    build_labour(spark, to_csv(province, tmp_path / "p"), industry, root, date(2001, 9, 1), datetime(2001, 9, 1, 10))
    before = {name: latest_version(spark, f"{root}/{name}") for name in ("raw/province", "raw/industry", "clean/province", "clean/industry", "gold/dim_employment")}
    assert all(before.values())
    audit = read_table(spark, f"{root}/audit")
    assert sorted(r.model_name for r in audit.collect()) == ["dim_employment", "mart", "raw_and_clean"]
    broken = to_csv(province.withColumn("VALUE", F.lit("-1")), tmp_path / "p2")
    with pytest.raises(DataQualityError, match="value_range"):
        build_labour(spark, broken, industry, root, date(2001, 10, 1), datetime(2001, 10, 1, 10))
    assert {name: latest_version(spark, f"{root}/{name}") for name in before} == before
    assert read_table(spark, before["clean/province"]).filter("value < 0").count() == 0
