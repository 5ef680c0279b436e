"""Plans keep the shapes that make them scale."""

import pytest

from railpulse.operators import dimensions, sightings
from railpulse.operators.headways import headways
from railpulse.operators.arrivals import fct_arrivals, infer_arrivals
from railpulse.operators.staging import stage
from conftest import frame, watched_platform


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "landing")
    frame(spark, watched_platform()).write.parquet(path)
    return spark.read.parquet(path)


def test_copies_are_cut_before_the_shuffle(landing):
    plan = plan_of(stage(landing))
    before = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before and "row_number(), 1, Partial" in before
    assert plan.count("Exchange hashpartitioning") == 1


def test_pairs_are_folded_before_one_shuffle(spark, landing, tmp_path):
    stage(landing).write.parquet(str(tmp_path / "stg"))
    plan = plan_of(sightings.latest_by_pair(spark.read.parquet(str(tmp_path / "stg"))))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min" in plan[plan.index("Exchange"):]
    assert "IsNotNull(predicted_arrival)" in plan and "EqualTo(schedule_relationship,SCHEDULED)" in plan
    assert "predicted_departure" not in plan[plan.index("ReadSchema"):]


def test_the_watermark_reads_two_columns(landing):
    plan = plan_of(sightings.landing_watermark(landing))
    assert "ReadSchema: struct<feed_id:string,observed_at:bigint>" in plan


def test_nothing_is_joined_with_everything(spark, landing):
    seen = sightings.last_sightings(stage(landing), sightings.landing_watermark(landing))
    stops = spark.createDataFrame([], "stop_id string, stop_name string, stop_lat string, stop_lon string, "
                                      "location_type string, parent_station string")
    for df in (headways(fct_arrivals(infer_arrivals(seen))), dimensions.dim_stations(stops, stage(landing))):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan
