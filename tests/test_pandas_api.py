import pandas as pd
import pyspark.pandas as ps
import pytest

from larder import pandas_api as p

from .conftest import rows


@pytest.fixture()
def frame(restaurants):
    return p.to_pandas_api(restaurants)


def test_round_trip_keeps_the_columns(frame, restaurants):
    assert rows(p.to_native(frame)) == rows(restaurants)
    assert p.to_native(frame).columns == restaurants.columns


def test_index_is_distributed(frame):
    assert ps.get_option("compute.default_index_type") == "distributed"
    assert "Window" not in p.to_native(frame[["name"]])._jdf.queryExecution().optimizedPlan().toString()


def test_local_frames_are_bounded(frame):
    local = p.to_local(frame, 6)
    assert isinstance(local, pd.DataFrame) and len(local) == 6
    with pytest.raises(ValueError):
        p.to_local(frame, 3)


def test_merge_is_a_native_join(frame, orders):
    merged = p.merge(p.to_pandas_api(orders), frame[["restaurant_id", "city"]], "restaurant_id")
    counts = merged.groupby("city").size().to_pandas().to_dict()
    assert counts == {"Quito": 3, "Turin": 4}


def test_local_dimension(orders):
    names = pd.DataFrame({"restaurant_id": [10, 11, 99], "alias": ["a", "b", "c"]})
    assert p.join_local(orders, names, "restaurant_id").count() == 3


def test_cache_and_partitions(frame):
    with p.cached(p.spread(frame, 3)) as held:
        assert len(held) == 6
    assert p.to_native(p.gather(p.spread(frame, 3), 1)).rdd.getNumPartitions() == 1


def test_features(restaurants):
    out = p.assemble_features(restaurants, ["average_rating", "monthly_orders"]).orderBy("restaurant_id").first()
    assert list(out["features"]) == [4.5, 40.0]
