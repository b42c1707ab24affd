import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larder.session import build_session  # noqa: E402

TESTDATA = os.environ.get("LARDER_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "larder-tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def small_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def middle_dir():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture()
def folder(spark):
    from larder.session import scratch_path

    return scratch_path(spark, "test")


# One row for each edge; the comment says which. Groups have three, two and one members.
RESTAURANTS = [
    (10, "ten", "grill", "Quito", 4.5, 40, 200.0),  # on the bound of the best label
    (11, "eleven", "grill", "Quito", 4.49, 40, 0.0),  # just below it; as many monthly orders; never ordered from
    (12, "twelve", "grill", "Turin", 1.0, 1, 15.5),  # the lowest rating; a second city in its group
    (13, "thirteen", "vegan", "Turin", 4.0, 0, 99.99),  # on the bound of the second label; a weight of zero
    (14, "fourteen", "vegan", "Turin", 5.0, 9900, 12345.67),  # the largest of every column
    (15, "fifteen", "bakery", "Oulu", 3.99, 7, 70.0),  # alone in its group and city; never ordered from
]
ORDERS = [
    (100, 10, 10.1, "2021-12-31"),  # the last day of a year
    (101, 10, 10.1, "2022-01-01"),  # the same amount a day and a year later
    (102, 10, 0.01, "2022-01-01"),  # the least amount
    (103, 14, 999.99, "2022-01-02"),  # a Sunday, the first weekday
    (104, 14, 0.0, "2022-02-28"),  # nothing paid, yet an order
    (105, 12, 55.55, "2021-12-31"),
    (106, 13, 20.0, "2022-02-28"),  # the last day of a short month
]


@pytest.fixture(scope="session")
def restaurants(spark):
    return spark.createDataFrame(
        RESTAURANTS,
        "restaurant_id bigint, name string, cuisine_type string, city string, average_rating double, "
        "monthly_orders bigint, monthly_revenue double",
    ).cache()


@pytest.fixture(scope="session")
def orders(spark):
    return spark.createDataFrame(
        ORDERS, "order_id bigint, restaurant_id bigint, amount double, order_date string"
    ).cache()


def rows(df, *columns):
    """Rows as sorted plain tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
