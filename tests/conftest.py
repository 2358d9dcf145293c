import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from attriflux.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


RAW = [
    ("2024-01-01", "facebook_tier1", "social", 101, 1000, 100.0, 50, 10, 5, 500.0),
    ("2024-01-08", "facebook_tier1", "social", 101, 2000, 200.0, 80, 15, 8, 300.0),
    ("2024-01-15", "facebook_tier1", "social", 101, 1500, 150.0, 60, 12, 6, 450.0),
    ("2024-01-01", "google_hot", "search", 202, 3000, 300.0, 120, 25, 12, 1200.0),
    ("2024-01-08", "google_hot", "search", 202, 2500, 250.0, 100, 20, 10, 1000.0),
    ("2024-01-15", "google_hot", "search", 202, 2000, 200.0, 90, 18, 9, 400.0),
]
RAW_COLUMNS = ["c_date", "campaign_name", "category", "campaign_id", "impressions", "mark_spent", "clicks",
               "leads", "orders", "revenue"]


@pytest.fixture(scope="session")
def raw_facts(spark):
    from attriflux.sources.facts import standardise_columns
    return standardise_columns(spark.createDataFrame(RAW, RAW_COLUMNS)).persist()


@pytest.fixture(scope="session")
def features(raw_facts):
    from attriflux.operators.features import engineer_features
    return engineer_features(raw_facts).persist()
