import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sales_rows import raw_frame  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    from tallyline.session import local_session

    s = local_session(4, 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def sample_raw(spark):
    return raw_frame(spark, [
        ("ORD-001001", "Oak Desk", "2", "999.99", "2024-01-15", "CUST-20417", "United States"),
        ("ORD-001002", "Reading Lamp", "5", "29.99", "2024-01-16", "CUST-31855", "Canada"),
        ("ORD-001003", "Wool Rug", "3", "49.99", "2024-01-17", "CUST-40266", "United Kingdom"),
        ("ORD-001004", "Bookshelf", "1", "129.99", "2024-01-18", "CUST-57731", "Germany"),
        ("ORD-001005", "Floor Mirror", "2", "349.99", "2024-01-19", "CUST-68102", "France"),
    ])


@pytest.fixture
def sample_raw_errors(spark):
    return raw_frame(spark, [
        ("ORD-001001", "Oak Desk", "2", "999.99", "2024-01-15", "CUST-20417", "United States"),
        ("ORD-001002", "  Reading Lamp  ", "-5", "29.99", "invalid-date", "", "  Canada  "),
        ("ORD-001003", "", "invalid", "49.99", "2024-01-17", "CUST-40266", ""),
        ("ORD-001001", "Bookshelf", "1", "0", "2024-01-18", "CUST-57731", "InvalidCountry"),
        ("ORD-001005", "Floor Mirror", "0", "349.99", "2030-01-19", "CUST-68102", "France"),
    ])
