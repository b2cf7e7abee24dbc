import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shroud.session import build_session  # noqa: E402
from shroud.sources import metadata as md  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, app="shroud-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="shroud-test-ckpt-"),
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shroud-test-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="shroud-test-")


PEOPLE_SCHEMA = "id int, taxno string, mail string, pay int, perk int, area string, born date"
PEOPLE = [
    (1, "101-11-1001", "kim.oak@corp.test", 100, 5, "NORTH", dt.date(1980, 1, 1)),
    (2, None, None, None, 0, "NORTH", None),
    (3, "303-33-3003", "nomail", 300, 0, "SOUTH", dt.date(1990, 5, 5)),
    (4, "404-44-4004", "a@b@c", 20, 1, "SOUTH", dt.date(1970, 12, 31)),
    (5, "505-55-5005", "@x", 500, 2, None, dt.date(2000, 2, 29)),
    (6, "606-66-6006", "é@x.test", 0, 0, "north", dt.date(1999, 9, 9)),
]
ENTITLEMENTS = [
    ("p_north", "NORTH", True),
    ("p_null", "NORTH", None),
    ("p_two", "NORTH", False),
    ("p_two", "SOUTH", True),
    ("p_all", "ALL", False),
    ("p_all_raw", "ALL", True),
    ("p_dup", "SOUTH", True),
    ("p_dup", "SOUTH", True),
]


@pytest.fixture()
def people(spark):
    return spark.createDataFrame(PEOPLE, PEOPLE_SCHEMA)


@pytest.fixture()
def ents(spark):
    return spark.createDataFrame(ENTITLEMENTS, md.ENTITLEMENTS)
