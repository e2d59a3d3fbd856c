import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terrace.session import get_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="terrace-tests-")
    s = get_session(
        "local[4]",
        app_name="terrace-tests",
        shuffle_partitions=4,
        extra_conf={
            "spark.checkpoint.dir": scratch + "/ckpt",
            "spark.sql.warehouse.dir": scratch + "/warehouse",
        },
    )
    yield s
    s.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi_on", "ansi_off"])
def ansi(spark, request):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.fixture
def scratch(spark):
    from terrace.session import scratch_dir

    return scratch_dir(spark, "test")
