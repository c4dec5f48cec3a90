import os

# Before anything loads numpy: threads of its linear algebra can be lost once a JVM has been
# started from this process, and calls into them then never return.
os.environ.setdefault("OMP_NUM_THREADS", "1")

import pytest  # noqa: E402

from tests.support import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    spark.stop()


@pytest.fixture
def ansi(spark):
    """Set ANSI mode for one test: ``ansi(False)``."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    yield lambda on: spark.conf.set("spark.sql.ansi.enabled", str(on).lower())
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture
def setting(spark):
    """Set session options for one test."""
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
