"""Session helpers."""

import pytest

from millrace.plans.catalog import QUERIES
from millrace.plans.oracle import ORACLE
from millrace.plans import stream_catalog  # noqa: F401  registers the streams
from millrace.session import HEAP_PROVIDER, SETTINGS, STATE_PROVIDER, shared_dir, shuffle_partitions
from tests.compare import connect, difference


def test_partitions_follow_the_data():
    assert shuffle_partitions(1) == 8
    assert shuffle_partitions(10 * 1024**4) == 81_920
    assert shuffle_partitions(100 * 1024**4) == 819_200


def test_state_folders_lie_in_the_named_folder(spark):
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_settings_are_applied(spark):
    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())


def test_no_local_folder_on_a_cluster(monkeypatch):
    """Executors of a cluster don't share the driver's disk."""

    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session, "x")
    Session.sparkContext.master = "local[2]"
    assert "/x-" in shared_dir(Session, "x")


@pytest.mark.parametrize("name", ["keyed_unique_visitor", "stream_join_left"])
def test_keyed_state_in_a_session_made_elsewhere(spark, folder, name):
    """Spark's default state store holds one state per key only; the session keeps its setting."""
    other = spark.newSession()
    other.conf.set(STATE_PROVIDER, HEAP_PROVIDER)
    other.conf.set("spark.sql.shuffle.partitions", "2")
    other.conf.set("spark.sql.session.timeZone", "UTC")
    assert difference(QUERIES[name](other, folder), connect(folder), ORACLE[name]) is None
    assert other.conf.get(STATE_PROVIDER) == HEAP_PROVIDER
