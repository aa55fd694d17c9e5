"""Replays of a table cut into several unsorted micro-batches end in the rows of the whole table."""

import pytest

from millrace.plans import stream_catalog
from millrace.plans.catalog import QUERIES
from millrace.plans.oracle import ORACLE
from tests.compare import connect, difference

STREAMS = sorted(n for n in QUERIES if n.startswith("stream_"))


@pytest.fixture(scope="module")
def cut(spark, folder, tmp_path_factory):
    """The tables in four files by a hash of their id, so every file of the events spans all times."""
    base = tmp_path_factory.mktemp("cut")
    for name, key, order in (("events", "event_id", "props"), ("orders", "o_orderkey", "o_comment"), ("customer", "c_custkey", "c_name"), ("lineitem", "l_partkey", "l_comment")):
        table = spark.read.parquet(f"{folder}/{name}.parquet")
        order = order if order in table.columns else key
        table.repartition(4, key).sortWithinPartitions(order).write.parquet(f"{base}/{name}.parquet")
    return str(base)


@pytest.mark.parametrize("name", STREAMS)
def test_one_file_per_micro_batch(spark, folder, cut, name, monkeypatch):
    monkeypatch.setattr(stream_catalog, "BATCH_BYTES", 1)
    assert difference(QUERIES[name](spark, cut), connect(folder), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("keyed_")))
def test_keyed_state_is_in_the_plan(spark, folder, name, monkeypatch):
    """Seen at the first slice; the results are checked against SQL with those of the other queries."""
    plans = []

    class Seen(Exception):
        pass

    def first_step(spark, part, source, out, state, build):
        part.limit(0).write.parquet(source)
        plans.append(build(spark.readStream.schema(part.schema).parquet(source))._jdf.queryExecution().logical().toString())
        raise Seen

    monkeypatch.setattr(stream_catalog, "_one_step", first_step)
    with pytest.raises(Seen):
        QUERIES[name](spark, folder)
    assert "TransformWithStateInP" in plans[0]
