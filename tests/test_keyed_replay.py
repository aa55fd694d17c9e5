"""Keyed replays: how many micro-batches they run."""

import os

import pytest

from millrace.plans import stream_catalog
from millrace.plans.catalog import QUERIES


def test_slices_run_no_empty_batches(spark, folder):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")

    def states():
        return {name for name in os.listdir(base) if name.startswith("keyed-state-")} if os.path.isdir(base) else set()

    before = states()
    QUERIES["keyed_home_detail"](spark, folder)
    state = (states() - before).pop()
    batches = [name for name in os.listdir(f"{base}/{state}/commits") if name.isdigit()]
    # one for each slice, one for the row after all others, and one without rows for what its time passed
    assert len(batches) == stream_catalog.SLICES + 2


def test_the_setting_comes_back(spark):
    before = spark.conf.get(stream_catalog.EMPTY_BATCHES)
    with pytest.raises(KeyError), stream_catalog._without_empty_batches(spark):
        assert spark.conf.get(stream_catalog.EMPTY_BATCHES) == "false"
        raise KeyError
    assert spark.conf.get(stream_catalog.EMPTY_BATCHES) == before
