from __future__ import annotations

from types import SimpleNamespace

import pytest

from bazar.session import RUNTIME_SETTINGS, scratch_root


def fake(master, configured=None, checkpoint=None):
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else checkpoint, setCheckpointDir=made.append)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured)), made


def test_settings_are_applied(spark):
    assert {key: spark.conf.get(key) for key in RUNTIME_SETTINGS} == RUNTIME_SETTINGS


def test_the_shared_folder_of_the_session_is_used(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    session, made = fake("spark://host:7077", configured="hdfs:///shared/")
    assert scratch_root(session) == "hdfs:///shared" and made == ["hdfs:///shared/"]
    session, made = fake("yarn", checkpoint="hdfs:///set-before")
    assert scratch_root(session) == "hdfs:///set-before" and made == []


def test_a_cluster_without_a_shared_folder_is_refused():
    session, made = fake("yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session)
    assert made == []


def test_a_local_session_makes_its_own_folder():
    session, made = fake("local[2]")
    assert scratch_root(session) == made[0]
