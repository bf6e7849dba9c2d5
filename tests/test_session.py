"""Where tables between jobs go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from isobar import session


def fake(master: str, named: str | None = None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: named or default), sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}-{named}", _jsc=None))


def test_a_cluster_must_name_the_shared_folder():
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1000]", "k8s://https://host"):
        with pytest.raises(ValueError):
            session.scratch_path(fake(master), "x")
    assert session.shared_dir(fake("yarn", "s3a://bucket/shared/")) == "s3a://bucket/shared"
    assert session.shared_dir(fake("local[4]")) == session.LOCAL_SCRATCH


def test_all_paths_of_a_session_are_below_one_folder():
    spark = fake("yarn", "hdfs:///shared")
    a, b = session.scratch_path(spark, "a"), session.scratch_path(spark, "a")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0] and a.startswith("hdfs:///shared/")
