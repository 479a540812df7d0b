"""Shared-folder resolution: the session's spark.checkpoint.dir wins; nothing local when it is set."""

import pytest

from comptoir.session import RUNTIME_CONF, new_subdir, prepare, shared_dir


def test_shared_dir_reads_session_setting(spark):
    target = spark.conf.get("spark.checkpoint.dir").rstrip("/")  # set by the test session builder
    assert shared_dir(spark) == target
    assert new_subdir(spark, "tables/x").startswith(target + "/tables/x-")


def test_prepare_sets_runtime_options(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    prepare(spark)
    for k, v in RUNTIME_CONF.items():
        assert spark.conf.get(k) == v


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        if key == "spark.checkpoint.dir":
            raise RuntimeError("static setting")  # as Spark: CANNOT_MODIFY_CONFIG
        self.values[key] = value


class _Ctx:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, values, master="local[4]"):
        self.conf, self.sparkContext = _Conf(values), _Ctx(master)


def test_shared_dir_fallback_when_unset():
    s = _Session({})
    d = shared_dir(s)
    assert d and shared_dir(s) == d            # created once, remembered
    assert s.sparkContext.dir == d             # used for RDD checkpoints too
    assert "spark.checkpoint.dir" not in s.conf.values


def test_no_machine_local_folder_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(_Session({}, master))


def test_shared_dir_never_overrides_cluster_setting():
    s = _Session({"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert shared_dir(s) == "hdfs://nn/shared/ckpt"
