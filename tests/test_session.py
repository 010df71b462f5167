"""Only local sessions get scratch folders; a cluster must name its shared one."""

import pytest

from sacctlens import session


class _Context:
    def __init__(self, master, conf):
        self.master, self.conf, self.dir = master, conf, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path

    def getConf(self):
        return self.conf


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_folder_fails(master):
    with pytest.raises(RuntimeError, match="shared folder"):
        session.checkpoint_dir(_Session(master))
    named = _Session(master, {"spark.checkpoint.dir": "hdfs://x/y"})
    assert session.checkpoint_dir(named) == "hdfs://x/y" == named.sparkContext.dir


def test_local_session_gets_a_scratch_folder():
    assert session.checkpoint_dir(_Session("local[2]"))


@pytest.mark.parametrize("master,local", [("local[4]", True), ("local", True), ("yarn", False), ("local-cluster[2,1,1024]", False)])
def test_scratch_settings_are_for_local_masters(master, local):
    conf = session.settings(master, 4, {})
    assert ("spark.checkpoint.dir" in conf) == ("spark.sql.warehouse.dir" in conf) == local
