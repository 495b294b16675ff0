import pytest

from textlab import session


class FakeContext:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class FakeSession:
    def __init__(self, master, configured=None, current=None):
        self.sparkContext = FakeContext(master, current)
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}


@pytest.mark.parametrize("master", ["yarn", "local[2]"])
def test_the_configured_folder_wins(master):
    fake = FakeSession(master, "hdfs:/shared", "/elsewhere")
    session.ensure_checkpoint_dir(fake)
    assert fake.sparkContext.current == "hdfs:/shared"
    fake.sparkContext.current = "hdfs:/shared/run-1"
    session.ensure_checkpoint_dir(fake)
    assert fake.sparkContext.current == "hdfs:/shared/run-1"
    other = FakeSession(master, "/ck", "file:/ck2/run-1")
    session.ensure_checkpoint_dir(other)
    assert other.sparkContext.current == "/ck"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(FakeSession("yarn"))


def test_a_local_session_gets_a_temporary_folder():
    fake = FakeSession("local[2]")
    session.ensure_checkpoint_dir(fake)
    assert "textlab-checkpoint-" in fake.sparkContext.current
