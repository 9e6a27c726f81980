import pytest

from weirgate import session


class Session:
    """Only the settings of one."""

    def __init__(self, **settings):
        self.conf = settings


def test_the_shared_folder_is_required(monkeypatch):
    monkeypatch.setattr(session, "_local_root", None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(Session())
    session.provide_local_root(Session(**{"spark.master": "spark://host:7077"}))
    session.provide_local_root(Session(**{"spark.master": "local-cluster[3,2,1000]"}))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(Session())
    named = Session(**{"spark.master": "local[2]", "spark.checkpoint.dir": "hdfs:///shared/"})
    session.provide_local_root(named)
    assert session._local_root is None and session.shared_root(named) == "hdfs:///shared"
    bare = Session(**{"spark.master": "local[2]"})
    session.provide_local_root(bare)
    first = session.shared_root(bare)
    session.provide_local_root(bare)
    assert session.shared_root(bare) == first
