import pytest

from phenospark.sources.shared import shared_base


class Session:
    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key.rsplit(".", 2)[-2] + key.rsplit(".", 1)[-1], default)


def test_the_named_folder_comes_first():
    assert shared_base(Session(checkpointdir="hdfs://a/b/", warehousedir="x")) == "hdfs://a/b"


def test_warehouse_is_used_where_none_is_named():
    assert shared_base(Session(warehousedir="file:/w", sparkmaster="local[8]")) == "file:/w"
    assert shared_base(Session(warehousedir="s3a://w", sparkmaster="yarn")) == "s3a://w"


@pytest.mark.parametrize("master", ["yarn", "local-cluster[3,2,1024]"])
def test_a_local_warehouse_is_refused_on_a_cluster(master):
    with pytest.raises(ValueError):
        shared_base(Session(warehousedir="/w", sparkmaster=master))
