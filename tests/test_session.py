import pytest

from landfall.session import scratch_path


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Session:
    def __init__(self, **conf):
        self.conf = Conf({f"spark.{k.replace('__', '.')}": v for k, v in conf.items()})


def test_scratch_follows_the_session():
    path = scratch_path(Session(checkpoint__dir="s3a://bucket/shared", master="spark://x"), "csv")
    assert path.startswith("s3a://bucket/shared/landfall/csv-")
    assert path != scratch_path(Session(checkpoint__dir="s3a://bucket/shared"), "csv")


def test_scratch_on_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(master="yarn"), "csv")
    assert "landfall-" in scratch_path(Session(master="local[2]"), "csv")


def test_session_zone(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
