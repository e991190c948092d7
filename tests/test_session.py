"""The shared scratch folder and the file systems that tasks open archives on."""

import os

import pyarrow.fs as pafs
import pytest

from rowsmith import session as S


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):  # noqa: N802 - Spark's name
        return None


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    conf = _Conf()

    def __init__(self, master):
        self.sparkContext = _Context(master)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_root(_Session(master))


def test_a_local_session_gets_a_folder(spark):
    assert os.path.isdir(S.local_path(S.checkpoint_root(spark)))


@pytest.mark.parametrize("scheme", ["s3", "s3a", "s3n"])
def test_s3_schemes_use_one_file_system(monkeypatch, scheme):
    seen = []

    class Files:
        @staticmethod
        def from_uri(uri):
            seen.append(uri)
            return "fs", "bucket/a.zip"

    monkeypatch.setattr(pafs, "FileSystem", Files)
    assert S.file_system(f"{scheme}://bucket/a.zip") == ("fs", "bucket/a.zip")
    assert seen == ["s3://bucket/a.zip"]


def test_input_bytes(spark, tmp_path):
    for name, size in (("a/x.zip", 10), ("a/y.zip", 5), ("b/z.zip", 7)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)
    assert S.input_bytes(spark, str(tmp_path / "a")) == 15
    assert S.input_bytes(spark, [str(tmp_path / "*" / "x.zip"), str(tmp_path / "b")]) == 17
    assert S.input_bytes(spark, str(tmp_path / "none")) == 0


def test_an_unknown_scheme_says_so():
    with pytest.raises(ValueError, match="nope"):
        S.file_system("nope://host/a.zip")
