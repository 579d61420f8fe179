from types import SimpleNamespace

import pytest

from wardline.session import scratch_path, shared_folder


def session(master, named=None):
    folder = []
    context = SimpleNamespace(
        master=master,
        applicationId="app-1",
        getCheckpointDir=lambda: folder[0] if folder else None,
        setCheckpointDir=folder.append,
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=context)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(master))
    assert shared_folder(session(master, "s3://bucket/x")) == "s3://bucket/x"
    assert scratch_path(session(master, "s3://bucket/x/"), "step").startswith("s3://bucket/x/app-1/step-")


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[2,3]"])
def test_one_machine_may_use_its_own(master):
    assert "wardline-" in shared_folder(session(master))
