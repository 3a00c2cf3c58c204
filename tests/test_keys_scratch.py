from types import SimpleNamespace

import pytest

from landfall.operators.keys import scratch_root


def test_a_cluster_must_name_a_shared_folder():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: None))
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(session)
