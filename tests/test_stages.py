import subprocess
import sys
import types

import pytest

from hitledger import stages


def session(**settings):
    conf = types.SimpleNamespace(get=lambda name, default=None: settings.get(name, default))
    return types.SimpleNamespace(conf=conf)


def test_the_session_names_the_shared_folder():
    assert stages.shared_folder(session(**{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"


def test_a_cluster_without_a_shared_folder_is_refused():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            stages.shared_folder(session(**{"spark.master": master}))
    assert stages.shared_folder(session(**{"spark.master": "local[4]"})) == stages.LOCAL_FOLDER


def test_stages_are_tables_and_can_be_dropped(spark):
    table = stages.shared(spark.range(100).repartition(3))
    assert table.count() == 100 and all("/stage-" in f for f in table.inputFiles())
    stages.drop_stage(table)
    spark.catalog.clearCache()
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(table.inputFiles()[0]).count()


def test_stages_go_when_the_driver_ends(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(stages.__file__.rsplit("/", 2)[0])!r})
from hitledger.session import local_session
from hitledger.stages import shared
spark = local_session(1, **{{"spark.checkpoint.dir": "file://{tmp_path}/shared"}})
assert shared(spark.range(5)).count() == 5
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    left = [p for p in (tmp_path / "shared").rglob("*") if p.name.startswith("stage-")]
    assert left == []
