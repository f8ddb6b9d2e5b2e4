import os
import subprocess
import sys
import time

import pytest

from stallbook.sources import shared


class _Settings(dict):
    """Stands for a session: ``conf.get`` is all that is asked of it."""

    @property
    def conf(self):
        return self


def test_the_clusters_folder_is_used():
    session = _Settings({"spark.checkpoint.dir": "hdfs:///shared/", "spark.master": "yarn"})
    assert shared.shared_folder(session) == "hdfs:///shared"


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_folder(_Settings({"spark.master": "spark://host:7077"}))


def test_a_local_session_makes_one_folder():
    session = _Settings({"spark.master": "local[2]", "spark.app.id": "app-1"})
    assert shared.shared_folder(session) == shared.shared_folder(session)


def test_pinned_keeps_rows_and_types(spark):
    df = spark.sql("SELECT id, CAST(id AS DECIMAL(10,2)) d, TIMESTAMP_NTZ'2018-01-01 00:00:00' t FROM range(5)")
    back = shared.pinned(df)
    assert back.dtypes == df.dtypes and back.exceptAll(df).count() == 0 and back.count() == 5


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from stallbook.session import local_session
from stallbook.sources.shared import pinned
df = pinned(local_session(cores=1).range(3))
print("rows", df.count(), df.inputFiles()[0])
"""


def test_what_was_pinned_goes_when_the_driver_ends():
    repo = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..")
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo)], capture_output=True, text=True, timeout=120)
    word, rows, file = next(line for line in done.stdout.splitlines() if line.startswith("rows")).split()
    assert rows == "3" and "pinned-" in file
    folder = os.path.dirname(file.removeprefix("file:").replace("///", "/"))
    for _ in range(50):
        if not os.path.exists(folder):
            break
        time.sleep(0.2)
    assert not os.path.exists(folder)
