import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stallbook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw_folder(tmp_path_factory):
    from shop import write_raw

    folder = tmp_path_factory.mktemp("raw")
    write_raw(str(folder))
    return str(folder)


@pytest.fixture(scope="session")
def landed(spark, raw_folder):
    from stallbook.sources import csv_files
    from stallbook.sources.shared import pinned

    return {name: pinned(df) for name, df in csv_files.land(spark, raw_folder).items()}


@pytest.fixture(scope="session")
def typed(landed):
    """The cleaned tables of the small shop, written once for all tests."""
    from stallbook.plans import retail
    from stallbook.sources.shared import pinned

    return {name: pinned(df) for name, df in retail.clean(landed).items()}
