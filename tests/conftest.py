import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wicketflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def documents_dir(tmp_path_factory):
    import match_files

    folder = tmp_path_factory.mktemp("matches")
    match_files.write(folder)
    return str(folder)


@pytest.fixture(scope="session")
def built(spark, documents_dir, tmp_path_factory):
    """The whole job on the hand-made files: output folder and stored tables."""
    from wicketflow.plans import pipeline

    out = str(tmp_path_factory.mktemp("out"))
    stored = pipeline.run(spark, documents_dir, out)
    return out, stored
