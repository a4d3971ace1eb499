import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from inkfold.session import build_session  # noqa: E402

# A folder with stored articles, snapshots and daily reports to check results against.
STORED_CORPUS = os.environ.get("STORED_CORPUS_DIR", "")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus_root():
    if not STORED_CORPUS or not Path(STORED_CORPUS).is_dir():
        pytest.skip("STORED_CORPUS_DIR names no folder")
    return STORED_CORPUS.rstrip("/")
