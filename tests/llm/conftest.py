import importlib.util
from pathlib import Path

import pytest

# the session settings of the other tests, from the file beside this folder
_spec = importlib.util.spec_from_file_location(
    "worklens_tests", Path(__file__).resolve().parents[1] / "conftest.py")
_tests = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_tests)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return _tests.new_session(str(tmp_path_factory.mktemp("spark")))
