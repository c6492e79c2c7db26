import os

import pytest


@pytest.fixture(scope="session", autouse=True)
def workers_import_the_package():
    """Python workers of a session import the package from the repository."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.environ["PYTHONPATH"] = os.pathsep.join([root, os.environ.get("PYTHONPATH", "")])
