import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
for p in (ROOT, ROOT / "tests"):
    if str(p) not in sys.path:
        sys.path.insert(0, str(p))


@pytest.fixture(scope="session")
def spark():
    from basetide.session import local_session

    return local_session(8, 8)


@pytest.fixture(scope="session")
def fixtures():
    return str(ROOT / "tests" / "fixtures")
