from __future__ import annotations

import pytest

from matchlytics.session import local


@pytest.fixture(scope="session")
def spark():
    session = local(8, shuffle_partitions=4)
    yield session
    session.stop()
