"""The session of the other tests, with the subpackage's settings."""

from __future__ import annotations

import pytest

from shelfcast.llm.common import prepared


@pytest.fixture
def spark(spark):
    return prepared(spark)
