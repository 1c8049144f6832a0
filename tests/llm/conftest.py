import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from delaykit.llm.shared import send_code  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def _code(spark):
    send_code(spark)
