import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from comptoir.session import build_session, ensure_checkpoint_dir

    s = build_session("local[4]", 8)
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="comptoir-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
