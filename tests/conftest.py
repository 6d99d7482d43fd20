import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("CLINICGEN_SCRATCH", str(tmp_path_factory.mktemp("scratch")))
    from clinicgen.session import local_session
    s = local_session(4, 8, app="clinicgen-tests")
    yield s
    from clinicgen.session import clear_scratch
    clear_scratch(s)
    s.stop()
