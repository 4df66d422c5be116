"""The package works from any folder, with workers that cannot import it."""

import pathlib
import subprocess
import sys

from tests.conftest import SF

CODE = """
import sys
sys.path.insert(0, {repo!r})
from demandtide.session import build_session
from demandtide.plans.queries import QUERIES
spark = build_session("local[2]", shuffle_partitions=2)
for name in ("isolation_forest", "holt_winters_grid", "sarima_css"):
    assert QUERIES[name](spark, {sf!r}).count() > 0
"""


def test_workers_need_no_installation(tmp_path):
    repo = str(pathlib.Path(__file__).resolve().parent.parent)
    done = subprocess.run([sys.executable, "-c", CODE.format(repo=repo, sf=SF)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
