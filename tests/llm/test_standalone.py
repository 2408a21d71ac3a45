import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CODE = """
import sys
sys.path.insert(0, {root!r})
from threadlens.llm.queries import QUERIES
from threadlens.session import build_session
spark = build_session("local[2]", shuffle_partitions=2)
for name in ("op6_language", "op8_toxicity", "op9_url_filter", "op10_quality"):
    print(name, len(QUERIES[name](spark, "/root/testdata/sf0.001").collect()))
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Started elsewhere, without the repository on the workers' path."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT)], cwd=tmp_path, env=env, text=True,
                         capture_output=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split() == ["op6_language", "200", "op8_toxicity", "200", "op9_url_filter", "50",
                                  "op10_quality", "200"]
