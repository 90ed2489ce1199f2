"""Every operator runs where the workers cannot import this package."""

import os
import subprocess
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})  # the driver's path only
from tidewatch.session import build_session
spark = build_session("local[4]", shuffle_partitions=4, extra={{"spark.checkpoint.dir": {scratch!r} + "/ckpt", "spark.local.dir": {scratch!r}}})

def probe(_):
    try:
        import tidewatch
        return ["there"]
    except ModuleNotFoundError:
        return ["absent"]

assert spark.sparkContext.parallelize([0], 1).mapPartitions(probe).collect() == ["absent"]
import __spark_entry__ as entry
known = entry.queries()
names = [n for n in known if n.startswith("op") and n[2].isdigit()] + ["pipeline"]
for name in names:
    if {names!r} and name not in {names!r}:
        continue
    print("rows", name, known[name](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("names", [["op1_embedding_near_dedup", "op3_lm_scoring", "op6_best_fit_packing", "op7_quality_rules"],
                                   ["op8_warc", "op9_toxicity", "op10_simhash_near_dedup", "op11_ranked_search"],
                                   ["op2_mix_sources", "op4_line_dedup", "op5_license_scans", "op12_merkle_manifest",
                                    "op13_secret_scans"]])
def test_queries_run_without_the_package_on_the_workers(names):
    scratch = tempfile.mkdtemp(prefix="tidewatch-far-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, scratch=scratch, names=names)], cwd=scratch, env=env,
                          capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    rows = [line.split()[1] for line in done.stdout.splitlines() if line.startswith("rows ")]
    assert sorted(rows) == sorted(names)
