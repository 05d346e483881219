import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_line_of_json(folder):
    env = {
        **os.environ,
        "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2", "BENCH_RUNS": "1",
        "BENCH_QUERIES": "previous_day,top_products", "BENCH_COPIES": "3", "TMPDIR": folder,
    }
    done = subprocess.run(
        [sys.executable, f"{REPO}/bench.py"], env=env, cwd=folder, capture_output=True, text=True,
        timeout=300, check=True,
    )
    (line,) = done.stdout.splitlines()
    result = json.loads(line)
    assert set(result["queries"]) == {"previous_day", "top_products"}
    assert result["value"] > 0 and result["unit"] == "sec"
    assert (result["sf"], result["events"]) == ("0.001", 3000)
