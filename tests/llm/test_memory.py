import re
import subprocess
import sys
from pathlib import Path

from tidemark.llm.common import prepare

#: MB of a worker: before it caches texts, while it holds them, after another operator asked for its cache. A later text lies behind them in memory.
WORKER = """
import re
from tidemark.llm import common

def mb():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

common.worker_cache("other")
found = [mb()]
common.worker_cache("texts", lambda: [b"x" * 2000 + b"%d" % i for i in range(40_000)])
later = [b"y" * 2000 + b"%d" % i for i in range(1000)]
found.append(mb())
common.worker_cache("other")
print(*found, mb())
"""


def test_a_worker_hands_back_what_the_operator_before_held():
    run = subprocess.run([sys.executable, "-c", WORKER], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True)
    before, held, after = map(float, re.findall(r"[\d.]+", run.stdout))
    assert held - before > 60 and after - before < (held - before) / 3, run.stdout


def test_scans_of_texts_read_few_rows_at_once(spark):
    assert int(prepare(spark).conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
