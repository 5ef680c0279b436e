"""What a task has freed is not kept by the worker that ran it."""

import subprocess
import sys
from pathlib import Path

from railpulse.llm import common

HELD = """
import sys
import numpy as np
import pyarrow as pa
from railpulse.llm.common import over_batches

def size():
    return next(int(line.split()[1]) for line in open("/proc/self/status") if line.startswith("RssAnon")) // 1024

class Table:
    def mapInArrow(self, run, schema):
        return run(iter([pa.record_batch({"x": [1]})]))

kept = []
def work(batch):
    parts = [np.ones(12_000) for _ in range(1000)]  # 96 MB, each too small to be mapped by itself
    kept.append(np.ones(12_000))  # on top of them
    return batch

before = size()
list(over_batches(Table(), work, "x long"))
print(size() - before)
"""


def test_freed_memory_goes_back_at_the_end_of_a_task():
    root = Path(common.__file__).resolve().parents[2]
    said = subprocess.run([sys.executable, "-c", HELD], cwd=root, capture_output=True, text=True, timeout=120, check=True)
    assert int(said.stdout) < 30
