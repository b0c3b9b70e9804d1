"""What a Python worker holds after an operator's tasks: it idles beside later steps and counts to their executor."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]

#: Runs an operator's function over batches, as a worker does, and prints the MB that were still held though free.
HELD = """
import ctypes, random, re
import pyarrow as pa
from pyspark.sql import functions as F
from quillgraph.llm import neardup, pieces

class Docs:
    def select(self, *_):
        return self
    def mapInArrow(self, run, _):
        return run

def anonymous():
    return int(re.search(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

random.seed(1)
words = ["".join(random.choices("abcdefghijklmnop", k=random.randint(3, 9))) for _ in range(60_000)]
texts = pa.array([" ".join(random.choices(words, k=300)) for _ in range(4000)])
ids = pa.array(range(len(texts)), pa.int64())
F.xxhash64 = lambda *_: pa
pa.alias = lambda _: None
run, batch = {
    "described": lambda: (neardup.described(Docs(), 300), pa.record_batch([ids, ids, texts], ["doc_id", "h", "text"])),
    "digest": lambda: (pieces.digest(Docs(), ids=True), pa.record_batch([ids, texts], ["doc_id", "text"])),
}[NAME]()
rows = sum(b.num_rows for b in run(iter([batch])))
held = anonymous()
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
print(rows, held - anonymous())
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory is read from /proc")
@pytest.mark.parametrize("name", ["described", "digest"])
def test_a_worker_returns_free_memory(name):
    done = subprocess.run([sys.executable, "-c", f"NAME = {name!r}\n{HELD}"], cwd=ROOT, capture_output=True, text=True, timeout=300, check=True)
    rows, held = done.stdout.split()
    assert int(rows) == 4000
    assert float(held) < 10
