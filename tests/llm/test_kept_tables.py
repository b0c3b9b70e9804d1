"""Tables that Python workers write: what is read back, and that the JVM starts no process for them."""

import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillgraph.llm.common import drop, groups, keep_mapped

ROOT = Path(__file__).resolve().parents[2]

#: Runs in a session of its own, as an executor's JVM has its PATH from its start.
SESSION = """
import json, random, sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from quillgraph.llm import repeats
from quillgraph.llm.common import keep_mapped

conf = {"spark.sql.shuffle.partitions": "3", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": sys.argv[1]}
conf["spark.hadoop.fs.viewfs.mounttable.store.link./in"] = sys.argv[2]
spark = SparkSession.builder.master("local[2,3]").config(map=conf).getOrCreate()

def run(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
        raise ValueError("the first attempt fails when its rows are written")

numbers = spark.range(300_000).repartition(3)
rng = random.Random(2)
passage = "".join(rng.choices("abcdefg ", k=900))
docs = spark.createDataFrame([(i, "".join(rng.choices("hijklmn ", k=50 * i)) + chr(192 + i) + passage * (i % 2)) for i in range(20)], "doc_id long, text string")
removed = [r.n_removed for r in repeats.remove(docs, with_text=False).collect()]
print("got", json.dumps([sorted(r.id for r in keep_mapped(numbers, run, "id long").collect()) == list(range(300_000)), sorted(removed)]))
"""


def session(tmp_path, folder):
    """What SESSION tells with a shared folder, and the files there that chmod was called for."""
    calls = tmp_path / "calls"
    calls.touch()
    chmod = tmp_path / "bin/chmod"
    chmod.parent.mkdir()
    chmod.write_text(f'#!/bin/sh\necho "$*" >> {calls}\nexec {shutil.which("chmod")} "$@"\n')
    chmod.chmod(0o755)
    env = os.environ | {"PATH": f"{chmod.parent}:{os.environ['PATH']}", "PYTHONPATH": str(ROOT), "SPARK_LOCAL_IP": "127.0.0.1"}
    done = subprocess.run([sys.executable, "-c", SESSION, folder, f"file://{tmp_path}/shared"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    told = [line for line in done.stdout.splitlines() if line.startswith("got ")]
    assert told, done.stderr[-2000:]
    return json.loads(told[0][4:]), [c for c in calls.read_text().splitlines() if "/quillgraph/" in c]


@pytest.mark.parametrize("folder", ["file://{}/shared", "viewfs://store/in"])
def test_removal_in_a_shared_folder(tmp_path, folder):
    (tmp_path / "shared").mkdir()
    (whole, removed), calls = session(tmp_path, folder.format(tmp_path))
    assert whole  # without the rows of the attempt that failed
    assert removed == [0] * 10 + [900] * 10
    if folder.startswith("file"):
        assert not calls


def test_kept_rows_are_read_back(spark):
    rows = [(1, None, [(1, 2), (3, 4)], b"\0\xff", True), (None, "é", [], None, False), (3, "", None, b"", None)]
    df = spark.createDataFrame(rows, "a long, `b c` string, d array<struct<low: int, high: int>>, e binary, f boolean")
    kept = keep_mapped(df)
    assert kept.schema == df.schema
    assert sorted(kept.collect(), key=str) == sorted(df.collect(), key=str)
    paths = kept.inputFiles()
    assert paths
    drop(kept)
    assert not any(Path(p.removeprefix("file://")).exists() for p in paths)
    none = keep_mapped(df.filter(F.lit(False)))
    assert none.schema == df.schema and none.count() == 0
    drop(none)


def test_groups_of_sorted_batches():
    table = pa.table({"k": [1, 1, 2, 2, 2, 5, 6, 6], "v": list(range(8))})
    batches = [*table.slice(0, 4).to_batches(), *table.slice(0, 0).to_batches(), *table.slice(4).to_batches(max_chunksize=1)]
    assert [g.to_pydict() for g in groups(iter(batches), "k")] == [{"k": [k] * len(v), "v": v} for k, v in ((1, [0, 1]), (2, [2, 3, 4]), (5, [5]), (6, [6, 7]))]
    assert list(groups(iter([]), "k")) == []
