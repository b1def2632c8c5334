"""What Python workers keep between the tasks of different operators."""

import gc
import os
import re
import subprocess
import sys
import weakref

from helpers import frame
from weftable.llm import decontaminate, pieces, workers
from weftable.llm.jaccard import jaccard_components, keep_one
from weftable.llm.queries import tokenizer_path

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RETAINED = """
import re, sys
import numpy as np
from weftable.llm.workers import tasks_of

def anonymous():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

def work(parts):
    for part in parts:
        np.ones(30 << 17).sum()  # from now on the C library keeps arrays up to this size
        held = [np.ones(1 << 17) for _ in range(60)]
        last = bytearray(1 << 17)  # lies behind them
        del held
        yield last

before = anonymous()
left = list((tasks_of("a")(work) if sys.argv[1] == "tidy" else work)(iter([0])))
print(anonymous() - before)
"""


def _retained(how):
    run = subprocess.run([sys.executable, "-c", RETAINED, how], cwd=REPO, env={"PATH": os.environ["PATH"]}, capture_output=True, text=True)
    assert not run.returncode, run.stderr
    return float(run.stdout)


def test_a_task_leaves_no_freed_memory():
    assert _retained("tidy") + 25 < _retained("plain")


def test_a_task_drops_what_other_operators_keep():
    model = pieces._tools(tokenizer_path("pieces"), "zipf")[0]
    gone = weakref.ref(model)
    assert list(workers.tasks_of("pieces")(lambda parts: parts)(iter([1]))) == [1]
    assert pieces._tools(tokenizer_path("pieces"), "zipf")[0] is model
    del model
    assert list(workers.tasks_of("jaccard")(lambda parts: parts)(iter([1, 2]))) == [1, 2]
    gc.collect()
    assert gone() is None


def test_no_rows_come_from_the_driver(spark):
    """Rows of the driver are read by Python workers of a second kind, beside those of the searches."""
    docs = spark.range(1).selectExpr("1L doc_id", "'a passage of eleven different words that is long enough here' text")
    for items, n in ((docs.selectExpr("doc_id item_id", "text"), 1), (docs.selectExpr("doc_id item_id", "text").filter("item_id = 0"), 0)):
        found = decontaminate.find_passages(docs, items, by_text=True)
        assert not re.search("ExistingRDD", found._jdf.queryExecution().executedPlan().toString())
        assert found.columns == ["doc_id", "item_id", "distance", "word", "n_words", "text_hash"]
        assert [(r.doc_id, r.item_id, r.distance) for r in found.collect()] == [(1, 1, 0)] * n


def test_rows_stay_whole(spark):
    """Functions on columns get every batch of a partition."""
    rows = frame(spark, [(i, f"text {i // 2}") for i in range(100)], extra=False).coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        left = keep_one(rows, jaccard_components(rows, by_text=True))
        assert sorted(r.doc_id for r in left.collect()) == list(range(0, 100, 2))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
