"""What searches of vectors send: nothing whole to the driver, and to a task's output no more at a time than stated."""

import numpy as np
import pandas as pd

from gridmill.operators.vectors import cosine_topk
from gridmill.plans import catalog
from gridmill.sources.cells import MOST_BYTES, CellIndex, unit


def test_blocks_of_queries_are_not_broadcast(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 8)))], "k long, v array<double>")
    found = cosine_topk(df.filter("k % 10 = 0"), df, "k", "v", 3)
    assert len(found.collect()) == 90
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def unspread(spark):
    """An index of 4 096 cells that was fitted on nothing, and 64 queries."""
    rng = np.random.default_rng(4)
    index = CellIndex.__new__(CellIndex)
    index.spark, index.centres = spark, unit(list(rng.normal(size=(4096, 64))), 64)[1]
    index.cells = lambda: spark.createDataFrame([(c, -1.0) for c in range(4096)], "cell int, least double")
    return index, pd.DataFrame({"query": range(64), "qv": list(rng.normal(size=(64, 64))), "worst": 0.5})


def test_queries_for_many_cells_leave_in_slices(spark):
    index, queries = unspread(spark)
    for run, cells in ((index._nearest_cells(3000), 3000), (index._open_cells(96), 4000)):
        made = list(run(iter([queries])))
        assert max(len(d) for d in made) * 64 * 8 <= MOST_BYTES
        rows = pd.concat(made)
        assert len(rows) == 64 * cells and not rows[["query", "cell"]].duplicated().any()


def test_exact_side_of_recall_is_not_broadcast(spark, sf):
    found = catalog.QUERIES["cell_recall"](spark, sf)
    assert found.first()["recall"] >= 0.9
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_part" in plan and "BroadcastHashJoin [_part" not in plan


def test_rounds_of_the_fit_have_no_task_for_each_cell(spark, tmp_path):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 64)))], "k long, v array<double>").repartition(4)
    context, status = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("fit", "")
    try:
        assert CellIndex(spark, f"{tmp_path}/c", "k", buckets=4).fit(df, "v", 140) == 140
    finally:
        context._jsc.clearJobGroup()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("fit") for s in status.getJobInfo(j).stageIds]
    assert len(stages) > 20 and max(s.numTasks for s in stages if s) < 140
