"""Quality of op7 on labelled rows that it has not learned from."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tracklake.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test data")
def test_toxic_documents_of_the_held_out_fold(spark):
    """The chance that a toxic document scores above another one, ties by half, and precision at 0.5."""
    scores = QUERIES["op7_string_kernel_toxicity"](spark, FOLDER).where("held_out")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "toxic")
    rows = scores.join(labels, "doc_id").where(F.col("toxic").isNotNull()).select("score", "predicted", "toxic").collect()
    bad, good = ([r.score for r in rows if r.toxic == kind] for kind in (1, 0))
    assert len(bad) > 50 and len(good) > 500
    above = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))
    marked = [r.toxic for r in rows if r.predicted == 1]
    print("chance", above, "recall", sum(marked) / len(bad), "precision", sum(marked) / len(marked))
    assert above > 0.88
    assert sum(marked) / len(marked) > 0.7 and sum(marked) / len(bad) > 0.4
