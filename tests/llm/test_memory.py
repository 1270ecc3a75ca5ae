import random
import re
import sys

import pyarrow as pa
import pytest

from tablecraft.llm import batches


def held() -> float:
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Pss_Anon:\s+(\d+)", f.read())[1]) / 1024


def hoard(given):
    """Much memory in small pieces, all of it free again at the end."""
    for batch in given:
        kept = [str(random.random()) * 3 for _ in range(1_000_000)]
        yield batch.slice(0, min(1, len(kept)))


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_task_leaves_no_freed_memory_behind():
    rows = pa.RecordBatch.from_pydict({"x": [1, 2]})
    for _ in batches.tidy(hoard)(iter([rows])):
        pass
    before = held()
    assert [b.num_rows for b in batches.tidy(hoard)(iter([rows, rows]))] == [1, 1]
    assert held() - before < 20


def test_operators_of_the_pipeline_are_tidy(spark, monkeypatch):
    from tablecraft.llm import ngram_join, pieces, quality
    from tablecraft.llm.queries import PIECE_MODEL

    seen = []
    for module in (ngram_join, pieces, quality):
        monkeypatch.setattr(module, "tidy", lambda made: seen.append(made) or made)
    docs = spark.createDataFrame([(1, "some words of a text that is long enough"), (2, None)], "doc_id long, text string")
    assert pieces.encode(docs, pieces.load(PIECE_MODEL), 2).count() == 3
    assert quality.keep_good(docs, None).count() == 2
    assert len(seen) == 2
    ngram_join.one_of_each(docs).count()
    assert len(seen) >= 4
