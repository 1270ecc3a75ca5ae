import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.ml.feature import VectorAssembler

from tablecraft.operators import clean, profile
from tablecraft.sources import from_footers, read_csv, read_csv_with_rejects, read_statistics, stage, working_path, write_csv
from tests.conftest import rows
from tests.test_plans import plan

REPO = Path(__file__).resolve().parent.parent


@pytest.fixture
def messy(tmp_path):
    path = tmp_path / "messy.csv"
    path.write_text("a,b,c\n1,x,2.5\n2,y,bad\n3,z\nq,w,1.0\n4,z,1,2\n5,,7.0\n")
    return str(path)


def test_every_query_sees_the_same_good_rows(spark, messy):
    df = read_csv(spark, messy, "a int, b string, c double")
    assert rows(df) == [(1, "x", 2.5), (5, None, 7.0)]
    assert df.count() == 2
    assert [r.b for r in df.select("b").collect()] == ["x", None]


def test_inferred_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2.5\n2,3.5\n3\n")
    df = read_csv(spark, str(tmp_path / "t.csv"))
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "double"]
    assert df.count() == 2


def test_strict_read_raises(spark, messy):
    with pytest.raises(Exception):
        read_csv(spark, messy, "a int, b string, c double", malformed="fail").collect()
    with pytest.raises(ValueError):
        read_csv(spark, messy, "a int", malformed="maybe")


def test_csv_keeps_line_breaks_quotes_and_empty_texts(spark):
    given = [(1, 'two\nlines, and "quotes"'), (2, ""), (3, None), (4, "back\\slash \\"), (5, '\\"'), (6, 'a""b')]
    df = spark.createDataFrame(given, "n int, text string")
    path = working_path(spark, "breaks")
    write_csv(df, path, line_breaks="keep")
    assert rows(read_csv(spark, path, "n int, text string", multi_line=True)) == given
    assert rows(read_csv(spark, path, "n int, text string", malformed="fail", multi_line=True)) == given


def test_line_breaks_are_refused_unless_kept(spark):
    df = spark.createDataFrame([(1, "two\nlines")], "n int, text string")
    with pytest.raises(Exception, match="line break"):
        write_csv(df, working_path(spark, "breaks"))
    with pytest.raises(ValueError):
        write_csv(df, working_path(spark, "breaks"), line_breaks="drop")


def test_csv_keeps_spaces(spark):
    path = working_path(spark, "spaces")
    write_csv(spark.createDataFrame([(" 36 months", 1)], "term string, n int"), path)
    assert rows(read_csv(spark, path, "term string, n int")) == [(" 36 months", 1)]


def test_stage_keeps_attribute_names(spark):
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame([(1, 2.0, 3.0), (2, 4.0, 5.0)], "id long, a double, b double")
    )
    staged = stage(df, "t", rebalance_by="id")
    assert staged.schema["features"].metadata == df.schema["features"].metadata
    assert rows(staged.select("a", "b")) == [(2.0, 3.0), (4.0, 5.0)]


def test_without_a_checkpoint_folder_the_warehouse_is_used(spark, tmp_path):
    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.sql.warehouse.dir": f"file:{tmp_path}/warehouse/"}.get(key, default)

        _jvm, _jsc = spark._jvm, spark._jsc

    assert working_path(Session, "t").startswith(f"file:{tmp_path}/warehouse/tablecraft/t-")


def test_nothing_is_left_when_the_session_ends(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from tablecraft.sources import stage
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "{tmp_path}").getOrCreate()
assert stage(spark.range(5), "numbers").count() == 5
print(len(list(__import__("pathlib").Path("{tmp_path}").glob("tablecraft/numbers-*"))), "staged")
spark.stop()
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180, cwd=REPO)
    assert "1 staged" in done.stdout, done.stderr[-500:]
    for _ in range(20):  # the JVM ends shortly after Python
        if not list(tmp_path.glob("tablecraft/numbers-*")):
            break
        time.sleep(0.5)
    assert not list(tmp_path.glob("tablecraft/numbers-*"))


def test_paths_are_fresh(spark):
    assert working_path(spark, "t") != working_path(spark, "t")


def test_rejects_say_what_is_wrong(spark, tmp_path):
    lines = ["a,b,day", 'x,1,2024-01-01', 'y,one,2024-01-02', 'z,2', '"q, ""r""",3,yesterday', 'w,bad,never', ',,', '"",4,', 'v,5,2024-01-05,more', ' s ,6,2024-01-06']
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text("a,b,day\nx,1,2024-01-01\nt\n")
    kind = "a string, b int, day date"
    kept, rejects = read_csv_with_rejects(spark, str(tmp_path), kind)
    assert rows(kept) == rows(read_csv(spark, str(tmp_path), kind))
    found = sorted(((r.file.rsplit("/", 1)[1], r.record, r.column, r.value, r.reason) for r in rejects.collect()), key=repr)
    assert found == sorted(
        [
            ("a.csv", "y,one,2024-01-02", "b", "one", "not int"),
            ("a.csv", "z,2", None, None, "number of fields"),
            ("a.csv", '"q, ""r""",3,yesterday', "day", "yesterday", "not date"),
            ("a.csv", "w,bad,never", "b", "bad", "not int"),
            ("a.csv", "w,bad,never", "day", "never", "not date"),
            ("a.csv", "v,5,2024-01-05,more", None, None, "number of fields"),
            ("b.csv", "t", None, None, "number of fields"),
        ],
        key=repr,
    )
    assert kept.count() + rejects.select("record_no").distinct().count() == 11
    texts, none = read_csv_with_rejects(spark, str(tmp_path / "b.csv"), "a string, b string, day string")
    assert texts.count() == 1 and [r.record for r in none.collect()] == ["t"]


def test_footers_answer_without_reading_pages(spark, sf_dir, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id % 7 as k", "if(id % 3 = 0, null, string(id)) as s").write.parquet(path)
    for report in (profile.shape, profile.column_info, lambda df: clean.narrow_plan(df.select("id", "k"))):
        text = plan(report(read_statistics(spark, path)))
        assert "PushedAggregation: [COUNT(" in text or "PushedAggregation: [MIN(" in text
        assert rows(from_footers(spark, path, report)) == rows(report(spark.read.parquet(path)))
    assert "BatchScan" not in plan(spark.read.parquet(path))


def test_pages_are_read_where_footers_do_not_know(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1.0, None), (float("nan"), None)], "a double, c int").coalesce(1).write.parquet(path)
    for c in ("a", "c"):
        report = lambda df, c=c: clean.narrow_plan(df.select(c))
        assert rows(from_footers(spark, path, report)) == rows(report(spark.read.parquet(path)))
    with pytest.raises(Exception, match="no_such"):
        from_footers(spark, path, lambda df: df.select("no_such"))
