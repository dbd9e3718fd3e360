"""Column types from values: Spark's own inference, and the reasons."""

import csv
import random

import pytest

from refinery.sources import files
from refinery.sources.inference import CLASSES, column_types, inferred_schema, ingest_csv_inferred

VALUES = ["1", "-5", "+7", "007", "2147483648", "-9223372036854775808", "9223372036854775808", "1" + "0" * 37, "1" + "0" * 38,
          "1.5", "1e3", ".5", "1.5d", "NaN", "Inf", "inf", "Infinity", "2020-01-01", "2020-1-5", "2020-13-01", "2020-01-01 10:00:00",
          "2020-01-01T10:00:00", "2020-01", "10:00:00", "true", "FALSE", "yes", "abc", " 5", "5 ", "1,000", "0x10", "-", "2020/01/01",
          "2020-01-01 10:00:00.123", "2020-01-01T10:00:00Z", "-0", "99999999999999999999.5", "2020-01-01T", "12020-01-01", "20200101", ""]


def write(path, columns):
    n = max(map(len, columns))
    with open(path, "w", newline="") as f:
        out = csv.writer(f, quoting=csv.QUOTE_ALL)
        out.writerow([f"c{i}" for i in range(len(columns))])
        out.writerows([[c[i % len(c)] for c in columns] for i in range(n)])


@pytest.mark.parametrize("seed", range(2))
def test_types_are_those_of_sparks_inference(spark, tmp_path, seed):
    rng = random.Random(seed)
    columns = [[v] for v in VALUES[seed::2]] + [[rng.choice(VALUES) for _ in range(rng.choice([2, 3]))] for _ in range(35)]
    write(tmp_path / "x.csv", columns)
    own = inferred_schema(files.read_csv(spark, str(tmp_path)))
    theirs = files.read_csv(spark, str(tmp_path), infer=True).schema
    assert [(c, f.dataType) for c, f in zip(columns, own)] == [(c, f.dataType) for c, f in zip(columns, theirs)]


def test_reasons_are_told(spark, tmp_path):
    write(tmp_path / "x.csv", [["1", "2", "3"], ["1", "2", "n/a"], ["7", "2147483648", ""], ["2020-01-01", "2020-01-01 10:00:00", "2020-01-02"],
                               ["", "", ""], ["1", "1.5", "9223372036854775808"]])
    rows = column_types(files.read_csv(spark, str(tmp_path))).orderBy("position").collect()
    assert [(r.type, r.forced_by) for r in rows] == [
        ("int", "3"), ("string", "n/a"), ("bigint", "2147483648"), ("timestamp", "2020-01-01 10:00:00"), ("string", None), ("double", "1.5")]
    assert [(r.n_null, r.n_int, r.n_string) for r in rows] == [(0, 3, 0), (0, 2, 1), (1, 1, 0), (0, 0, 0), (3, 0, 0), (0, 1, 0)]
    for r in rows:
        assert r.n_null + sum(r[f"n_{k}"] for k in CLASSES) == 3


def test_one_scan_and_no_sort(spark, tmp_path):
    write(tmp_path / "x.csv", [["1", "2"], ["a", "b"]])
    plan = column_types(files.read_csv(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "Sort " not in plan


def test_typed_read_of_a_folder(spark, tmp_path):
    for name, rows in {"a": ["1,x", "2,y"], "b": ["3000000000,", ",z"]}.items():
        (tmp_path / f"{name}.csv").write_text("id,name\n" + "\n".join(rows) + "\n")
    got = ingest_csv_inferred(spark, str(tmp_path))
    assert got.dtypes == [("id", "bigint"), ("name", "string")]
    assert sorted(got.collect(), key=str) == sorted([(1, "x"), (2, "y"), (3000000000, None), (None, "z")], key=str)


def test_files_without_rows_are_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n")
    assert ingest_csv_inferred(spark, str(tmp_path)).dtypes == [("id", "string"), ("name", "string")]


def test_first_letters_end_no_typed_value(spark):
    from refinery.sources.inference import value_class
    want = {"True": "boolean", "fALSE": "boolean", "T12:30": "timestamp", "NaN": "double", "Infinity": "double", "SO1": "string", "a2020-01-01": "string",
            "Tx": "string", "-1": "int", "\u00e91": "string"}
    df = spark.createDataFrame(list(want.items()), "v string, want string")
    assert df.select("v", value_class(df["v"]).alias("k")).filter("k IS NOT NULL").rdd.collectAsMap() == want


def test_the_rule_is_in_the_plan_once_however_many_columns(spark, tmp_path):
    def patterns(n):
        write(tmp_path / f"{n}.csv", [["1", "a"]] * n)
        plan = column_types(files.read_csv(spark, f"{tmp_path}/{n}.csv"))._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("RLIKE")
    assert 0 < patterns(9) <= patterns(3)
