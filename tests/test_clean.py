import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from edgewatch.operators import clean
from edgewatch.schemas import LABEL_CLASSES, NUMERIC_FEATURES, PROFILE_FEATURES

FLOW = "`Source IP` string, `Destination IP` string, Timestamp string, `Flow Duration` string, Label string, n long"


def flows(spark):
    return spark.createDataFrame(
        [
            ("1.1.1.1", "2.2.2.2", "2017-07-03 08:55:58", "1000", "BENIGN", 0),
            ("1.1.1.1", "2.2.2.2", "2017-07-03 08:55:59", "5000", " DDoS ", 1),
            ("3.3.3.3", "2.2.2.2", "2017-07-03 08:56:00", "3000", "BENIGN", 2),
        ],
        FLOW,
    )


def test_clean_minimal_flows(spark):
    rows = clean.clean_flows(flows(spark), ["n"]).orderBy("n").collect()
    assert [r.Label for r in rows] == ["Benign", "DDoS", "Benign"]
    assert [r.is_attack for r in rows] == [False, True, False]
    assert [r.attack_type for r in rows] == ["Benign", "DDoS", "Benign"]
    assert rows[0].Timestamp == datetime(2017, 7, 3, 8, 55, 58)
    assert rows[1]["Flow Duration"] == 5000.0


def test_infinite_and_missing_become_the_median(spark):
    df = spark.createDataFrame(
        [("1000", None), ("inf", 700.0), ("Infinity", float("nan")), ("oops", 900.0), ("3000", float("-inf"))],
        "`Flow Duration` string, `Flow Bytes/s` double",
    )
    for exact in (True, False):
        out = clean.impute_medians(df, exact=exact).collect()
        assert all(math.isfinite(r["Flow Duration"]) and math.isfinite(r["Flow Bytes/s"]) for r in out)
    numbered = df.withColumn("row", F.monotonically_increasing_id())
    out = clean.impute_medians(numbered).orderBy("row").collect()
    assert [r["Flow Duration"] for r in out] == [1000.0, 2000.0, 2000.0, 2000.0, 3000.0]
    assert [r["Flow Bytes/s"] for r in out] == [800.0, 700.0, 800.0, 900.0, 800.0]


def test_empty_column_stays_null(spark):
    df = spark.createDataFrame([("x", "1"), ("y", "2")], "`Idle Max` string, `Idle Min` string")
    assert sorted((tuple(r) for r in clean.impute_medians(df).collect()), key=str) == [(None, 1.0), (None, 2.0)]


def test_unknown_labels(spark):
    df = spark.createDataFrame([("Heartbleed",), (" BENIGN",), (None,)], "Label string")
    assert [r.Label for r in clean.normalize_labels(df).collect()] == ["Benign"] * 3
    assert [r.Label for r in clean.normalize_labels(df, "keep").collect()] == ["Heartbleed", "Benign", "Benign"]
    with pytest.raises(Exception, match="unknown label"):
        clean.normalize_labels(df, "error").collect()
    with pytest.raises(ValueError):
        clean.normalize_labels(df, "drop")
    counts = {r.label: r.rows for r in clean.unknown_labels(df).collect()}
    assert counts == {"Heartbleed": 1, None: 1}


def test_every_known_label(spark):
    df = spark.createDataFrame([(k,) for k in LABEL_CLASSES], "Label string")
    got = df.select("Label", clean.label_class(F.col("Label")).alias("c")).collect()
    assert {r.Label: r.c for r in got} == LABEL_CLASSES
    assert len(set(LABEL_CLASSES.values())) == 14
    assert len(NUMERIC_FEATURES) == len(set(NUMERIC_FEATURES)) == 76
    assert len(PROFILE_FEATURES) == 20


def test_label_column_is_required(spark):
    with pytest.raises(ValueError, match="Label"):
        clean.clean_flows(spark.createDataFrame([(1,)], "n int"), ["n"])


def test_column_names_are_trimmed(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` a` int, `a ` int, b int")
    assert clean.trim_column_names(df).columns == ["a", "a.1", "b"]


def test_timestamp_layouts(spark):
    texts = [
        "03/07/2017 08:55:58", "3/7/2017 8:55:58 PM", "2017-07-03 20:55:58", "2017-07-03 08:55:58 AM", "soon", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.p for r in df.select(clean.parse_timestamps(F.col("t")).alias("p")).collect()]
    am, pm = datetime(2017, 7, 3, 8, 55, 58), datetime(2017, 7, 3, 20, 55, 58)
    assert got == [am, pm, pm, am, None, None]


def test_duplicates_keep_the_first_in_load_order(spark):
    rows = [("a", None, "t3", 3), ("a", None, "t1", 1), ("a", 1.0, "t2", 2), ("a", None, "t5", 5)]
    df = spark.createDataFrame(rows, "k string, x double, Timestamp string, n long")
    got = {(r.k, r.x, r.Timestamp, r.n) for r in clean.drop_duplicate_flows(df, ["n"]).collect()}
    assert got == {("a", None, "t1", 1), ("a", 1.0, "t2", 2)}
    kept = clean.drop_duplicate_flows(df, ["n"], ignore_columns=())
    assert kept.count() == 4


def test_summary(spark):
    cleaned = clean.clean_flows(flows(spark), ["n"])
    row = clean.dataset_summary(cleaned, files_loaded=1).first()
    assert (row.total_rows, row.benign_rows, row.attack_rows) == (3, 2, 1)
    assert row.attack_types == {"Benign": 2, "DDoS": 1}
    assert (row.numeric_columns, row.files_loaded) == (1, 1)
