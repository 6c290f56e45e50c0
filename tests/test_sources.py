import pytest

from edgewatch.sources import edge_files, flow_files


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_headerless_edges(spark, tmp_path):
    path = write(tmp_path / "e.csv", "1,2,8680\n1,2,8680\n03,4,8690\n")
    df = edge_files.read_edges(spark, path)
    assert df.columns == ["src", "dst", "timestamp", "event_id"]
    assert [tuple(r) for r in df.orderBy("event_id").collect()] == [
        ("1", "2", 8680, 0), ("1", "2", 8680, 1), ("03", "4", 8690, 2),
    ]


def test_headed_labelled_edges(spark, tmp_path):
    path = write(tmp_path / "e.csv", "src,dst,timestamp,label\na,b,10,0\nc,d,11,1\n")
    df = edge_files.read_edges(spark, path)
    assert [tuple(r) for r in df.orderBy("event_id").collect()] == [("a", "b", 10, 0, 0), ("c", "d", 11, 1, 1)]


def test_header_names_in_any_order(spark, tmp_path):
    path = write(tmp_path / "e.csv", "Timestamp,Destination,Source\n10.7,b,a\n")
    assert tuple(edge_files.read_edges(spark, path).first()) == ("a", "b", 10, 0)


def test_header_can_be_forced(spark, tmp_path):
    path = write(tmp_path / "e.csv", "x,y,z\na,b,10\n")
    assert edge_files.read_edges(spark, path, header=True).count() == 1


def test_malformed_rows(spark, tmp_path):
    path = write(tmp_path / "e.csv", "src,dst,timestamp\na,b,10\nc,d\ne,f,soon\ng,h,12\n")
    with pytest.raises(Exception):
        edge_files.read_edges(spark, path).collect()
    good = edge_files.read_edges(spark, path, malformed="quarantine").collect()
    assert [(r.src, r.timestamp, r.event_id) for r in good] == [("a", 10, 0), ("g", 12, 3)]
    bad = edge_files.malformed_rows(spark, path).orderBy("row_idx").collect()
    assert [(r.row_idx, r.line) for r in bad] == [(1, "c,d"), (2, "e,f,soon")]


def test_too_few_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="at least 3"):
        edge_files.read_edges(spark, write(tmp_path / "e.csv", "a,b\nc,d\n"))
    with pytest.raises(ValueError, match="empty"):
        edge_files.read_edges(spark, write(tmp_path / "n.csv", ""))


@pytest.mark.parametrize("header", ["", "label\n", "is_anomaly\n"])
def test_labels_by_position(spark, tmp_path, header):
    events = edge_files.read_edges(spark, write(tmp_path / "e.csv", "1,2,5\n3,4,6\n5,6,7\n"))
    labels = edge_files.read_labels(spark, write(tmp_path / "l.csv", header + "0\n1\n0\n"))
    joined = edge_files.attach_labels(events, labels)
    assert {r.event_id: (r.src, r.label) for r in joined.collect()} == {0: ("1", 0), 1: ("3", 1), 2: ("5", 0)}


def test_label_count_must_match(spark, tmp_path):
    events = edge_files.read_edges(spark, write(tmp_path / "e.csv", "1,2,5\n3,4,6\n"))
    short = edge_files.read_labels(spark, write(tmp_path / "s.csv", "0\n"))
    long = edge_files.read_labels(spark, write(tmp_path / "l.csv", "9,0\n9,1\n9,0\n"))
    for labels in (short, long):
        with pytest.raises(ValueError, match="2 events"):
            edge_files.attach_labels(events, labels)
    with pytest.raises(ValueError):
        edge_files.attach_labels(events, short, allow_longer=True)
    kept = edge_files.attach_labels(events, long, allow_longer=True)
    assert sorted(r.label for r in kept.collect()) == [0, 1]


def test_flow_files_of_mixed_encoding_and_header(spark, tmp_path):
    write(tmp_path / "b.csv", "Flow ID, Label,Extra\n1,Web Attack – XSS,e\n", "cp1252")
    write(tmp_path / "a.csv", " Flow ID,Label \n2,BENIGN\n3,Déjà\n")
    df = flow_files.read_flow_files(spark, str(tmp_path / "*.csv"), str(tmp_path / "a*.csv"))
    rows = {r["Flow ID"]: r for r in df.collect()}
    assert len(rows) == 3
    assert (rows["2"].Label, rows["3"].Label, rows["2"].Extra, rows["1"].Extra) == ("BENIGN", "Déjà", None, "e")
    assert rows["1"].Label.startswith("Web Attack")
    groups = flow_files.inspect_files(spark, flow_files.find_files(spark, str(tmp_path / "*.csv")))
    assert sorted(g.encoding for g in groups) == ["ISO-8859-1", "UTF-8"]


def test_repeated_header_names(spark, tmp_path):
    write(tmp_path / "a.csv", "Fwd Header Length,Fwd Header Length,Label\n1,2,BENIGN\n")
    df = flow_files.read_flow_files(spark, str(tmp_path / "a.csv"))
    row = df.first()
    assert (row["Fwd Header Length"], row["Fwd Header Length.1"]) == ("1", "2")


def test_sample_per_file(spark, tmp_path):
    for name, n in (("a", 50), ("b", 3)):
        write(tmp_path / f"{name}.csv", "id,Label\n" + "".join(f"{name}{i},BENIGN\n" for i in range(n)))
    ids = [r.id for r in flow_files.read_flow_files(spark, str(tmp_path / "*.csv"), sample=10).collect()]
    assert sum(i.startswith("a") for i in ids) == 10 and sum(i.startswith("b") for i in ids) == 3


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        flow_files.find_files(spark, str(tmp_path / "*.csv"))


def test_read_flows_by_extension(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5)], "k string, `Flow Bytes/s` double")
    df.write.parquet(str(tmp_path / "p"))
    write(tmp_path / "c.csv", "k,Flow Bytes/s\na,1.5\n")
    for path in (tmp_path / "p", tmp_path / "c.csv"):
        assert [tuple(r) for r in flow_files.read_flows(spark, str(path)).collect()] == [("a", 1.5)]
