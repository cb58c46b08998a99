"""Extract reading, the input gate, tables and scratch folders."""

import csv
import gzip
import io
import random
import warnings

import pytest
from plans import scan_metrics

from marquee.scratch import scratch_root
from marquee.sinks import preview, show_preview, write_table
from marquee.sources import ranges
from marquee.sources import (
    literal_rows,
    missing_inputs,
    read_extract,
    read_table,
    require_inputs,
)

PIECES = ["a", "bc ", " x", '"', '""', ",", "\n", "\n\n", "\r\n", "é漢", "word" * 20, "[{}]", "\\"]


def random_rows(rng, count):
    def field():
        return "".join(rng.choices(PIECES, k=rng.randint(0, 6)))

    return [[str(i), field(), field()] for i in range(count)]


def write_csv(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator=end, quoting=quoting)
        writer.writerow(["id", "first", "second"])
        writer.writerows(rows)


def sorted_rows(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("split_bytes, count", [("64", 8), ("700", 50), ("100000", 200)])
def test_split_reading_equals_whole_file_reading(spark, conf, tmp_path, seed, split_bytes, count):
    rng = random.Random(seed)
    folder = tmp_path / "in"
    folder.mkdir()
    for number in range(3):
        quoting = csv.QUOTE_ALL if number == 2 else csv.QUOTE_MINIMAL
        write_csv(folder / f"{number}.csv", random_rows(rng, count), "\n", quoting)
    whole = read_extract(spark, str(folder), split_records=False)
    expected = sorted_rows(whole)
    assert len(expected) == 3 * count
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        split = read_extract(spark, str(folder), split_records=True, scratch=str(tmp_path / "scratch"))
    assert split.schema == whole.schema
    assert sorted_rows(split) == expected


def test_a_record_may_span_many_splits(spark, conf, tmp_path):
    long = "\n".join(["line, with \"quotes\""] * 500)
    rows = [["1", long, "end"], ["2", "short", long], ["3", "", "last"]]
    write_csv(tmp_path / "in.csv", rows)
    conf("spark.sql.files.maxPartitionBytes", "300")
    got = read_extract(spark, str(tmp_path / "in.csv"), split_records=True)
    assert [tuple(row) for row in got.sort("id").collect()] == [
        ("1", long, "end"), ("2", "short", long), ("3", None, "last"),
    ]


LINE_ENDS = {
    "all CRLF": 'id,first,second\r\n1,"a\r\nb",c\r\n\r\n2,x,"y"\r\n',
    "CRLF, others in quotes": 'id,first,second\r\n1,"a\nb\r\n",c\r\n2,"x\r","\r\r\n"\r\n',
    "CRLF, then LF": 'id,first,second\r\n1,a,"b\r\nc"\n2,x,y\n\n3,"p","q"\r\n',
    "LF, then CRLF": 'id,first,second\n1,"a\r\nb",c\n2,x,y\n3,p,"q\r"\n',
    "CR": 'id,first,second\r1,a,b\r2,"x\ny",z\r',
    "CRLF in the header": 'id,"fi\r\nrst",second\n1,"a\r\nb",c\n2,x,y\n',
}


@pytest.mark.parametrize("name", LINE_ENDS)
def test_line_ends_are_taken_as_by_the_whole_file_scan(spark, conf, tmp_path, name):
    (tmp_path / "in.csv").write_bytes(LINE_ENDS[name].encode())
    whole = read_extract(spark, str(tmp_path / "in.csv"), split_records=False)
    expected = sorted_rows(whole)
    conf("spark.sql.files.maxPartitionBytes", "12")
    got = read_extract(spark, str(tmp_path / "in.csv"), split_records=True)
    assert got.columns == whole.columns
    assert sorted_rows(got) == expected


def test_header_with_a_line_break(spark, conf, tmp_path):
    (tmp_path / "in.csv").write_text('id,"two\nlines"\n1,"a"\n2,"b\nc"\n')
    conf("spark.sql.files.maxPartitionBytes", "9")
    got = read_extract(spark, str(tmp_path / "in.csv"), split_records=True)
    assert got.columns == ["id", "two\nlines"]
    assert [tuple(row) for row in got.sort("id").collect()] == [("1", "a"), ("2", "b\nc")]


def test_short_rows_and_missing_last_line_break(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,first,second\n1\n2,"x ""y"" z"\n3,,"q"')
    expected = [("1", None, None), ("2", 'x "y" z', None), ("3", None, "q")]
    for limit in (True, False):
        got = read_extract(spark, str(tmp_path / "in.csv"), split_records=limit)
        assert [tuple(row) for row in got.sort("id").collect()] == expected


IRREGULAR = {
    "odd number": '1,5" disk,a\n2,"x",b\n',
    "two lines with one each": '1,5",a\n2,x,y\n3,6",b\n',
    "at a field's end after a quoted field": '1,"x",5"\n2,"y",6"\n',
    "after blank": '1, "x,a\n2, y",b\n',
    "before blank": '1,"x" ,a\n2,"y" ,b\n',
    "in the middle": '1,a"b,c\n2,d"e,f\n',
    "after a record of two lines": '1,"x\ny",5"\n2,z,6"\n',
    "control character": '1,\x01,a\n2,"b\x01",c\n',
}


@pytest.mark.parametrize("name", IRREGULAR)
@pytest.mark.parametrize("split_bytes", ["16", "1000"])
def test_irregular_quotes_are_left_to_the_whole_file_scan(spark, conf, tmp_path, name, split_bytes):
    (tmp_path / "in.csv").write_text("id,first,second\n" + IRREGULAR[name])
    expected = sorted_rows(read_extract(spark, str(tmp_path / "in.csv"), split_records=False))
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        got = read_extract(spark, str(tmp_path / "in.csv"), split_records=True)
    assert any("task per file" in str(w.message) for w in caught) or name == "control character"
    assert sorted_rows(got) == expected


def test_a_record_beyond_what_a_string_holds_is_refused(spark, conf, monkeypatch, tmp_path):
    write_csv(tmp_path / "in.csv", [["1", "a\n" * 500, "b"]])
    conf("spark.sql.files.maxPartitionBytes", "100")
    monkeypatch.setattr("marquee.sources.records.MAX_RECORD", 400)
    with pytest.raises(ValueError, match="longer than a Spark string"):
        read_extract(spark, str(tmp_path / "in.csv"), split_records=True)


def test_only_irregular_files_are_read_whole(spark, conf, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rng = random.Random(4)
    for number in range(2):
        write_csv(folder / f"{number}.csv", random_rows(rng, 30))
    (folder / "bad.csv").write_text('id,first,second\n1,5" disk,a\n2,"x\ny",b\n')
    expected = sorted_rows(read_extract(spark, str(folder)))
    conf("spark.sql.files.maxPartitionBytes", "100")
    with pytest.warns(UserWarning, match="1 irregular files"):
        got = read_extract(spark, str(folder), split_records=True, scratch=str(tmp_path / "scratch"))
    assert sorted_rows(got) == expected
    assert scan_metrics(got, "Scan csv", "numFiles") == [1]


def test_splits_have_no_forced_broadcast(spark, conf, tmp_path):
    write_csv(tmp_path / "in.csv", random_rows(random.Random(9), 30))
    conf("spark.sql.files.maxPartitionBytes", "200")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    got = read_extract(spark, str(tmp_path / "in.csv"), split_records=True)
    assert sorted_rows(got) == sorted_rows(read_extract(spark, str(tmp_path / "in.csv")))
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def both_readers(spark, path):
    return [read_extract(spark, path, split_records=split) for split in (False, True)]


@pytest.fixture(params=["ranges", "lines"], autouse=True)
def split_reader(request, monkeypatch):
    """Both ways to read in splits: byte ranges, and lines where Python cannot open the files."""
    if request.param == "lines":
        if not any(name in request.node.name for name in SPLITTING):
            pytest.skip("reads no splits")
        if request.node.callspec.params.get("seed"):
            pytest.skip("one seed will do")
        monkeypatch.setattr("marquee.sources.extracts.reachable", lambda spark, file: False)
    return request.param


SPLITTING = ("split", "line_ends", "header", "short_rows", "irregular", "beyond", "partition_folder", "blank_lines")


def record_texts(data, begin, end, **known):
    item = ranges.Range(0, "f", begin, end, len(data), **known)
    return [value for batch in ranges.cut_records(item, io.BytesIO(data)) for value in batch["value"].to_pylist()]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 4 << 20])
def test_ranges_of_any_size_give_every_record_once(monkeypatch, end, chunk):
    monkeypatch.setattr(ranges, "CHUNK", chunk)
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["id", "first", "second"])
    rows = random_rows(random.Random(chunk), 12)
    writer.writerows([[field.replace("\r", "") for field in row] for row in rows])
    data = out.getvalue().encode()[: -len(end)]
    whole = record_texts(data, 0, len(data), header=True, crlf=end == "\r\n")
    assert len(whole) == 12 and [text.split(",")[0] for text in whole] == [str(k) for k in range(12)]
    for size in (1, 2, 5, 17, 100):
        files = [ranges.Range(0, "f", at, min(at + size, len(data)), len(data)) for at in range(0, len(data), size)]
        surveys = {(0, item.begin): ranges.survey(item, io.BytesIO(data)) for item in files}
        known, irregular = ranges.resolve(files, surveys)
        assert not irregular
        cut = [ranges.cut_records(item, io.BytesIO(data)) for item in known]
        assert [value for batches in cut for batch in batches for value in batch["value"].to_pylist()] == whole


def test_ranges_are_read_in_one_scan_each_and_written_nowhere(spark, conf, tmp_path):
    (tmp_path / "in put,é").mkdir()
    for number in range(2):
        write_csv(tmp_path / "in put,é" / f"{number} %41.csv", random_rows(random.Random(number), 50))
    whole, split = both_readers(spark, str(tmp_path / "in put,é"))
    conf("spark.sql.files.maxPartitionBytes", "300")
    split = read_extract(spark, str(tmp_path / "in put,é"), scratch=str(tmp_path / "scratch"))
    assert sorted_rows(split) == sorted_rows(whole)
    assert not (tmp_path / "scratch").exists()
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "quoted_csv_records" in plan and "Exchange" not in plan and "parquet" not in plan


def test_compressed_files_are_read_whole(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "a.csv.gz", "wt") as out:
        out.write('id,first,second\n1,"a\nb",c\n')
    write_csv(tmp_path / "in" / "b.csv", [["2", "x\ny", "z"]])
    with pytest.warns(UserWarning, match="1 irregular files"):
        got = read_extract(spark, str(tmp_path / "in"))
    assert [tuple(row) for row in sorted_rows(got)] == [("1", "a\nb", "c"), ("2", "x\ny", "z")]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_gzip_files_are_one_range_each(spark, conf, monkeypatch, tmp_path, end):
    (tmp_path / "in").mkdir()
    for number in range(3):
        write_csv(tmp_path / "plain.csv", random_rows(random.Random(number), 60), end)
        with gzip.open(tmp_path / "in" / f"{number}.csv.gz", "wb") as out:
            out.write((tmp_path / "plain.csv").read_bytes())
    with gzip.open(tmp_path / "in" / "empty.csv.gz", "wb"):
        pass
    expected = sorted_rows(read_extract(spark, str(tmp_path / "in"), split_records=False))
    conf("spark.sql.files.maxPartitionBytes", "300")
    with pytest.warns(UserWarning, match="3 irregular files are read in a task per file"):
        got = read_extract(spark, str(tmp_path / "in"))
    assert sorted_rows(got) == expected and len(expected) == 180
    plan = got._jdf.queryExecution().executedPlan().toString()
    if end == "\n":
        assert "quoted_csv_records" in plan and "FileScan csv" not in plan


def test_extracts_of_a_run_are_packed_in_bounded_files(spark, tmp_path):
    from workload.tables import _PACKED_CSV, write_raw_csv

    rows = spark.range(120_000).selectExpr("id", "concat('Order ', id, ',\n\"x\"') as title")
    write_raw_csv(rows.coalesce(1), f"{tmp_path}/in.csv", **_PACKED_CSV)
    files = list((tmp_path / "in.csv").glob("part-*"))
    assert len(files) == 3 and all(file.name.endswith(".gz") for file in files)
    with pytest.warns(UserWarning, match="a task per file"):
        got = read_extract(spark, f"{tmp_path}/in.csv")
    wanted = rows.selectExpr("cast(id as string) id", "title")
    assert got.exceptAll(wanted).isEmpty() and got.count() == 120_000


def test_settings_of_an_object_store_reach_the_tasks(spark):
    conf = spark._jsc.hadoopConfiguration()
    wanted = {"fs.s3a.endpoint": "http://store:9000/", "fs.s3a.access.key": "a", "fs.s3a.secret.key": "b"}
    for name, value in wanted.items():
        conf.set(name, value)
    try:
        assert ranges.store_settings(spark) == {
            "endpoint_override": "store:9000", "scheme": "http", "access_key": "a", "secret_key": "b",
        }
    finally:
        for name in wanted:
            conf.unset(name)
    assert not ranges.reachable(spark, "file:/no/such/file") and not ranges.reachable(spark, "odd://x/y")


def test_partition_folders_give_columns_to_both_readers(spark, conf, tmp_path):
    for year in (1, 2):
        folder = tmp_path / "in" / f"y={year}"
        folder.mkdir(parents=True)
        write_csv(folder / "a.csv", [[str(year), "a\nb", "c"]])
    conf("spark.sql.files.maxPartitionBytes", "9")
    whole, split = both_readers(spark, str(tmp_path / "in"))
    assert split.schema == whole.schema
    assert sorted_rows(split) == sorted_rows(whole)
    assert [tuple(row) for row in sorted_rows(split)] == [("1", "a\nb", "c", 1), ("2", "a\nb", "c", 2)]


def test_a_partition_folder_stands_for_a_column_of_its_name(spark, tmp_path):
    folder = tmp_path / "in" / "second=7"
    folder.mkdir(parents=True)
    write_csv(folder / "a.csv", [["1", "a", "c"]])
    whole, split = both_readers(spark, str(tmp_path / "in"))
    assert split.schema == whole.schema
    assert sorted_rows(split) == sorted_rows(whole)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split_bytes", ["20", "1000"])
def test_blank_lines_before_the_header_are_skipped(spark, conf, tmp_path, end, split_bytes):
    text = end * 5 + f'id,"fir{end}st"{end}1,a{end}{end}2,"b{end}c"{end}'
    (tmp_path / "in.csv").write_bytes(text.encode())
    whole = read_extract(spark, str(tmp_path / "in.csv"))
    expected = sorted_rows(whole)
    conf("spark.sql.files.maxPartitionBytes", split_bytes)
    split = read_extract(spark, str(tmp_path / "in.csv"), split_records=True)
    assert split.columns == whole.columns
    assert sorted_rows(split) == expected and len(expected) == 2


def test_reading_without_multiline_ends_records_at_line_breaks(spark, tmp_path):
    write_csv(tmp_path / "in.csv", [["1", "a\nb", "c"]])
    got = read_extract(spark, str(tmp_path / "in.csv"), multiline=False)
    assert got.count() == 2


def names(df):
    return sorted(row["name"] for row in df.collect())


def test_gate_reports_exactly_the_missing_names(spark, tmp_path):
    wanted = ["a.csv", "b.csv", "c,{d}*.csv", "empty.csv", "folder.csv", "bare.csv"]
    assert names(missing_inputs(spark, str(tmp_path / "absent"), wanted)) == sorted(wanted)
    assert names(missing_inputs(spark, str(tmp_path), wanted)) == sorted(wanted)
    for file in ("a.csv", "c,{d}*.csv", "other.csv", "ab.csv"):
        (tmp_path / file).write_text("x")
    (tmp_path / "empty.csv").touch()
    (tmp_path / "bare.csv").mkdir()
    (tmp_path / "folder.csv" / "day=1").mkdir(parents=True)
    (tmp_path / "folder.csv" / "day=1" / "part-0").write_text("x")
    assert names(missing_inputs(spark, str(tmp_path), wanted)) == ["b.csv", "bare.csv", "empty.csv"]
    with pytest.raises(FileNotFoundError, match=r"\['b.csv', 'bare.csv', 'empty.csv'\]"):
        require_inputs(spark, str(tmp_path), wanted)
    require_inputs(spark, str(tmp_path), ["a.csv", "folder.csv"])


def test_files_in_plain_folders_are_reported(spark, tmp_path):
    (tmp_path / "m.csv" / "sub").mkdir(parents=True)
    (tmp_path / "m.csv" / "sub" / "b").write_text("id\n1\n")
    assert names(missing_inputs(spark, str(tmp_path), ["m.csv"])) == ["m.csv"]
    (tmp_path / "m.csv" / "a").write_text("id\n2\n")
    assert names(missing_inputs(spark, str(tmp_path), ["m.csv"])) == []
    assert read_extract(spark, str(tmp_path / "m.csv")).count() == 1
    with pytest.raises(ValueError, match="sub/b"):
        require_inputs(spark, str(tmp_path), ["m.csv"])


def test_overwrite_replaces_everything(spark, tmp_path):
    root = str(tmp_path)
    write_table(literal_rows(spark, [(1, "x"), (2, "y")], "id int, text string"), root, "t")
    again = literal_rows(spark, [(3,)], "other int")
    for _ in range(2):
        write_table(again, root, "t", rebalance=["other"], overwrite_schema=True)
    assert read_table(spark, root, "t").collect() == again.collect()


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_table_formats(spark, tmp_path, fmt):
    rows = literal_rows(spark, [(1, "x")], "id int, text string")
    write_table(rows, str(tmp_path) + "/", "t", fmt)
    assert [row.asDict() for row in read_table(spark, str(tmp_path), "t", fmt).collect()] == [
        {"id": 1, "text": "x"}
    ]


def test_preview(spark, capfd):
    df = spark.range(50)
    assert [row[0] for row in preview(df, 3, [df["id"].desc()]).collect()] == [49, 48, 47]
    show_preview(preview(df, 3, [df["id"].desc()]), 2)
    printed = capfd.readouterr().out
    assert "49" in printed and "47" not in printed


class Settings(dict):
    def get(self, name, default=None):
        return super().get(name, default)


class FakeSession:
    def __init__(self, **conf):
        self.conf = Settings({name.replace("_", "."): value for name, value in conf.items()})


def test_scratch_follows_the_shared_folder():
    shared = FakeSession(spark_master="yarn")
    shared.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    first, second = (scratch_root(shared, "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/marquee-x-") and first != second


def test_no_local_scratch_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(FakeSession(spark_master="yarn"), "x")
    assert "marquee-x-" in scratch_root(FakeSession(spark_master="local[2]"), "x")


def test_extracts_read_side_by_side_are_not_mixed_up(spark, tmp_path, split_reader):
    if split_reader == "lines":
        pytest.skip("ranges only")
    from concurrent.futures import ThreadPoolExecutor

    for number in range(4):
        write_csv(tmp_path / f"{number}.csv", [[str(number), "a\nb", "c"]] * 20)

    def read(number):
        return {row["id"] for row in read_extract(spark, f"{tmp_path}/{number}.csv").collect()}

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(read, [0, 1, 2, 3] * 2)) == [{str(number)} for number in range(4)] * 2
