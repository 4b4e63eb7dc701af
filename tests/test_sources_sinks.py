import gzip
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from opsframe.sinks import (
    append_rows,
    export_query,
    grid_update,
    json_line,
    updated_range,
    write_json_gzip,
    write_json_lines,
)
from opsframe.sources import (
    check_pages,
    column_index,
    column_letters,
    grid_range,
    grid_range_frame,
    jdbc_options,
    list_files,
    missing_pages,
    next_token,
    parse_range,
    read_files_binary,
    read_json_document,
    read_json_lines,
    read_pages,
    read_report_csv,
    run_sql,
    table_info,
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_gzip_document(spark, tmp_path):
    with gzip.open(tmp_path / "d.json.gz", "wt") as out:
        json.dump([{"a": 1}, {"a": 2, "b": "x"}], out)
    df = read_json_document(spark, str(tmp_path), "a int, b string", 4)
    assert rows(df) == [(1, None), (2, "x")]
    (tmp_path / "bad.json").write_text('[{"a": 1}')
    with pytest.raises(Exception):
        read_json_document(spark, str(tmp_path), "a int, b string").collect()


def report_files(root):
    for app, kind, day in (
        ("one", "installs_report", "2024-01-01 10:00:00"),
        ("one", "in_app_events_report", "2024-01-01 11:00:00"),
        ("two", "installs_report", "2024-01-02 23:59:59.999999"),
        ("two", "installs_report", "2024-01-03 00:00:00"),
    ):
        folder = root / f"app_id={app}" / f"report_type={kind}"
        folder.mkdir(parents=True, exist_ok=True)
        name = day.replace(" ", "_").replace(":", "")
        (folder / f"{name}.csv").write_text(
            f'Event Time,Media Source\n{day},"say ""hi"", then; go"\n'
        )


def test_reports(spark, tmp_path, plan_of):
    report_files(tmp_path)
    schema = "`Event Time` timestamp_ntz, `Media Source` string"
    df = read_report_csv(
        spark,
        str(tmp_path),
        "installs_report",
        start=date(2024, 1, 1),
        end=date(2024, 1, 2),
        schema=schema,
    )
    assert df.columns == ["event_time", "media_source", "app_id", "report_type"]
    assert [r.app_id for r in df.orderBy("event_time").collect()] == ["one", "two"]
    assert df.first().media_source == 'say "hi", then; go'
    one = read_report_csv(
        spark, str(tmp_path), "installs_report", "one", schema=schema
    )
    assert one.count() == 1
    filters = plan_of(one)
    assert "PartitionFilters: [isnotnull(app_id" in filters


def test_reports_of_types_with_different_headers(spark, tmp_path):
    def file(app, kind, text):
        folder = tmp_path / f"app_id={app}" / f"report_type={kind}"
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text(text)

    file("007", "installs_report", "Event Time,Campaign\n2024-01-01 10:00:00,spring\n")
    file("08", "installs_report", 'Event Time,Campaign\n2024-01-02 10:00:00,"two\nlines"\n')
    file("com.shop", "in_app_events_report", "Event Time,Event Name,N\n2024-01-01 11:00:00,buy,5\n")
    root = str(tmp_path)
    for schema in (None, "`Event Time` timestamp, `Campaign` string"):
        installs = read_report_csv(
            spark, root, "installs_report", schema=schema, quoted_newlines=True
        )
        assert installs.columns == ["event_time", "campaign", "app_id", "report_type"]
        found = [(r.app_id, r.campaign) for r in installs.orderBy("app_id").collect()]
        assert found == [("007", "spring"), ("08", "two\nlines")]
    events = read_report_csv(spark, root, "in_app_events_report")
    assert [(r.event_name, r.n, r.app_id) for r in events.collect()] == [
        ("buy", 5, "com.shop")
    ]
    one = read_report_csv(spark, root, "installs_report", "007")
    assert [r.campaign for r in one.collect()] == ["spring"]
    inferred = read_report_csv(spark, str(tmp_path), "in_app_events_report")
    assert inferred.first().event_time == datetime(2024, 1, 1, 11)
    with pytest.raises(ValueError):
        read_report_csv(spark, str(tmp_path), "uninstalls")


def test_report_with_another_header_fails(spark, tmp_path):
    report_files(tmp_path)
    df = read_report_csv(
        spark,
        str(tmp_path),
        "installs_report",
        schema="`Event Time` timestamp_ntz, `Campaign` string",
    )
    with pytest.raises(Exception):
        df.collect()


PAGES = {
    "list_offset": (
        {"lists": [{"id": 1}], "has-more": True, "offset": 10},
        {"lists": [{"id": 2}], "has-more": False, "offset": 20},
        "10",
    ),
    "contact_offset": (
        {"contacts": [{"id": 1}], "has-more": True, "vid-offset": 7},
        {"contacts": [{"id": 2}], "has-more": False, "vid-offset": 9},
        "7",
    ),
    "after": (
        {"results": [{"id": 1}], "paging": {"next": {"after": "5"}}},
        {"results": [{"id": 2}]},
        "5",
    ),
    "link": (
        {"results": [{"id": 1}], "paging": {"next": {"link": "u/2"}}},
        {"results": [{"id": 2}]},
        "u/2",
    ),
    "next_uri": (
        {"messages": [{"id": 1}], "next_page_uri": "/p2"},
        {"messages": [{"id": 2}], "next_page_uri": None},
        "/p2",
    ),
    "token": (
        {"connections": [{"id": 1}], "nextPageToken": "t"},
        {"connections": [{"id": 2}]},
        "t",
    ),
}


@pytest.mark.parametrize("style", PAGES)
def test_page_styles(spark, style):
    first, last, token = PAGES[style]
    landed = spark.createDataFrame(
        [("s", None, json.dumps(first)), ("s", token, json.dumps(last))],
        "source string, token string, payload string",
    )
    assert rows(read_pages(landed, style, "id int")) == [(0, 1), (0, 2)]
    assert missing_pages(landed, style).count() == 0
    assert check_pages(landed, style) is landed
    gap = landed.filter("token IS NULL")
    assert rows(missing_pages(gap, style)) == [("s", token)]
    with pytest.raises(RuntimeError):
        check_pages(gap, style)
    tokens = landed.select(next_token("payload", style).alias("n"))
    assert {r.n for r in tokens.collect()} == {token, None}


def test_page_without_items_gives_no_rows(spark):
    landed = spark.createDataFrame([('{"x":1}',), ('{"results":[]}',)], "payload string")
    assert read_pages(landed, "after", "id int").count() == 0


def test_sql_parameters_and_views(spark):
    views = {"numbers": spark.range(10)}
    text = "SELECT count(*) AS n FROM numbers WHERE id >= :low"
    assert run_sql(spark, text, {"low": 7}, views).first().n == 3
    assert run_sql(spark, "SELECT ? + 1 AS x", [41]).first().x == 42


def test_jdbc_options():
    assert jdbc_options("jdbc:x", query="SELECT 1") == {
        "url": "jdbc:x",
        "query": "SELECT 1",
    }
    assert jdbc_options(
        "jdbc:x",
        query="SELECT 1 AS id",
        partition_column="id",
        bounds=(0, 100),
        partitions=4,
        properties={"user": "u"},
    ) == {
        "url": "jdbc:x",
        "user": "u",
        "dbtable": "(SELECT 1 AS id) AS source_query",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", dbtable="t", partition_column="id")


def test_files(spark, tmp_path, plan_of):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_bytes(b"\x00\xff")
    (tmp_path / "sub" / "b.txt").write_text("bb")
    (tmp_path / "c.bin").write_text("c")
    listed = list_files(spark, str(tmp_path))
    assert sorted(r.path.rsplit("/", 1)[1] for r in listed.collect()) == [
        "a.txt",
        "b.txt",
        "c.bin",
    ]
    assert "content" not in plan_of(listed)
    assert list_files(spark, str(tmp_path), "*.txt", recursive=False).count() == 1
    contents = read_files_binary(spark, str(tmp_path), "a.txt")
    assert bytes(contents.first().content) == b"\x00\xff"
    with pytest.raises(Exception):
        read_files_binary(spark, str(tmp_path / "none")).collect()


def test_column_letters():
    assert [column_index(x) for x in ("A", "Z", "AA", "BA", "ZZ", "AAA")] == [
        0,
        25,
        26,
        52,
        701,
        702,
    ]
    assert all(column_index(column_letters(i)) == i for i in range(20000))
    with pytest.raises(ValueError):
        column_index("1")


def test_ranges():
    assert parse_range("My!Sheet!B3:D5") == ("My!Sheet", 1, 3, 3, 5)
    assert parse_range("S!B3") == ("S", 1, 3, 1, 3)
    assert parse_range("S!A:C") == ("S", 0, 1, 2, None)
    assert parse_range("Sheet1") == ("Sheet1", 0, 1, None, None)
    with pytest.raises(ValueError):
        parse_range("S!?")
    assert updated_range("S!B3", 3, 2) == "S!B3:D4"
    assert updated_range("S!Z1", 2, 1) == "S!Z1:AA1"


@pytest.fixture(scope="module")
def grid(spark):
    cells = [["a", "b", "1", "2"], ["4", "5"], ["6", "7", "8", "9"], []]
    return spark.createDataFrame(
        list(enumerate(cells, start=1)), "row_idx int, cells array<string>"
    )


def test_grid_range(grid):
    def cut(text):
        got = grid_range(grid, text).orderBy("row_idx")
        return [r.cells for r in got.collect()]

    assert cut("S!A1:D2") == [["a", "b", "1", "2"], ["4", "5"]]
    assert cut("S!B2:C3") == [["5"], ["7", "8"]]
    assert cut("S") == [["a", "b", "1", "2"], ["4", "5"], ["6", "7", "8", "9"], []]


def test_grid_header(grid):
    df = grid_range_frame(grid, "S!A1:C3", keep_index=True).orderBy("row_idx")
    assert df.columns == ["row_idx", "a", "b", "1"]
    assert [tuple(r)[1:] for r in df.collect()] == [("4", "5", None), ("6", "7", "8")]
    lower = grid_range_frame(grid, "S!A1:B3", header_row=1)
    assert lower.columns == ["4", "5"] and rows(lower) == [("6", "7")]
    with pytest.raises(ValueError, match="no data"):
        grid_range_frame(grid, "S!A9:B12")
    with pytest.raises(Exception, match="longer than the header"):
        grid_range_frame(grid, "S", header_row=1).collect()


def test_grid_update(spark, grid):
    df = spark.createDataFrame(
        [(2, "y", None), (1, "x", 10), (3, "z", 30)], "k int, s string, n int"
    )
    got = grid_update(grid, "S!B3", df, "k").orderBy("row_idx").collect()
    assert [(r.row_idx, r.cells) for r in got] == [
        (1, ["a", "b", "1", "2"]),
        (2, ["4", "5"]),
        (3, ["6", "1", "x", "10"]),
        (4, [None, "2", "y", None]),
        (5, [None, "3", "z", "30"]),
    ]
    with pytest.raises(ValueError, match="!"):
        grid_update(grid, "B3", df, "k")


def test_table_info(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert rows(table_info(spark, "three")) == [("id", "bigint", False, 1)]
    assert rows(table_info(spark, "three", count_rows=True)) == [
        ("id", "bigint", False, 1, 3)
    ]
    assert table_info(spark, "nowhere", count_rows=True).count() == 0


def test_append_to_a_table(spark):
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    append_rows(df, "appended")
    append_rows(df.filter("false"), "appended")
    append_rows(df, "appended")
    assert rows(spark.table("appended")) == [(1, "a"), (1, "a")]
    with pytest.raises(Exception):
        append_rows(spark.createDataFrame([("x", "a")], "id string, s string"), "appended")
    assert spark.table("appended").count() == 2


def test_export_is_sorted_and_overwrites(spark, tmp_path):
    df = spark.createDataFrame(
        [(3, 'q"; x'), (1, "é"), (2, None)], "id int, s string"
    )
    path = str(tmp_path / "out")
    for _ in range(2):
        export_query(spark, "SELECT * FROM t", path, views={"t": df})
    written = spark.read.csv(
        path, "id int, s string", sep=";", header=True, escape='"'
    )
    assert rows(written) == [(1, "é"), (2, None), (3, 'q"; x')]
    export_query(
        spark,
        "SELECT * FROM t ORDER BY id DESC LIMIT 2",
        path,
        fmt="JSON",
        views={"t": df},
    )
    files = sorted((tmp_path / "out").glob("*.json"))
    lines = [x for f in files for x in f.read_text().splitlines()]
    assert [json.loads(x)["id"] for x in lines] == [2, 3]
    with pytest.raises(ValueError):
        export_query(spark, "SELECT 1", path, fmt="PARQUET")


def test_lines_skip_empty_rows_and_append(spark, tmp_path):
    at = datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame(
        [("b", None, at), (None, None, None), (None, "d", None)],
        "a string, c string, at timestamp_ntz",
    )
    assert [r.value for r in json_line(df.drop("at")).collect()] == [
        '{"a":"b"}',
        '{"c":"d"}',
    ]
    assert json_line(df, keep_nulls=True).count() == 3
    path = str(tmp_path / "lines")
    write_json_lines(df, path)
    write_json_lines(df, path)
    assert rows(read_json_lines(spark, path, df.schema)) == sorted(
        [("b", None, at), (None, "d", None)] * 2, key=str
    )


def test_gzip_lines(spark, tmp_path):
    path = tmp_path / "gz"
    write_json_gzip(spark.range(3), str(path))
    texts = [gzip.open(f, "rt").read() for f in path.glob("*.gz")]
    ids = sorted(json.loads(x)["id"] for t in texts for x in t.splitlines())
    assert ids == [0, 1, 2]


def test_reports_with_an_open_end_keep_sentinel_dates(spark, tmp_path):
    folder = tmp_path / "app_id=one" / "report_type=installs_report"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(
        "Event Time,Media Source\n2024-01-01 10:00:00,a\n"
        "9999-12-31 23:59:59,never\n2023-12-31 23:59:59,before\n"
    )
    schema = "`Event Time` timestamp_ntz, `Media Source` string"

    def sources(**bounds):
        df = read_report_csv(
            spark, str(tmp_path), "installs_report", schema=schema, **bounds
        )
        return sorted(r.media_source for r in df.collect())

    assert sources(start=date(2024, 1, 1)) == ["a", "never"]
    assert sources(start=date(2024, 1, 1), end=date.max) == ["a", "never"]
    assert sources(end=date(2024, 1, 1)) == ["a", "before"]
    assert sources() == ["a", "before", "never"]
