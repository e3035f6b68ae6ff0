import random

import pytest
from helpers import NOW, rows

from muster.schemas import EMPLOYEE_FILE_COLUMNS, TABLES, TIMESHEET_FILE_COLUMNS
from muster.sources import landing
from muster.sources.lines import file_headers, records, stored_lines
from muster.sources.locations import export_location, source_location
from muster.sources.tables import Warehouse


def write(folder, name, columns, *lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(["|".join(columns), *lines]) + "\n", encoding="utf-8")


def timesheet_line(columns, **fields):
    return "|".join(fields.get(c.strip().lower(), "") for c in columns)


SHORT = ("client_employee_id", "pay_code", "hours_worked", "punch_in_comment", "source_file")


def test_files_of_different_layouts_map_by_name(spark, tmp_path):
    straight, reverse = TIMESHEET_FILE_COLUMNS, tuple(reversed(TIMESHEET_FILE_COLUMNS))
    noisy = ("extra", *(f" {c.upper()} " for c in straight if c != "pay_code"))
    write(tmp_path, "timesheet_1.csv", straight, timesheet_line(straight, client_employee_id="01", pay_code="A"))
    write(tmp_path, "timesheet_2.csv", reverse, timesheet_line(reverse, client_employee_id="02", pay_code="B"))
    write(tmp_path, "my timesheet+[3] {x}.csv", noisy, timesheet_line(noisy, client_employee_id="03", extra="x"))
    write(tmp_path, "timesheet_4.csv", straight)  # no rows
    write(tmp_path, "employee.csv", straight, timesheet_line(straight, client_employee_id="04"))
    write(tmp_path, "Timesheet_5.csv", straight, timesheet_line(straight, client_employee_id="05"))
    landed = landing.land_timesheets(spark, str(tmp_path), NOW)
    assert landed.schema.names == TABLES["bronze", "raw_timesheet"].names
    assert rows(landed, "client_employee_id", "pay_code", "source_file") == [
        ("01", "A", "timesheet_1.csv"),
        ("02", "B", "timesheet_2.csv"),
        ("03", None, "my timesheet+[3] {x}.csv"),
    ]
    assert [r.loaded_at for r in landed.collect()] == [NOW] * 3
    assert landed.select("id").distinct().count() == 3


def test_nulls_and_quotes(spark, tmp_path):
    columns = TIMESHEET_FILE_COLUMNS
    lines = [
        timesheet_line(columns, client_employee_id='"007"', pay_code='"a|b"', punch_in_comment='"say ""hi"""'),
        timesheet_line(columns, client_employee_id="[NULL]", pay_code="NULL", hours_worked="NA", punch_in_comment='""'),
        timesheet_line(columns, client_employee_id=" NULL ", pay_code=" x ", hours_worked="-", punch_in_comment="é"),
        "",
    ]
    write(tmp_path, "timesheet.csv", columns, *lines)
    landed = landing.land_timesheets(spark, str(tmp_path), NOW)
    assert rows(landed, *SHORT[:4]) == [
        (None, None, None, None),
        (" NULL ", " x ", "-", "é"),
        ("007", "a|b", None, 'say "hi"'),
    ]
    landed = landing.land_timesheets(spark, str(tmp_path), NOW, null_tokens=("-", ""))
    assert rows(landed, *SHORT[:3])[-1] == ("[NULL]", "NULL", "NA")


def test_line_breaks_inside_quotes(spark, tmp_path):
    columns = TIMESHEET_FILE_COLUMNS
    write(tmp_path, "timesheet.csv", columns, timesheet_line(columns, client_employee_id="1", punch_in_comment='"a\n\n|b"'))
    landed = landing.split_timesheets(spark, str(tmp_path), NOW)
    assert rows(landed.rows, "client_employee_id", "punch_in_comment") == [("1", "a\n\n|b")]
    assert rows(landed.malformed) == []


def plain_records(text):
    """Records of a text, character by character.

    A quote that nothing closes opens nothing, nor does one that is open at the end of its line and then
    meets a quote that no separator or line end follows.
    """
    records, start, at = [], 0, 0
    lines_end = {i for i, c in enumerate(text) if c == "\n"}
    while start < len(text):
        at, closed = start, True
        while True:  # a field
            if text[at : at + 1] == '"':
                at, begin = at + 1, at
                while at < len(text):
                    if text[at] != '"':
                        at += 1
                    elif text[at + 1 : at + 2] == '"':
                        at += 2
                    else:
                        break
                closed = at < len(text)
                if closed and "\n" in text[begin:at]:
                    closed = text[at + 1 : at + 2] in ("|", "\n", "")
                at += 1
            while closed and at < len(text) and text[at] not in "|\n":
                at += 1
            if not closed or at >= len(text) or text[at] == "\n":
                break
            at += 1
        if not closed:
            at = min((i for i in lines_end if i >= start), default=len(text))
        records.append(text[start:at])
        start = at + 1
    return [r for r in records if r.strip(" ")]


@pytest.mark.parametrize("seed", range(3))
def test_records_of_random_files(spark, settings, tmp_path, seed):
    """Any mix of quotes, breaks and blank lines, cut into splits at any place."""
    draw = random.Random(seed)
    size = str([60, 150, 5000][seed])
    settings(files__maxPartitionBytes=size, files__openCostInBytes="0", files__minPartitionNum="1")
    expected = []
    for n in range(4):
        pieces = ["a", "b c", "|", "|", "\n", "\n", '""', '"', "é", " ", "\uffff", '|"x\ny\n\nz"|', '"p""q|\n"\n', "h|i\n"]
        body = "".join(draw.choices(pieces, k=draw.randint(0, 120)))
        if n % 2:
            body = body.replace('"', "", 1) if body.count('"') % 2 else body
        (tmp_path / f"timesheet_{n}.csv").write_text("\n \nh|i\n" + body, encoding="utf-8", newline="")
        expected += [(f"timesheet_{n}.csv", r) for r in plain_records(body)]
    lines = stored_lines(spark, str(tmp_path), "*timesheet*.csv", False)
    found = records(lines, file_headers(lines))
    assert rows(found, "file", "line") == sorted(expected)


def test_long_record_is_a_broken_quote(spark, tmp_path):
    body = 'h|i\n1|"a\nb\nc"\n2|"d\ne"\n3|"f\ng\nh\ni"\n4|j\n'
    (tmp_path / "timesheet.csv").write_text(body)
    lines = stored_lines(spark, str(tmp_path), "*timesheet*.csv", False)
    found = records(lines, file_headers(lines), max_lines=3)
    assert rows(found, "line") == [(x,) for x in ('1|"a\nb\nc"', '2|"d\ne"', '3|"f', "4|j", "g", "h", 'i"')]


def test_repeated_header_lines_are_rows(spark, tmp_path):
    columns = ("client_employee_id", "pay_code")
    write(tmp_path, "timesheet.csv", columns, "1|A", "|".join(columns), "2|B", "|".join(columns))
    landed = landing.land_timesheets(spark, str(tmp_path), NOW)
    assert rows(landed, *columns) == [("1", "A"), ("2", "B"), columns, columns]


def test_any_character_is_kept(spark, tmp_path):
    columns = ("client_employee_id", "pay_code", "hours_worked")
    write(tmp_path, "timesheet.csv", columns, "5|A\uffffB|8", "6|A\u0001\u2028B|8", "7|\u0001\u0003\uffff|")
    landed = landing.land_timesheets(spark, str(tmp_path), NOW)
    assert rows(landed, *columns) == [("5", "A\uffffB", "8"), ("6", "A\u0001\u2028B", "8"),
        ("7", "\u0001\u0003\uffff", None),
    ]


def test_broken_records_of_a_large_file_are_the_work_of_many_tasks(spark, settings, tmp_path):
    settings(files__maxPartitionBytes="30000", files__openCostInBytes="0")
    columns = ("client_employee_id", "pay_code", "punch_in_comment")
    body = [f'{n}|A|"two\nlines of {n}"' if n % 3 else f"{n}|A|one" for n in range(6000)]
    write(tmp_path, "timesheet.csv", columns, *body)
    lines = stored_lines(spark, str(tmp_path), "*timesheet*.csv", False)
    assert lines.select("block").distinct().count() > 5
    landed = landing.split_timesheets(spark, str(tmp_path), NOW)
    found = rows(landed.rows, "client_employee_id", "punch_in_comment")
    assert found == sorted((str(n), f"two\nlines of {n}" if n % 3 else "one") for n in range(6000))
    assert landed.malformed.isEmpty()


def test_lookup_below_a_prefix_in_any_case(spark, tmp_path):
    columns = TIMESHEET_FILE_COLUMNS
    write(tmp_path, "a/b/TimeSheet.CSV", columns, timesheet_line(columns, client_employee_id="1"))
    write(tmp_path, "a/timesheet.csv.bak", columns, timesheet_line(columns, client_employee_id="2"))
    write(tmp_path, "a/timesheet_9.csv", columns, timesheet_line(columns, client_employee_id="3"))
    assert rows(landing.land_timesheets(spark, str(tmp_path), NOW)) == []
    deep = landing.land_timesheets(spark, str(tmp_path), NOW, recursive=True, ignore_case=True)
    assert rows(deep, "client_employee_id", "source_file") == [("1", "TimeSheet.CSV"), ("3", "timesheet_9.csv")]


def test_no_file_gives_an_empty_table(spark, tmp_path):
    for path in (tmp_path, tmp_path / "missing"):
        landed = landing.land_employees(spark, str(path), NOW)
        assert rows(landed) == []
        assert landed.schema.names == TABLES["bronze", "raw_employee"].names


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    columns = ("client_employee_id", "pay_code", "hours_worked")
    lines = [
        "1|A|8",
        "2|A|8|more",  # too many fields
        "3|A",  # the last field is missing
        '4|"a|b"|8',
        '5|"a|b"|8|"x|y"',  # too many fields
        '6|A|"two',  # a record in two lines
        'lines"',
        '7|5" pipe|8',
        '8|"say ""hi|""|"|8',
        '"9|A|8',  # opens and never closes
        "10|A|" + "x" * 200_000,
    ]
    write(tmp_path, "timesheet_1.csv", columns, *lines)
    write(tmp_path, "timesheet_2.csv", (*columns, "extra"), "11|A|8|fits", "12|A|8|does|not")
    landed = landing.split_timesheets(spark, str(tmp_path), NOW)
    assert rows(landed.rows, "client_employee_id", "pay_code") == [
        ("1", "A"), ("10", "A"), ("11", "A"), ("3", "A"), ("4", "a|b"), ("6", "A"), ("7", '5" pipe'),
        ("8", 'say "hi|"|'),
    ]
    assert rows(landed.malformed, "source_file", "text", "reason") == [
        ("timesheet_1.csv", '"9|A|8', "BROKEN_QUOTE"),
        ("timesheet_1.csv", "2|A|8|more", "TOO_MANY_FIELDS"),
        ("timesheet_1.csv", '5|"a|b"|8|"x|y"', "TOO_MANY_FIELDS"),
        ("timesheet_2.csv", "12|A|8|does|not", "TOO_MANY_FIELDS"),
    ]
    assert landed.malformed.schema == TABLES["bronze", "malformed_line"]


def test_malformed_records_with_line_breaks(spark, tmp_path):
    columns = ("client_employee_id", "pay_code", "punch_in_comment")
    write(tmp_path, "timesheet.csv", columns, '1|A|"two\nlines"', "2|A|x|more", "3|A")
    write(tmp_path, "timesheet_2.csv", tuple(reversed(columns)), '"x\ny"|B|4')
    landed = landing.split_timesheets(spark, str(tmp_path), NOW)
    assert rows(landed.rows, "client_employee_id", "pay_code", "punch_in_comment") == [
        ("1", "A", "two\nlines"), ("3", "A", None), ("4", "B", "x\ny"),
    ]
    assert rows(landed.malformed, "text", "reason") == [("2|A|x|more", "TOO_MANY_FIELDS")]


def test_headers_of_split_files(spark, settings, tmp_path):
    """A file of many splits gives one header, and it is not a row."""
    settings(files__maxPartitionBytes="2000", files__openCostInBytes="0")
    columns = TIMESHEET_FILE_COLUMNS
    lines = [timesheet_line(columns, client_employee_id=str(n)) for n in range(500)]
    write(tmp_path, "timesheet.csv", columns, *lines)
    (tmp_path / "timesheet_2.csv").write_text("\n  \n" + "|".join(columns) + "\n")
    headers = file_headers(stored_lines(spark, str(tmp_path), "*timesheet*.csv", False))
    assert {r.header for r in headers.collect()} == {"|".join(columns)}
    assert headers.count() == 2
    landed = landing.land_timesheets(spark, str(tmp_path), NOW)
    assert rows(landed, "client_employee_id") == sorted((str(n),) for n in range(500))


def test_landing_runs_in_the_engine_and_parses_a_line_once(spark, tmp_path):
    columns = ("client_employee_id", "pay_code", "hours_worked")
    write(tmp_path, "timesheet_1.csv", columns, "1|A|8")
    write(tmp_path, "timesheet_2.csv", tuple(reversed(columns)), "8|A|2")
    landed = landing.split_timesheets(spark, str(tmp_path), NOW)
    for df in (landed.rows, landed.malformed):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "MapInArrow" not in text
        assert text.count("from_csv(") <= 1


def test_header_names():
    assert landing.header_names('\ufeff" A "|b|"c|d"') == ("a", "b", "c|d")


def test_landing_again_replaces_the_table(spark, tmp_path):
    write(tmp_path, "employee_1.csv", EMPLOYEE_FILE_COLUMNS, "|".join(["1"] * 34), "|".join(["2"] * 34))
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    for _ in range(2):
        landed = landing.land_employees(spark, str(tmp_path), NOW)
        assert warehouse.write("bronze", "raw_employee", landed) == 2
        assert warehouse.read("bronze", "raw_employee").count() == 2


STORE = {
    "DATA_SOURCE": " MinIO ",
    "RAW_DATA_PATH": "/raw/",
    "MINIO_ENDPOINT": "http://store:9000",
    "MINIO_ACCESS_KEY": "k",
    "MINIO_SECRET_KEY": "s",
    "MINIO_BUCKET": "hr",
    "MINIO_SECURE": "Yes",
}


def test_source_location():
    local = source_location({})
    assert (local.path, local.recursive, local.ignore_case) == ("data/raw", False, False)
    store = source_location(STORE)
    assert (store.path, store.recursive, store.ignore_case) == ("s3a://hr/raw", True, True)
    assert store.storage["fs.s3a.connection.ssl.enabled"] == "true"
    with pytest.raises(ValueError, match="ftp"):
        source_location({"DATA_SOURCE": "ftp"})
    with pytest.raises(ValueError, match="MINIO_ACCESS_KEY, MINIO_BUCKET"):
        source_location({**STORE, "MINIO_ACCESS_KEY": " ", "MINIO_BUCKET": ""})


def test_export_location():
    assert export_location(STORE).path == "s3a://hr/"
    assert export_location({**STORE, "MINIO_SECRET_KEY": ""}) is None
