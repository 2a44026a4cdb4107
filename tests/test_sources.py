import datetime as dt
import gzip
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tableworks.catalog.sources import quote_lines
from tableworks.sources import archives, delimited, events_json, fixed_width, tables

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(row) for row in df.collect())


# --- fixed width ------------------------------------------------------------------------


def quote_line(company="Ação", ticker="ABCD3", quantity="000000000000001500", day="20240105"):
    line = [" "] * 245
    for name, start, end, kind in fixed_width.QUOTE_LAYOUT:
        text = {"TEXT": " ", "INT": "0", "PRICE": "0", "DATE": "20240105"}[kind.name]
        line[start - 1 : end] = text.rjust(end - start + 1, "0" if kind != "text" else " ")
    def put(name, value):
        start, end = next((s, e) for n, s, e, _ in fixed_width.QUOTE_LAYOUT if n == name)
        line[start - 1 : end] = value.ljust(end - start + 1)
    line[0:2] = "01"
    put("trade_date", day)
    put("company_name", company)
    put("ticker", ticker)
    put("close_price", "0000000001234")
    put("total_quantity", quantity)
    put("specification", "ON\x01NM\xa0")
    return "".join(line)


def write_quotes(path, *lines):
    text = "\n".join(["00COTAHIST", *lines, "99TRAILER"]) + "\n"
    path.write_bytes(text.encode("latin-1"))
    return str(path)


def test_fixed_width_from_latin1_file(spark, tmp_path):
    path = write_quotes(tmp_path / "quotes.txt", quote_line(), quote_line(ticker="WXYZ4"))
    parsed = fixed_width.parse_fixed_width(fixed_width.scan_lines(spark, path))
    assert [row["ticker"] for row in parsed.orderBy("ticker").collect()] == ["ABCD3", "WXYZ4"]
    row = parsed.first()
    assert row["company_name"] == "Ação" and row["specification"] == "ON NM"
    assert row["close_price"] == 12.34 and row["total_quantity"] == 1500
    assert row["trade_date"] == dt.date(2024, 1, 5)
    assert len(parsed.columns) == 25
    types = dict(parsed.dtypes)
    assert types["strike_points"] == "bigint" and types["total_volume"] == "double"


def test_fixed_width_is_strict_unless_told_otherwise(spark, tmp_path):
    bad = quote_line(quantity="00000000000000x500", day="20241305")
    lines = fixed_width.scan_lines(spark, write_quotes(tmp_path / "bad.txt", bad))
    with pytest.raises(Exception):
        fixed_width.parse_fixed_width(lines).collect()
    row = fixed_width.parse_fixed_width(lines, strict=False).first()
    assert row["total_quantity"] is None and row["trade_date"] is None
    assert row["close_price"] == 12.34


def test_fixed_width_lines_have_the_declared_length(spark):
    lengths = quote_lines(spark, SMALL).where(F.substring(F.decode("value", "ISO-8859-1"), 1, 2) == "01")
    assert [r[0] for r in lengths.select(F.length("value")).distinct().collect()] == [245]


# --- delimited --------------------------------------------------------------------------


def test_unquoted_text(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text('a\tb\tc\n1\t\\N\t"x\n\n2\t\t a\\"b \n', encoding="utf-8")
    table = delimited.parse_delimited_strings(spark, str(path), "\t")
    assert {kind for _, kind in table.dtypes} == {"string"}
    assert rows(table) == [("1", "\\N", '"x'), ("2", "", ' a\\"b ')]


def test_quoted_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a;b\n"x;y";"say ""hi"""\n;"C:\\"\n', encoding="utf-8")
    table = delimited.parse_delimited_strings(spark, str(path), ";", '"')
    assert rows(table) == [("", "C:\\"), ("x;y", 'say "hi"')]


def test_latin1_text(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_bytes("a|b\nAção|é\n".encode("latin-1"))
    table = delimited.parse_delimited_strings(spark, str(path), "|", encoding="ISO-8859-1")
    assert rows(table) == [("Ação", "é")]


@pytest.mark.parametrize("line", ["1|2|3", "1"])
def test_ragged_rows_fail(spark, tmp_path, line):
    path = tmp_path / "t.txt"
    path.write_text(f"a|b\n{line}\n")
    with pytest.raises(Exception):
        delimited.parse_delimited_strings(spark, str(path), "|").select("a").collect()


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "1.txt").write_text("a|b\n1|2\n")
    (tmp_path / "2.txt").write_text("b|a\n3|4\n")
    with gzip.open(tmp_path / "3.txt.gz", "wt") as stream:
        stream.write("b|c|a\n5||6\n")
    table = delimited.parse_delimited_strings(spark, str(tmp_path), "|").select("a", "b", "c")
    assert set(map(tuple, table.collect())) == {("1", "2", None), ("4", "3", None), ("6", "5", "")}


def test_gzip_text(spark, tmp_path):
    for part in range(3):
        with gzip.open(tmp_path / f"p{part}.tsv.gz", "wt") as stream:
            stream.write(f"a\tb\n{part}\tx\n")
    table = delimited.scan_gzip_text(spark, str(tmp_path), partitions=4)
    assert rows(table) == [("0", "x"), ("1", "x"), ("2", "x")]


# --- archives ---------------------------------------------------------------------------


def zipped(members):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as bundle:
        for name, content in members.items():
            bundle.writestr(name, content)
    return packed.getvalue()


@pytest.mark.parametrize("mounted", [False, True])
def test_zip_text(spark, tmp_path, monkeypatch, mounted):
    for number in range(3):
        content = "a;b\r\n" + "".join(f"{number};{n}\r\n" for n in range(50)) + "\r\nlast;é"
        archive = zipped({"first.csv": content.encode(), "second.csv": b"a;b\n9;9\n"})
        (tmp_path / f"z{number}.zip").write_bytes(archive)
    lines = archives.scan_zip_text(spark, str(tmp_path), mounted=mounted)
    table = delimited.parse_lines(lines.where("line_no > 0"), ["a", "b"], ";", '"')
    assert table.count() == 3 * 51
    assert table.where("a = 'last'").select("b").distinct().collect()[0][0] == "é"
    assert lines.where("line_no = 0").select("line").distinct().collect()[0][0] == "a;b"


def test_blocks_join_lines_that_cross_them(monkeypatch):
    monkeypatch.setattr(archives, "BLOCK", 5)
    blocks = list(archives._text_blocks(io.BytesIO("ab\ncdefghij\n\nké\nz".encode()), "utf-8"))
    assert [line for block in blocks for line in block] == ["ab", "cdefghij", "ké", "z"]


@pytest.mark.parametrize("mounted", [False, True])
def test_nested_zip(spark, tmp_path, mounted):
    inner = zipped({"data.txt": "a|b\n1|\n".encode("latin-1")})
    members = {
        "pricing file PPUF_2025Q1.zip": inner, "sample pricing file PPUF.zip": inner,
        "pharmacy networks file PPUF_2025Q1 part 3.zip": inner, "readme.txt": b"text",
    }
    (tmp_path / "2025Q1.zip").write_bytes(zipped(members))
    lines = archives.scan_zip_text(
        spark, str(tmp_path), nested=True, encoding="latin-1", mounted=mounted
    ).withColumn("route", archives.route_member(F.col("member"), F.lit("Q")))
    body = lines.where("line_no > 0 and route is not null")
    assert rows(delimited.parse_lines(body, ["a", "b"], "|", keep=["route"])) == [
        ("pharmacy_networks/Q_part3.parquet", "1", ""), ("pricing/Q.parquet", "1", ""),
    ]


def test_skipped_members_stay_packed(spark, tmp_path):
    inner = zipped({"data.txt": b"a|b\n1|2\n"})
    members = {"pricing file PPUF_2025Q1.zip": inner, "sample pricing file PPUF.zip": b"no archive",
               "plan file PPUF_2025Q1.zip": inner, "other.zip": b"no archive"}
    (tmp_path / "q.zip").write_bytes(zipped(members))
    lines = archives.scan_zip_text(spark, str(tmp_path), nested=True, tables=["plan"])
    assert lines.select("member", "header").distinct().collect() == [("plan file PPUF_2025Q1.zip", "a|b")]
    heads = archives.scan_zip_text(spark, str(tmp_path), nested=True, tables=[], headers_only=True)
    assert heads.count() == 2


def test_digits_are_digits_when_strict(spark):
    line = spark.createDataFrame([("01" + " 12",)], "value string")
    layout = [("n", 3, 5, fixed_width.Field.INT)]
    with pytest.raises(Exception, match="not a whole number"):
        fixed_width.parse_fixed_width(line, layout).collect()
    assert fixed_width.parse_fixed_width(line, layout, strict=False).first()[0] == 12


@pytest.mark.parametrize("read", [fixed_width.parse_fixed_width, fixed_width.read_fixed_width])
def test_text_lines_are_encoded_once(spark, read):
    """Not once for each field; and text reads as its bytes do, blanks of every kind trimmed."""
    company = "\t\xa0A\x01\xe7\xa0 \x85  "
    lines = [(f"01{company:12s}{n:05d}{7 * n:05d}",) for n in range(50)] + [("99",), (None,)]
    text = spark.createDataFrame(lines, "value string")
    layout = [
        ("company", 3, 14, fixed_width.Field.TEXT), ("n", 15, 19, fixed_width.Field.INT),
        ("m", 20, 24, fixed_width.Field.PRICE),
    ]
    parsed = read(text, layout)
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("encode(") == 1
    names = [name for name, *_ in layout]
    found = rows(parsed.select(*names))
    assert found == [("A \xe7", n, 7 * n / 100) for n in range(50)]
    binary = text.select(F.encode("value", fixed_width.ENCODING).alias("value"))
    assert rows(read(binary, layout).select(*names)) == found


def test_routes(spark):
    cases = {
        "pricing file PPUF_2025Q1.zip": "pricing/Q.parquet",
        "pharmacy networks file PPUF_2025Q1 part 3.zip": "pharmacy_networks/Q_part3.parquet",
        "sample pricing file PPUF.zip": None,
        "readme.txt": None,
    }
    names = spark.createDataFrame([(name,) for name in cases], "member string")
    routed = names.withColumn("route", archives.route_member(F.col("member"), F.lit("Q")))
    assert {row["member"]: row["route"] for row in routed.collect()} == cases


# --- JSON -------------------------------------------------------------------------------

EVENT = '{"isinCode":"I","label":"L","factor":"1.234,56","lastDatePrior":"%s","approvedOn":"01/02/2003"}'


def test_event_documents(spark):
    first = '{"x":1,"stockDividends":[%s,%s]}' % (EVENT % "31/01/2003", EVENT % "")
    documents = [
        ("object", first), ("list", f'[{first},{{"stockDividends":[{EVENT % "02/02/2002"}]}}]'),
        ("empty", "[]"), ("null", '{"stockDividends":null}'), ("missing", "{}"),
    ]
    df = spark.createDataFrame(documents, "company string, document string")
    events = events_json.flatten_event_json(df, "document", "company")
    expected = [
        (company, "I", "L", 1234.56, day, dt.date(2003, 2, 1))
        for company in ("list", "object")
        for day in (dt.date(2003, 1, 31), None)
    ]
    assert sorted(map(tuple, events.collect()), key=repr) == sorted(expected, key=repr)


def test_listed_companies(spark):
    companies = [("A", None, "01/01/2000"), ("B", "", "01/01/2000"), ("C", "DRN", "01/01/2000"),
                 ("D", None, "31/12/9999"), ("E", "", None)]
    df = spark.createDataFrame(companies, "code string, typeBDR string, dateListing string")
    kept = events_json.filter_listed_companies(df).select("code")
    assert rows(kept) == [("A",), ("B",), ("E",)]


# --- stored tables ----------------------------------------------------------------------


def test_half_written_folder_is_no_table(spark, tmp_path):
    target = tmp_path / "t"
    target.mkdir()
    (target / "part-0.parquet").write_bytes(b"broken")
    assert not tables.table_exists(spark, str(target))
    df = spark.createDataFrame([(1, dt.date(2020, 5, 1))], "a int, trade_date date")
    back = tables.sink_if_absent(df, str(target), ["year"], tables.year_of("trade_date"))
    assert back is df
    assert tables.table_exists(spark, str(target))
    assert spark.read.parquet(str(target)).columns == ["a", "trade_date", "year"]


def test_delta_marker(spark, tmp_path):
    (tmp_path / "_delta_log").mkdir()
    assert tables.table_exists(spark, str(tmp_path), "delta")
    assert not tables.table_exists(spark, str(tmp_path))


def test_partitioned_write_makes_few_files(spark, tmp_path):
    df = spark.range(1000).repartition(8).withColumn("year", (F.col("id") % 3).cast("int"))
    tables.sink_overwrite(df, str(tmp_path / "t"), ["year"])
    assert len(list((tmp_path / "t").glob("year=*/*.parquet"))) == 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000
