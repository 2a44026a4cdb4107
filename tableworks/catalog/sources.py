"""Scans, sinks and parsers. Raw text is derived from the tables and parsed back."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import conversion
from ..session import scratch_path, stored
from ..sources import archives, delimited, events_json, fixed_width, members, rejects, tables, versions
from . import views
from .registry import query

# --- stored tables ----------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def scan_parquet(spark, sf_dir):
    """A folder of several files, pruned to a few columns."""
    path = scratch_path(spark, "lineitem-files")
    views.table(spark, sf_dir, "lineitem").repartition(8, "l_orderkey").write.parquet(path)
    columns = ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    return tables.scan_parquet(spark, path).select(*columns)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_table(spark, sf_dir):
    path = scratch_path(spark, "customer")
    tables.sink_overwrite(views.table(spark, sf_dir, "customer"), path, [])
    return tables.scan_table(spark, path).select("c_custkey", "c_name", "c_acctbal")


@query("SELECT DISTINCT * FROM part")
def scan_sql_file(spark, sf_dir):
    return tables.scan_sql_file(spark, "catalog_parts", f"{sf_dir}/part.parquet", distinct=True)


ORDERS_BY_YEAR = """SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS trade_date,
    CAST(year(o_orderdate) AS INTEGER) AS year FROM orders"""


def _dated_orders(spark, sf_dir) -> DataFrame:
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("trade_date")
    )


@query(ORDERS_BY_YEAR)
def sink_if_absent_derived_partition(spark, sf_dir):
    path = scratch_path(spark, "orders-by-year")
    orders = _dated_orders(spark, sf_dir)
    tables.sink_if_absent(orders, path, ["year"], tables.year_of("trade_date"))
    return tables.scan_table(spark, path)


@query(ORDERS_BY_YEAR)
def sink_if_absent(spark, sf_dir):
    path = scratch_path(spark, "orders-once")
    orders = _dated_orders(spark, sf_dir).withColumns(tables.year_of("trade_date"))
    tables.sink_if_absent(orders, path, ["year"])
    # The second write finds a table and must change nothing.
    tables.sink_if_absent(orders.where(F.col("year") < 1997), path, ["year"])
    return tables.scan_table(spark, path)


@query(ORDERS_BY_YEAR)
def sink_overwrite(spark, sf_dir):
    path = scratch_path(spark, "orders-replaced")
    orders = _dated_orders(spark, sf_dir).withColumns(tables.year_of("trade_date"))
    tables.sink_overwrite(orders.where(F.col("year") < 1997), path, ["year"])
    tables.sink_overwrite(orders, path, ["year"])
    return tables.scan_table(spark, path)


@query(ORDERS_BY_YEAR)
def sink_missing_partitions(spark, sf_dir):
    """Three runs over a growing source: each writes the years that are new."""
    path = scratch_path(spark, "orders-grown")
    orders = _dated_orders(spark, sf_dir)
    for last in (1996, 1999, 9999):
        grown = orders.where(F.year("trade_date") <= last)
        versions.sink_missing_partitions(grown, path, ["year"], tables.year_of("trade_date"))
    return tables.scan_table(spark, path)


@query(ORDERS_BY_YEAR)
def sink_published(spark, sf_dir):
    """A table replaced by what is read from itself, and queried by name."""
    root = scratch_path(spark, "orders-published")
    orders = _dated_orders(spark, sf_dir).withColumns(tables.year_of("trade_date"))
    versions.publish(orders.where(F.col("year") < 1997), root, ["year"])
    later = orders.where(F.col("year") >= 1997)
    versions.publish(versions.published(spark, root).unionByName(later), root, ["year"])
    versions.drop_versions(spark, root)
    return versions.published(spark, root)


# Table -> a number and a text of each row, in expressions that both engines read alike.
COPIED = {
    "benchmark": ("item_id", "text"),
    "conversations": ("conv_id * 100 + turn", "text"),
    "customer": ("c_custkey", "c_name"),
    "documents": ("doc_id", "text"),
    "embeddings": ("vec_id", "CAST(label AS STRING)"),
    "events": ("event_id", "props"),
    "labels": ("doc_id + quality + 2 * toxic", "CAST(quality AS STRING)"),
    "lineitem": ("l_orderkey * 10 + l_linenumber", "l_returnflag"),
    "nation": ("n_nationkey", "n_name"),
    "orders": ("o_orderkey", "o_orderpriority"),
    "pages": ("page_id", "html"),
    "part": ("p_partkey", "p_name"),
    "region": ("r_regionkey", "r_name"),
    "supplier": ("s_suppkey", "s_name"),
}


def _summary(number: str, text: str) -> str:
    """Counts and sums over all rows and all texts of a table, in either engine."""
    return (
        f"count(*) AS rows, CAST(sum({number}) AS BIGINT) AS numbers, "
        f"CAST(sum(length({text})) AS BIGINT) AS chars, count(DISTINCT {text}) AS texts"
    )


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {_summary(*columns)} FROM {name}"
        for name, columns in COPIED.items()
    )
)
def sink_many_tables(spark, sf_dir):
    source, target = scratch_path(spark, "many-source"), scratch_path(spark, "many-target")
    for name in COPIED:
        tables.sink_overwrite(views.table(spark, sf_dir, name), f"{source}/{name}.parquet", [])
    combined = None
    for path in tables.sink_many_tables(spark, source, target):
        name = path.rsplit("/", 1)[-1]
        tables.scan_table(spark, path).createOrReplaceTempView("copied")
        own = spark.sql(f"SELECT '{name}' AS table_name, {_summary(*COPIED[name])} FROM copied")
        combined = own if combined is None else combined.unionByName(own)
    return combined


PREVIEW_ROWS = 100
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    f"""SELECT least(count(*), {PREVIEW_ROWS}) AS preview_rows,
      least(count(*), {PREVIEW_ROWS}) AS members FROM lineitem"""
)
def limit_rows(spark, sf_dir):
    """An unordered preview: which rows come first is not defined, but all are of the table."""
    lines = views.table(spark, sf_dir, "lineitem")
    known = lines.select(*LINE_KEY, F.lit(1).alias("known")).distinct()
    # The preview is bounded.
    preview = lines.limit(PREVIEW_ROWS).join(known, LINE_KEY, "left")
    return preview.agg(F.count("*").alias("preview_rows"), F.count("known").alias("members"))


@query(
    f"""WITH {views.REVIEWS_SQL} SELECT column_name AS col_name,
      CASE WHEN column_type LIKE '%[]' THEN 'list' ELSE lower(column_type) END AS kind
    FROM (DESCRIBE SELECT * FROM reviews)"""
)
def describe_schema(spark, sf_dir):
    described = tables.describe_schema(views.reviews(spark, sf_dir))
    kind = F.col("data_type")
    common = F.when(kind.startswith("array"), "list").when(kind == "string", "varchar")
    return described.select("col_name", common.otherwise(kind).alias("kind"))


# --- fixed width ------------------------------------------------------------------------


def _number(column: Column | str, width: int) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.lpad(column.cast("string"), width, "0")


def _price(column: str, width: int = 13) -> Column:
    # Bars have whole cents. Spark's round goes through decimal text for each value.
    return _number(F.floor(F.col(column) * 100 + 0.5), width)


def _text(column: Column | str, width: int) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.rpad(F.coalesce(column, F.lit("")), width, " ")


def quote_lines(spark, sf_dir) -> DataFrame:
    """Quotes as the fixed-width file has them, in Latin-1, with header and trailer lines."""
    day = F.date_format("trade_date", "yyyyMMdd")
    line = F.concat(
        F.lit("01"), day, _text("bdi_code", 2), _text("ticker", 12), _text("market_type", 3),
        F.replace(_text("company_name", 12), F.lit(" Nº"), F.lit("\x01Nº")),
        _text("specification", 10), _text(F.lit(""), 3), _text(F.lit("R$"), 4),
        _price("open_price"), _price("high_price"), _price("low_price"),
        _price("low_price"), _price("close_price"), _price("low_price"), _price("high_price"),
        _number("total_trades", 5), _number("total_quantity", 18), _price("total_volume", 18),
        _number(F.lit(0), 13), F.lit("0"), F.lit("99991231"), _number("quote_factor", 7),
        _number(F.lit(0), 13), _text("isin_code", 12), _number("total_trades", 3),
    )
    quotes = views.bars(spark, sf_dir).select(line.alias("value"))
    frame = views.table(spark, sf_dir, "nation").select(
        F.concat(F.when(F.col("n_nationkey") < 12, "00").otherwise("99"), "n_name").alias("value")
    )
    return quotes.unionByName(frame).select(F.encode("value", "ISO-8859-1").alias("value"))


QUOTE_FIELDS_SQL = """trade_date, bdi_code, ticker, market_type,
    trim(substring(company_name, 1, 12)) AS company_name,
    coalesce(specification, '') AS specification, 'R$' AS currency, open_price, high_price,
    low_price, low_price AS average_price, close_price, total_trades, total_quantity,
    total_volume, DATE '9999-12-31' AS expiration_date, quote_factor, isin_code,
    total_trades AS distribution_number"""


@query(f"WITH {views.BARS_SQL} SELECT {QUOTE_FIELDS_SQL} FROM bars")
def parse_fixed_width(spark, sf_dir):
    # Stored like a raw file; parsed lazily, Spark would build each line once per field.
    lines = stored(quote_lines(spark, sf_dir), "quote-lines")
    parsed = fixed_width.parse_fixed_width(lines)
    return parsed.drop(
        "forward_term", "best_bid_price", "best_ask_price", "strike_price",
        "correction_indicator", "strike_points",
    )


@query(
    f"""WITH {views.BARS_SQL} SELECT {QUOTE_FIELDS_SQL}, CAST(NULL AS VARCHAR) AS reason
    FROM bars WHERE total_quantity % 7 NOT IN (3, 4)
    UNION ALL BY NAME SELECT ticker, CASE WHEN total_quantity % 7 = 3
      THEN 'unreadable: open_price, total_trades' ELSE 'line too short' END AS reason
    FROM bars WHERE total_quantity % 7 IN (3, 4)"""
)
def reject_fixed_width(spark, sf_dir):
    """Some records have letters among the digits, and some are cut short."""
    line = F.col("value")
    planted = F.substring(line, 153, 18).cast("string").try_cast("long") % 7
    lettered = F.overlay(F.overlay(line, F.lit(b"X"), 57), F.lit(b" "), 148)
    broken = F.when(planted == 3, lettered).when(planted == 4, F.substring(line, 1, 200))
    lines = quote_lines(spark, sf_dir).select(broken.otherwise(line).alias("value"))
    checked = rejects.fixed_width_lines(stored(lines, "quote-lines"), max_share=0.5)
    good = checked.good.drop(
        "forward_term", "best_bid_price", "best_ask_price", "strike_price",
        "correction_indicator", "strike_points",
    )
    ticker = F.trim(F.decode(F.substring("value", 13, 12), "ISO-8859-1"))
    bad = checked.rejects.select(ticker.alias("ticker"), "reason")
    return good.unionByName(bad, allowMissingColumns=True)


# --- delimited text ---------------------------------------------------------------------

TITLE_TEXT_SQL = f"""WITH {views.TITLES_SQL}
SELECT tconst, titleType, primaryTitle, endYear, coalesce(genres, '') AS genres FROM titles"""
TITLE_COLUMNS = ["tconst", "titleType", "primaryTitle", "endYear", "genres"]


def _write_titles(spark, sf_dir, sep: str, compression: str = "none") -> str:
    path = scratch_path(spark, "titles-text")
    titles = views.titles(spark, sf_dir).select(*TITLE_COLUMNS).na.fill("")
    titles.write.csv(
        path, sep=sep, header=True, quote="", escape="\0", emptyValue="", compression=compression
    )
    return path


@query(TITLE_TEXT_SQL)
def parse_delimited_strings(spark, sf_dir):
    """A folder whose files have two column orders."""
    path = scratch_path(spark, "titles-text")
    titles = views.titles(spark, sf_dir).select(*TITLE_COLUMNS).na.fill("")
    even = F.pmod(F.xxhash64("tconst"), F.lit(2)) == 0
    write = {"sep": "|", "header": True, "quote": "", "escape": "\0", "emptyValue": ""}
    titles.where(even).write.csv(path, **write)
    titles.where(~even).select(*TITLE_COLUMNS[::-1]).write.mode("append").csv(path, **write)
    return delimited.parse_delimited_strings(spark, path, "|").select(*TITLE_COLUMNS)


@query(TITLE_TEXT_SQL)
def scan_gzip_text(spark, sf_dir):
    path = _write_titles(spark, sf_dir, "\t", "gzip")
    return delimited.scan_gzip_text(spark, path, partitions=8)


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, replace(replace(text, chr(10), ' '),
       chr(13), ' ') AS text FROM documents"""
)
def parse_delimited_quoted(spark, sf_dir):
    """Separator, quotes and all: every field is quoted and quotes inside are doubled."""
    path = scratch_path(spark, "documents-text")
    text = F.translate("text", "\n\r", "  ")
    documents = views.table(spark, sf_dir, "documents").select("doc_id", "lang", text.alias("text"))
    documents.write.csv(path, sep=";", header=True, quoteAll=True, quote='"', escape='"')
    return delimited.parse_delimited_strings(spark, path, ";", '"')


@query(
    """SELECT doc_id, lang, text, line, reason FROM (
      SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(lang, '') AS lang,
        translate(coalesce(text, ''), chr(10) || chr(13) || '|', '   ') AS text,
        doc_id % 10 AS digit, NULL AS line, NULL AS reason FROM documents)
    WHERE digit <> 3
    UNION ALL SELECT NULL, NULL, NULL, doc_id || '|' || coalesce(lang, ''), 'not 3 fields'
    FROM documents WHERE doc_id % 10 = 3"""
)
def reject_delimited(spark, sf_dir):
    """Every tenth line lacks its last field."""
    path = scratch_path(spark, "ragged-text")
    key, text = F.col("doc_id").cast("string"), F.translate("text", "\n\r|", "   ")
    ragged = F.when(F.col("doc_id") % 10 != 3, F.coalesce(text, F.lit("")))
    line = F.concat_ws("|", key, F.coalesce("lang", F.lit("")), ragged)
    # A table of one column whose name is the header.
    views.table(spark, sf_dir, "documents").select(line.alias("doc_id|lang|text")).write.csv(
        path, header=True, sep="\x01", quote="", escape="\0", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    checked = rejects.delimited_strings(spark, path, "|", max_share=0.2)
    return checked.good.unionByName(checked.rejects.drop(*rejects.ORIGIN), allowMissingColumns=True)


# --- archives ---------------------------------------------------------------------------

ARCHIVED = ["s_suppkey", "s_name", "s_nationkey"]


def _zip(members: dict[str, bytes]) -> bytes:
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as bundle:
        for name, content in members.items():
            bundle.writestr(name, content)
    return packed.getvalue()


def _suppliers(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, bytes]]:
    """One archive's members per Arrow batch of lines, in two column orders."""
    for number, batch in enumerate(batches):
        turned = slice(None, None, -1 if number % 2 else 1)
        rows = [line.split("|")[turned] for line in batch.column("line").to_pylist()]
        lines = ["|".join(row) for row in [ARCHIVED[turned], *rows]]
        yield {"data.csv": "\r\n".join(lines).encode(), "second.csv": b"skipped"}


def _nested_suppliers(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, bytes]]:
    for members in _suppliers(batches):
        inner = _zip({"data.txt": members["data.csv"]})
        yield {
            "pricing file PPUF_2025Q1.zip": inner,
            "pharmacy networks file PPUF_2025Q1 part 3.zip": inner,
            # Not an archive: unpacking what is to be skipped would fail.
            "sample pricing file PPUF.zip": b"skipped",
            "readme.txt": b"skipped",
        }


def _quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, bytes]]:
    for batch in batches:
        yield {"quotes.txt": b"\n".join(batch.column("line").to_pylist())}


def _write_archives(lines: DataFrame, members, name: str) -> str:
    """Archives written by the tasks that hold their lines, below the shared folder."""
    folder = scratch_path(lines.sparkSession, name)
    root = folder if ":" in folder else f"file://{folder}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pa.fs.FileSystem.from_uri(root)
        files.create_dir(base)
        for packed in members(batches):
            path = f"{base}/{uuid.uuid4().hex}.zip"
            with files.open_output_stream(path) as stream:
                stream.write(_zip(packed))
            yield pa.record_batch({"path": [path]})

    lines.mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()
    return folder


def _supplier_lines(spark, sf_dir) -> DataFrame:
    return views.table(spark, sf_dir, "supplier").select(
        F.concat_ws("|", *[F.col(c).cast("string") for c in ARCHIVED]).alias("line")
    )


ARCHIVED_SQL = "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ARCHIVED)


def _headers(lines: DataFrame) -> list[str]:
    return sorted(row[0] for row in lines.select("header").distinct().collect())


@query(f"{ARCHIVED_SQL} FROM supplier")
def scan_zip_text(spark, sf_dir):
    """Columns come from each archive's own header."""
    path = _write_archives(_supplier_lines(spark, sf_dir), _suppliers, "zipped")
    headers = _headers(archives.scan_zip_text(spark, path, headers_only=True))
    lines = archives.scan_zip_text(spark, path)
    return delimited.parse_headed_lines(lines, headers, "|").select(*ARCHIVED)


NESTED_SQL = " UNION ALL ".join(
    f"{ARCHIVED_SQL}, '{name}' AS table_name FROM supplier"
    for name in ("pricing", "pharmacy_networks")
)


@query(NESTED_SQL)
def scan_nested_zip(spark, sf_dir):
    path = _write_archives(_supplier_lines(spark, sf_dir), _nested_suppliers, "nested")
    options = {"nested": True, "tables": []}
    headers = _headers(archives.scan_zip_text(spark, path, headers_only=True, **options))
    lines = archives.scan_zip_text(spark, path, **options)
    routed = lines.withColumn("table_name", archives.member_table(F.col("member")))
    parsed = delimited.parse_headed_lines(routed, headers, "|", keep=["table_name"])
    return parsed.select(*ARCHIVED, "table_name")


MEMBERS = 8


def _suppliers_by_member(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, bytes]]:
    """Nested archives of several tables, and members that are none."""
    for batch in batches:
        rows = [line.split("|") for line in batch.column("line").to_pylist()]
        packed = {"readme.txt": b"skipped", "sample region 1 file PPUF_2025Q1.zip": b"skipped"}
        for number in range(MEMBERS):
            own = [ARCHIVED, *(row for row in rows if int(row[0]) % MEMBERS == number)]
            text = "\r\n".join("|".join(row) for row in own)
            packed[f"region {number} file PPUF_2025Q1.zip"] = _zip({"data.txt": text.encode()})
        yield packed


@query(f"{ARCHIVED_SQL}, 'region_' || (s_suppkey % {MEMBERS}) AS table_name FROM supplier")
def scan_zip_members(spark, sf_dir):
    """Every member of nested archives is a partition of its own."""
    path = _write_archives(_supplier_lines(spark, sf_dir), _suppliers_by_member, "members")
    lines = members.scan_zip_members(spark, path, nested=True, tables=[])
    routed = lines.withColumn("table_name", archives.member_table(F.col("member")))
    parsed = delimited.parse_headed_lines(routed, ["|".join(ARCHIVED)], "|", keep=["table_name"])
    return parsed.select(*ARCHIVED, "table_name")


@query(NESTED_SQL)
def convert_nested_members(spark, sf_dir):
    """Nested archives to one table per route, each read member by member."""
    source = _write_archives(_supplier_lines(spark, sf_dir), _nested_suppliers, "nested")
    made = conversion.convert_nested_zip(spark, source, scratch_path(spark, "routes"), by_member=True)
    found = [
        tables.scan_table(spark, path).select(*ARCHIVED, F.lit(name).alias("table_name"))
        for name, path in made.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query(NESTED_SQL)
def convert_nested_zip(spark, sf_dir):
    """Nested archives to one table per route."""
    source = _write_archives(_supplier_lines(spark, sf_dir), _nested_suppliers, "nested")
    made = conversion.convert_nested_zip(spark, source, scratch_path(spark, "routes"))
    found = [
        tables.scan_table(spark, path).select(*ARCHIVED, F.lit(name).alias("table_name"))
        for name, path in made.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    f"""WITH {views.BARS_SQL} SELECT {QUOTE_FIELDS_SQL},
    CAST(year(trade_date) AS INTEGER) AS year FROM bars"""
)
def convert_quotes_zip(spark, sf_dir):
    """Zipped fixed-width quotes to a table by year."""
    lines = quote_lines(spark, sf_dir).select(F.col("value").alias("line"))
    source = _write_archives(lines, _quotes, "zipped-quotes")
    made = conversion.convert_quotes_zip(spark, source, scratch_path(spark, "quotes"))
    return tables.scan_table(spark, made).drop(
        "forward_term", "best_bid_price", "best_ask_price", "strike_price",
        "correction_indicator", "strike_points",
    )


MEMBER_SQL = """CASE p_type
    WHEN 'PROMO' THEN 'sample ' || p_name || ' file PPUF_2025Q1.zip'
    WHEN 'SMALL' THEN p_name || '.txt'
    WHEN 'LARGE' THEN p_name || ' file PPUF_2025Q1 part ' || p_size || '.zip'
    WHEN 'ECONOMY' THEN p_name || '  PPUF_2025Q1.zip'
    ELSE p_name || ' file PPUF_2025Q1.zip' END"""


@query(
    f"""WITH members AS (SELECT p_partkey, p_brand AS quarter, {MEMBER_SQL} AS member FROM part),
    parsed AS (SELECT *, regexp_extract(member, '^(.+?)\\s+(?:file\\s+)?PPUF', 1) AS stem,
               regexp_extract(member, 'part (\\d+)', 1) AS part_no FROM members)
    SELECT p_partkey, member, CASE WHEN member LIKE 'sample%' OR stem = '' THEN NULL
      ELSE replace(trim(stem), ' ', '_') || '/' || quarter ||
           CASE WHEN part_no = '' THEN '' ELSE '_part' || part_no END || '.parquet' END AS route
    FROM parsed"""
)
def route_member(spark, sf_dir):
    kind, name = F.col("p_type"), F.col("p_name")
    size = F.col("p_size").cast("string")
    member = (
        F.when(kind == "PROMO", F.concat(F.lit("sample "), name, F.lit(" file PPUF_2025Q1.zip")))
        .when(kind == "SMALL", F.concat(name, F.lit(".txt")))
        .when(
            kind == "LARGE",
            F.concat(name, F.lit(" file PPUF_2025Q1 part "), size, F.lit(".zip")),
        )
        .when(kind == "ECONOMY", F.concat(name, F.lit("  PPUF_2025Q1.zip")))
        .otherwise(F.concat(name, F.lit(" file PPUF_2025Q1.zip")))
    )
    parts = views.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("quarter"), member.alias("member")
    )
    route = archives.route_member(F.col("member"), F.col("quarter"))
    return parts.select("p_partkey", "member", route.alias("route"))


# --- JSON -------------------------------------------------------------------------------


def company_documents(spark, sf_dir) -> DataFrame:
    """One company document per order, in every shape the source uses."""
    total = views.cents("o_totalprice")
    factor = F.concat(
        F.expr("CAST(round(o_totalprice * 100) AS BIGINT) div 100000").cast("string"),
        F.lit("."),
        F.lpad((F.expr("CAST(round(o_totalprice * 100) AS BIGINT) div 100") % 1000).cast("string"), 3, "0"),
        F.lit(","),
        F.lpad((total % 100).cast("string"), 2, "0"),
    )
    day = F.date_format(F.col("o_orderdate").cast("date"), "dd/MM/yyyy")
    prior = F.when(F.col("o_orderstatus") == "P", "").otherwise(day)
    event = F.format_string(
        '{"isinCode":"I%s","label":"%s","factor":"%s","lastDatePrior":"%s","approvedOn":"%s"}',
        F.col("o_orderkey"), F.col("o_orderstatus"), factor, prior, day,
    )
    company = F.format_string('{"code":1,"stockDividends":[%s]}', event)
    priority = F.col("o_orderpriority")
    shape = (
        F.when(priority == "1-URGENT", company)
        .when(priority == "2-HIGH", F.concat(F.lit("["), company, F.lit(', {"code":2}]')))
        .when(priority == "3-MEDIUM", F.lit("[]"))
        .when(priority == "5-LOW", F.lit('{"stockDividends":null}'))
        .otherwise(F.lit('{"code":3}'))
    )
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("company"), shape.alias("document")
    )


@query(
    """SELECT CAST(o_custkey AS VARCHAR) AS issuing_company, 'I' || o_orderkey AS isin_code,
      o_orderstatus AS label, CAST(round(o_totalprice * 100) AS BIGINT) / 100.0 AS factor,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS last_date_prior,
      CAST(o_orderdate AS DATE) AS approved_on
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"""
)
def flatten_event_json(spark, sf_dir):
    return events_json.flatten_event_json(company_documents(spark, sf_dir), "document", "company")


@query(
    """SELECT CAST(o_custkey AS VARCHAR) AS issuing_company, 'I' || o_orderkey AS isin_code,
      o_orderstatus AS label, CAST(round(o_totalprice * 100) AS BIGINT) / 100.0 AS factor,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS last_date_prior,
      CAST(o_orderdate AS DATE) AS approved_on, CAST(NULL AS VARCHAR) AS reason
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderkey % 11 > 1
    UNION ALL BY NAME SELECT CAST(o_custkey AS VARCHAR) AS issuing_company,
      CASE WHEN o_orderkey % 11 = 0 THEN 'not JSON' ELSE 'an event without factor' END AS reason
    FROM orders WHERE o_orderkey % 11 = 0
      OR o_orderkey % 11 = 1 AND o_orderpriority IN ('1-URGENT', '2-HIGH')"""
)
def reject_companies(spark, sf_dir):
    """Some documents are cut short, and some events lack a field."""
    documents = company_documents(spark, sf_dir)
    document, planted = F.col("document"), F.col("o_orderkey") % 11
    cut = F.when(planted == 0, F.substring(document, F.lit(1), F.length(document) - 1))
    renamed = F.replace(document, F.lit('"factor"'), F.lit('"other"'))
    broken = documents.withColumn("document", cut.when(planted == 1, renamed).otherwise(document))
    checked = rejects.company_documents(broken, "document", "company", max_share=0.2)
    return checked.good.unionByName(checked.rejects.drop("document"), allowMissingColumns=True)


COMPANIES_SQL = """SELECT c_custkey,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'DR2' WHEN 'MACHINERY' THEN '' END AS "typeBDR",
      CASE WHEN c_acctbal < 0 THEN '31/12/9999' WHEN c_acctbal < 5000 THEN '02/01/1998' END
        AS "dateListing"
    FROM customer"""


@query(
    f"""SELECT * FROM ({COMPANIES_SQL})
    WHERE coalesce("typeBDR", '') = '' AND "dateListing" IS DISTINCT FROM '31/12/9999'"""
)
def filter_listed_companies(spark, sf_dir):
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    companies = views.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(segment == "BUILDING", "DR2").when(segment == "MACHINERY", "").alias("typeBDR"),
        F.when(balance < 0, "31/12/9999").when(balance < 5000, "02/01/1998").alias("dateListing"),
    )
    return events_json.filter_listed_companies(companies)
