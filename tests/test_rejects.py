import datetime as dt

import pytest
from pyspark.sql import functions as F

from tableworks.catalog import sources as catalog
from tableworks.sources import events_json, fixed_width, rejects

EVENT = '{"isinCode":"I","label":"L","factor":"%s","lastDatePrior":"%s","approvedOn":"01/02/2003"}'
GOOD = EVENT % ("1.234,56", "31/01/2003")


def company(*events):
    return '{"stockDividends":[%s]}' % ",".join(events)


DOCUMENTS = {
    "object": (company(GOOD, GOOD), 2),
    "list": (f"[{company(GOOD)}, 5]", 1),
    "list of numbers": ("[5]", "no object"),
    "null": ("null", "no object"),
    "null event": (company(GOOD, "null"), "an event is no object"),
    "text of numbers": (company(GOOD.replace('"I"', "12")), 1),
    "first of list": (f"[{company(GOOD)}, {company(GOOD, GOOD)}]", 1),
    "no companies": ("[]", 0),
    "no events": ('{"stockDividends":[]}', 0),
    "null events": ('{"stockDividends":null}', 0),
    "other fields": ('{"code":3}', 0),
    "no document": (None, 0),
    "empty date": (company(EVENT % ("1", "")), 1),
    "empty text": ("", "not JSON"),
    "cut short": (company(GOOD)[:-1], "not JSON"),
    "prose": ("gateway timeout", "not JSON"),
    "events a number": ('{"stockDividends":5}', "events are no list of objects"),
    "event a number": (company(GOOD, "5"), "an event is no object"),
    "lacks a field": (company(GOOD, GOOD.replace("factor", "other")), "an event without factor"),
    "null field": (company(GOOD.replace('"L"', "null")), "an event without label"),
    "number": (company(EVENT % ("one", "31/01/2003")), "factor is no number"),
    "date": (company(GOOD, EVENT % ("1", "31/02/2003")), "lastDatePrior is no date"),
}


def documents(spark):
    rows = [(name, text, 1) for name, (text, _) in DOCUMENTS.items()]
    return spark.createDataFrame(rows, "c string, d string, events int").coalesce(2)


def test_company_documents(spark):
    checked = rejects.company_documents(documents(spark), "d", "c", max_share=0.7)
    want = {name: found for name, (_, found) in DOCUMENTS.items()}
    reasons = {r["issuing_company"]: r["reason"] for r in checked.rejects.collect()}
    assert reasons == {name: found for name, found in want.items() if isinstance(found, str)}
    events = {r[0]: r[1] for r in checked.good.groupBy("issuing_company").count().collect()}
    assert events == {name: found for name, found in want.items() if found and not isinstance(found, str)}
    assert (checked.rows, checked.rejected) == (len(DOCUMENTS), len(reasons))
    kept = {r["issuing_company"]: r["document"] for r in checked.rejects.collect()}
    assert kept == {name: DOCUMENTS[name][0] for name in reasons}
    row = checked.good.where("issuing_company = 'first of list'").first()
    assert tuple(row)[1:] == ("I", "L", 1234.56, dt.date(2003, 1, 31), dt.date(2003, 2, 1))


def test_bad_documents_are_skipped(spark):
    events = events_json.flatten_event_json(documents(spark), "d", "c")
    assert {r[0] for r in events.collect()} == {
        name for name, (_, found) in DOCUMENTS.items() if found and not isinstance(found, str)
    }


def test_too_many_rejects(spark):
    with pytest.raises(rejects.TooManyRejects, match=f"of {len(DOCUMENTS)} rows"):
        rejects.company_documents(documents(spark), "d", "c")
    empty = rejects.company_documents(documents(spark).limit(0), "d", "c", max_share=0.0)
    assert (empty.rows, empty.rejected, empty.good.count(), empty.rejects.count()) == (0, 0, 0, 0)


def test_ragged_lines_name_their_file(spark, tmp_path):
    """Two column orders; ragged lines of either; empty fields are no fault."""
    (tmp_path / "one.csv").write_text("a|b|c\n1||3\nfew|x\n\\N|5|6\n7|8|9|many\n")
    (tmp_path / "two.csv").write_text("c|b\n30|20\n31\n")
    checked = rejects.delimited_strings(spark, str(tmp_path), "|", max_share=0.6)
    assert checked.good.columns == ["a", "b", "c"]
    good = sorted(map(tuple, checked.good.collect()), key=repr)
    assert good == [("1", "", "3"), ("\\N", "5", "6"), (None, "20", "30")]
    bad = {(r["file"].rsplit("/", 1)[-1], r["block"], r["line"], r["reason"]) for r in checked.rejects.collect()}
    assert bad == {
        ("one.csv", 0, "few|x", "not 3 fields"),
        ("one.csv", 0, "7|8|9|many", "not 3 fields"),
        ("two.csv", 0, "31", "not 2 fields"),
    }
    assert (checked.rows, checked.rejected) == (6, 3)


def test_fixed_width_reasons(spark, tmp_path):
    layout = (
        ("day", 3, 10, fixed_width.Field.DATE),
        ("name", 11, 13, fixed_width.Field.TEXT),
        ("count", 14, 17, fixed_width.Field.INT),
        ("price", 18, 22, fixed_width.Field.PRICE),
    )
    cases = {
        "0120200102ABC000100250": None,
        "0120200102   -00100250 and more": None,
        "00header": "no record",
        "0120200102ABC0001": "line too short",
        "01": "line too short",
        "0120201302ABC000100250": "unreadable: day",
        "0120200102ABC 00100250": "unreadable: count",
        "0120200102ABC000x0 250": "unreadable: count, price",
    }
    (tmp_path / "lines.txt").write_text("\n".join(cases) + "\n")
    lines = rejects.text_lines(spark, str(tmp_path))
    checked = rejects.fixed_width_lines(lines, layout, max_share=0.9)
    day = dt.date(2020, 1, 2)
    good = sorted(map(tuple, checked.good.collect()))
    assert good == [(day, "", -1, 2.5), (day, "ABC", 1, 2.5)]
    found = {bytes(r["value"]).decode(): r["reason"] for r in checked.rejects.collect()}
    assert found == {line: why for line, why in cases.items() if why not in (None, "no record")}
    assert {r["file"].rsplit("/", 1)[-1] for r in checked.rejects.collect()} == {"lines.txt"}
    with pytest.raises(ValueError, match="named like fields"):
        rejects.fixed_width_lines(lines.withColumn("day", F.lit(1)), layout)


def test_good_lines_read_as_the_strict_parser_reads_them(spark):
    lines = catalog.quote_lines(spark, "/root/testdata/sf0.001").cache()
    checked = rejects.fixed_width_lines(lines)
    strict = fixed_width.parse_fixed_width(lines)
    assert checked.good.columns == strict.columns and checked.rejected == 0
    assert sorted(map(repr, checked.good.collect())) == sorted(map(repr, strict.collect()))


def test_input_is_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = documents(spark)
    checked = rejects.company_documents(df.mapInArrow(seen, df.schema), "d", "c", max_share=0.7)
    checked.good.collect(), checked.rejects.collect()
    assert read.value == len(DOCUMENTS)


def test_every_field_is_read_once(spark):
    """The reason looks at what was read: no date is parsed a second time for it."""
    lines = spark.range(3).select(F.concat(F.lit("0120010203"), F.col("id").cast("string")).alias("value"))
    layout = [("day", 3, 10, fixed_width.Field.DATE), ("number", 11, 11, fixed_width.Field.INT)]
    read = fixed_width.read_fixed_width(lines, layout)
    assert read._jdf.queryExecution().optimizedPlan().toString().count("yyyyMMdd") == 1
    assert [(r["day"], r["number"], r["reason"]) for r in read.collect()] == [(dt.date(2001, 2, 3), n, None) for n in range(3)]
