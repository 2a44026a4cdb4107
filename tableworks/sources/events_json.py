"""Company JSON to share-event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields read from a company document, and the date of companies that
# never listed.
EVENTS = (
    "array<struct<"
    "isinCode:string,label:string,factor:string,lastDatePrior:string,approvedOn:string>>"
)
NEVER_LISTED = "31/12/9999"


# Fixed value: the fields that every event has.
FIELDS = ("isinCode", "label", "factor", "lastDatePrior", "approvedOn")


def _date(text: Column) -> Column:
    return F.try_to_date(F.nullif(text, F.lit("")), "dd/MM/yyyy")


def _decimal_comma(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return plain.try_cast("double")


def company_events(document: Column) -> Column:
    """A company document as a struct: its typed ``events``, and the ``reason`` if it is no good.

    A list stands for its first element, an empty one for no events. A document is no good if it is
    no JSON, if it holds no object, if its events are no list of objects, if an event lacks a field,
    or if a number or a date does not read; an empty date is no date. A null document has no events.
    """
    parsed = F.try_parse_json(document)
    listed = F.try_variant_get(parsed, "$", "array<variant>")
    company = F.when(listed.isNotNull(), F.get(listed, F.lit(0))).otherwise(parsed)
    fields = F.try_variant_get(company, "$", "map<string, variant>")
    raw = F.try_variant_get(company, "$.stockDividends", EVENTS)
    given = F.try_variant_get(company, "$.stockDividends", "string")
    events = F.transform(
        raw,
        lambda event: F.struct(
            event["isinCode"].alias("isin_code"),
            event["label"].alias("label"),
            _decimal_comma(event["factor"]).alias("factor"),
            _date(event["lastDatePrior"]).alias("last_date_prior"),
            _date(event["approvedOn"]).alias("approved_on"),
        ),
    )

    def any_event(test) -> Column:
        return F.coalesce(F.exists(raw, test), F.lit(False))

    def undated(event: Column, name: str) -> Column:
        return (event[name] != "") & _date(event[name]).isNull()

    reason = (
        F.when(document.isNotNull() & parsed.isNull(), "not JSON")
        .when(company.isNotNull() & fields.isNull(), "no object")
        .when(given.isNotNull() & raw.isNull(), "events are no list of objects")
        .when(any_event(lambda event: event.isNull()), "an event is no object")
    )
    for name in FIELDS:
        reason = reason.when(any_event(lambda event: event[name].isNull()), f"an event without {name}")  # noqa: B023
    reason = reason.when(
        any_event(lambda event: _decimal_comma(event["factor"]).isNull()), "factor is no number"
    )
    for name in FIELDS[3:]:
        reason = reason.when(any_event(lambda event: undated(event, name)), f"{name} is no date")  # noqa: B023
    return F.struct(events.alias("events"), reason.alias("reason"))


def flatten_event_json(df: DataFrame, json_col: str, company_col: str) -> DataFrame:
    """One row per event of the documents that read.

    Documents that do not are skipped; ``rejects.company_documents`` hands them out and counts them.
    """
    good = df.select(
        F.col(company_col).alias("issuing_company"), company_events(F.col(json_col)).alias("_company")
    ).where(F.col("_company.reason").isNull())
    return good.select("issuing_company", F.inline("_company.events"))


def filter_listed_companies(df: DataFrame) -> DataFrame:
    """Companies that are not depositary-receipt issuers, but for those that never listed.

    An unknown listing date is kept.
    """
    receipt = F.coalesce(F.col("typeBDR"), F.lit("")) != ""
    return df.where(~receipt & ~F.col("dateListing").eqNullSafe(NEVER_LISTED))
