"""Validation of normalised documents: the first rule that fails, as a message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafmill.functions.scalars import DATE_PATTERN, LANG_PATTERN, YEAR_PATTERN


def _missing(name: str) -> str:
    return f"'{name}' is a required property"


def _first(array: Column, bad) -> Column:
    """The first element for which bad is true, or null."""
    return F.get(F.filter(array, lambda x: F.coalesce(bad(x), F.lit(False))), F.lit(0))


def _mismatch(value: Column, pattern: str) -> Column:
    return F.when(value.isNotNull() & ~value.rlike(pattern), F.concat(F.lit("'"), value, F.lit(f"' does not match '{pattern}'")))


def _required(doc: Column, field: str, *names: str) -> Column:
    out = F.lit(None).cast("string")
    for name in reversed(names):
        out = F.when(F.coalesce(F.exists(doc[field], lambda x: x[name].isNull()), F.lit(False)), F.lit(_missing(name))).otherwise(out)
    return out


def _pattern(doc: Column, field: str, name: str, pattern: str) -> Column:
    return _mismatch(_first(doc[field], lambda x: x[name].isNotNull() & ~x[name].rlike(pattern))[name], pattern)


def rules(doc: Column) -> dict[str, Column]:
    """Rule name -> message where the rule is broken, null elsewhere; in the order in which they are tried."""
    required = F.coalesce(*(F.when(doc[name].isNull(), F.lit(_missing(name))) for name in ("id", "creators", "titles", "types")))
    one_of = F.when(doc["doi"].isNotNull() == doc["url"].isNotNull(), F.lit("exactly one of 'doi' and 'url' is required"))
    return {
        "required": required,
        "doi_or_url": one_of,
        "titles": F.coalesce(_required(doc, "titles", "title"), _pattern(doc, "titles", "lang", LANG_PATTERN)),
        "subjects": F.coalesce(_required(doc, "subjects", "subject"), _pattern(doc, "subjects", "lang", LANG_PATTERN)),
        "creators": _required(doc, "creators", "creatorName"),
        "publicationYear": _mismatch(doc["publicationYear"], YEAR_PATTERN),
        "descriptions": F.coalesce(_required(doc, "descriptions", "description", "descriptionType"), _pattern(doc, "descriptions", "lang", LANG_PATTERN)),
        "dates": F.coalesce(_required(doc, "dates", "date", "dateType"), _pattern(doc, "dates", "date", DATE_PATTERN)),
        "types": F.when(doc["types"].isNotNull() & doc["types"]["resourceTypeGeneral"].isNull(), F.lit(_missing("resourceTypeGeneral"))),
    }


def validation_error(doc: Column) -> Column:
    """The message of the first broken rule, or null."""
    return F.coalesce(*rules(doc).values())


def validate(normalized: DataFrame) -> DataFrame:
    """Documents of status `ok` that break a rule become errors."""
    message = F.when(F.col("status") == "ok", validation_error(F.col("doc")))
    out = normalized.withColumn("_found", message)
    bad = F.col("_found").isNotNull()
    return out.withColumns({"doc": F.when(~bad, F.col("doc")), "status": F.when(bad, "error").otherwise(F.col("status")), "message": F.coalesce("_found", "message")}).drop("_found")
