"""Records built from what a card index's interface answers, and details laid over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.functions import text as T

# fixed values: record field and the answer's fields that can hold it
CARD_FIELDS = {
    "application_number": ["applic"], "pension_number": ["pensio"], "company": ["compan"], "regiment": ["regime"], "subject": ["subjec"], "coverage": ["covera"],
    "creator": ["author", "creato"], "publisher": ["publia"], "date": ["date"], "rights": ["rights", "righta"], "language": ["langua"], "description": ["descri"],
}


def pensioner_record(item: Column, collection: str, fields: Column, site: str) -> Column:
    """A struct of one card: its id, names split, card fields and addresses below ``site``; '' for what isn't there."""
    of = lambda *names: F.coalesce(*[F.nullif(F.try_element_at(fields, F.lit(n)), F.lit("")) for n in names], F.lit(""))
    own, spouse = T.split_listed(of("title")), T.split_listed(of("spouse"))
    part = lambda s, p, n: F.coalesce(s.getField(n), F.lit("")).alias(f"{p}{n}_name")
    card = item.cast("string")
    return F.struct(
        item.alias("id"),
        F.lit(collection).alias("collection"),
        of("title").alias("name_raw"),
        *[part(own, "", n) for n in ("first", "middle", "last")],
        of("spouse").alias("spouse_name_raw"),
        *[part(spouse, "spouse_", n) for n in ("first", "middle", "last")],
        *[of(*names).alias(n) for n, names in CARD_FIELDS.items()],
        F.concat(F.lit(f"{site}/collection/{collection}/id/"), card).alias("backlink"),
        F.concat(F.lit(f"{site}/iiif/2/{collection}:"), card, F.lit("/full/max/0/default.jpg")).alias("iiif_url"),
    )


def overlaid(rows: DataFrame, key: str, details: DataFrame, at: Column) -> DataFrame:
    """``rows`` with the fields of ``details`` (``key`` and a map ``fields``) over their own, when they were fetched, and what failed.

    Fields that start with ``_`` are markers and not laid over; a null map is ``fetch_failed``, an empty one ``empty_details``,
    and both leave the row as it is. Rows that were not asked for have no error.
    """
    side = details.select(key, F.col("fields").alias("_f"), F.lit(True).alias("_asked"))
    j = rows.join(side, key, "left")
    usable = F.coalesce(F.size("_f") > 0, F.lit(False))
    new = [F.coalesce(F.try_element_at("_f", F.lit(c)).cast(t), F.col(c)).alias(c) if c != key and not c.startswith("_") else F.col(c) for c, t in rows.dtypes]
    error = F.when(F.col("_asked") & F.col("_f").isNull(), "fetch_failed").when(F.col("_asked") & ~usable, "empty_details")
    return j.select(*new, F.when(usable, at).alias("fetched_at"), error.alias("fetch_error"))
