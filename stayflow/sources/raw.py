"""Readers for the three raw rental tables when they exist as files.

The schemas are fixed (never inferred), so a changed upstream file fails loudly
instead of silently reshaping the build. Column types follow how the build uses
each column (ids long, dates date, flags boolean, prices and JSON arrays as
text to be parsed by staging).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_SCHEMAS = {
    "listings": ("id long, name string, host_id long, host_name string, host_since date, host_location string, "
                 "host_verifications string, neighborhood string, property_type string, room_type string, "
                 "accommodates int, bathrooms_text string, bedrooms int, beds int, amenities string, "
                 "price string, number_of_reviews int, first_review string, last_review string, "
                 "review_scores_rating double"),
    "calendar": ("listing_id long, date date, available boolean, reservation_id string, price string, "
                 "minimum_nights int, maximum_nights int"),
    "amenities_changelog": "listing_id long, change_at timestamp, amenities string",
}


def read_raw(spark: SparkSession, paths: dict[str, str], fmt: str = "csv", multi_line: bool = False) -> dict[str, DataFrame]:
    """{name: path} -> {name: DataFrame} for ``Warehouse(raw=...)``.

    CSV is read with RFC 4180 quoting (``"`` escaped by doubling; JSON arrays may contain commas and quotes). Its
    header must name the columns of the schema in their order: swapped or missing columns fail. Files are split
    over tasks; ``multi_line`` allows line feeds inside values, at the cost of one task per file."""
    out = {}
    for name, path in paths.items():
        schema = RAW_SCHEMAS[name]
        if fmt == "csv":
            reader = (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
                      .option("enforceSchema", False).option("multiLine", multi_line).option("mode", "FAILFAST"))
            out[name] = reader.csv(path)
        else:
            out[name] = spark.read.schema(schema).format(fmt).load(path)
    return out
