"""Reviews and their summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def star_counts(total: Column, percents: Column) -> Column:
    """Counts of one to five stars from whole percentages: each rounded half up, the rest to the largest percentage.

    Of equal percentages the lowest star takes the rest, so the counts always sum to the total.
    """
    rough = F.transform(percents, lambda p: F.floor(total.cast("double") * p / F.lit(100.0) + F.lit(0.5)).cast("long"))
    rest = total.cast("long") - F.aggregate(rough, F.lit(0).cast("long"), lambda a, x: a + x)
    largest = F.array_position(percents, F.array_max(percents)) - 1
    return F.transform(rough, lambda x, i: F.when(i == largest, x + rest).otherwise(x))


def has_reviews(total: Column) -> Column:
    """By the number of reviews: an average is often 0.0 where there are none."""
    return F.coalesce(total > 0, F.lit(False))


def review_key(vendor: str, own_id: Column, published: Column, author: Column) -> Column:
    """``vendor:id``, or date and author where a review has no id."""
    own = F.nullif(F.trim(own_id), F.lit(""))
    return F.coalesce(F.concat(F.lit(f"{vendor}:"), own), F.concat_ws("|", published, author))


def with_source(review_url: Column, product_id: Column) -> Column:
    """The review's address with the product that it was found under."""
    return F.concat(review_url, F.lit("#bv-src-product="), product_id.cast("string"))
