"""Read queries over the state tables. Filters are plain columns, so they reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_equal(df: DataFrame, **values) -> DataFrame:
    """Rows whose named columns equal the given values."""
    for name, value in values.items():
        df = df.where(F.col(name) == value)
    return df


def by_id(df: DataFrame, document_id: str) -> DataFrame:
    return where_equal(df, document_id=document_id)


def registry_by_id(registry: DataFrame, document_id: str) -> DataFrame:
    """The id is taken apart so that the filter is on stored columns."""
    parts = document_id.split("-")
    if len(parts) != 3 or not (parts[1].isdigit() and parts[2].isdigit()):
        return registry.limit(0)
    return where_equal(registry, type=parts[0], year=int(parts[1]), number=int(parts[2]))


def exists(df: DataFrame, **values) -> DataFrame:
    """One row, one boolean column."""
    return where_equal(df, **values).limit(1).agg((F.count(F.lit(1)) > 0).alias("exists"))


def listing(df: DataFrame, year: str = "year", number: str = "number") -> DataFrame:
    return df.orderBy(F.col(year).desc(), F.col(number).desc())


def found(results: DataFrame, flag: bool = True) -> DataFrame:
    return results.where(F.col("exists") == flag)


def found_urls(results: DataFrame) -> DataFrame:
    return found(results).select("url")


def document_ids(results: DataFrame) -> DataFrame:
    return results.select("document_id")


def min_confidence(df: DataFrame, threshold: float) -> DataFrame:
    """Rows with enough confidence; a null confidence never qualifies."""
    return df.where(F.col("extraction_confidence") >= threshold)


def confident_articles(articles: DataFrame, threshold: float) -> DataFrame:
    return min_confidence(articles, threshold).orderBy(
        F.col("document_year").desc(), F.col("document_number").desc(), "article_index"
    )


def ranges_containing(ranges: DataFrame, type_: str, year: int, number: int) -> DataFrame:
    return where_equal(ranges, document_type=type_, year=year).where(
        (F.col("number_min") <= number) & (F.col("number_max") >= number)
    )


def ranges_touching(ranges: DataFrame, type_: str, year: int, number: int) -> DataFrame:
    return where_equal(ranges, document_type=type_, year=year).where(
        (F.col("number_min") <= number + 1) & (F.col("number_max") >= number - 1)
    )


def search(articles: DataFrame, query: str, content: Column | None = None) -> DataFrame:
    """Articles containing the query (ignoring case), with the number of occurrences."""
    body = F.lower(content if content is not None else F.col("content"))
    needle = query.lower()
    hits = (F.length(body) - F.length(F.replace(body, F.lit(needle), F.lit("")))) / F.lit(len(needle))
    return articles.where(body.contains(needle)).withColumn("n_hits", hits.cast("long"))
