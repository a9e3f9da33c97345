"""SQL-callable forms of the reference's per-id routines.

The set-based DataFrame forms (one aggregate for every id at once) are the
ones to use in jobs; these register the same logic as Spark SQL temporary
functions for callers that look a single value up from SQL.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_stock_value(spark: SparkSession, view: str, name: str = "total_stock_value_of_category",
                         category_col: str = "p_type", price_col: str = "p_retailprice",
                         stock_col: str = "p_size") -> str:
    """``total_stock_value_of_category(category) -> DOUBLE`` over a registered view.

    Sum of price x stock of the category's products, computed exactly in
    decimal; NULL for a category without products (the set-based query
    reports those as 'missing').
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(category STRING) RETURNS DOUBLE
        RETURN (SELECT CAST(sum(CAST({price_col} AS DECIMAL(18,2)) * {stock_col}) AS DOUBLE)
                FROM {view} WHERE {category_col} = category)""")
    return name
