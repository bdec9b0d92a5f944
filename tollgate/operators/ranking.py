"""Ordered ranking and paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Top-k report: Spark plans ``orderBy + limit`` as TakeOrderedAndProject
    (a per-partition heap of k rows, then a k-row merge), no full sort."""
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: list[Column], page_no: int, rows: int) -> DataFrame:
    """Page ``page_no`` (1-based) of ``rows`` rows under a total order."""
    return df.orderBy(*order).offset((page_no - 1) * rows).limit(rows)
