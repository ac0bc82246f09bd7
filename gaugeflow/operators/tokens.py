"""Token statistics over text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import pieces


def explode_tokens(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per token. Empty pieces go after the explode, where the test is compiled."""
    return df.select(*keep, F.explode(pieces(F.col(text))).alias("token")).filter(F.col("token") != "")


def token_frequency(df: DataFrame, text: str) -> DataFrame:
    """``(token, n)`` over whole texts. Tasks count locally first, so frequent tokens do not skew."""
    return explode_tokens(df, text).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def top_tokens(df: DataFrame, text: str, k: int) -> DataFrame:
    return token_frequency(df, text).orderBy(F.col("n").desc(), F.col("token").asc()).limit(k)


def token_association(df: DataFrame, text: str, category: str) -> DataFrame:
    """``(token, category, n, lift, pmi)``: how much more often a token occurs in a category than
    its overall frequency predicts (``pmi`` is log2 of the lift).

    The texts are tokenised once, down to one count per (token, category); totals derive from those
    counts, so all joins run on aggregated rows.
    """
    cells = (
        explode_tokens(df, text, F.col(category).alias("category"))
        .groupBy("token", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_token = cells.groupBy("token").agg(F.sum("n").alias("token_n"))
    by_category = cells.where("category is not null").groupBy("category").agg(F.sum("n").alias("category_n"))
    # few categories: their totals are one map, so cells are not shuffled on so uneven a key
    totals = by_category.agg(F.map_from_entries(F.collect_list(F.struct("category", "category_n")))).scalar()
    everything = cells.agg(F.sum("n").alias("total")).scalar()
    category_n = F.try_element_at(totals, F.col("category"))
    lift = F.col("n") * everything.cast("double") / (F.col("token_n").cast("double") * category_n)
    return (
        cells.where("category is not null")
        .join(by_token, "token")
        .select("token", "category", "n", lift.alias("lift"), F.log2(lift).alias("pmi"))
    )
