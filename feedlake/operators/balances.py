"""Balances of accounts from their postings: per month, and after every posting.

Amounts are whole numbers or decimals where sums have to be exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .paging import numbered, running_total

#: Postings of an account that one task puts in order.
BLOCK = 1 << 16


def account_balances(postings: DataFrame, account: str, day: str, amount: str) -> DataFrame:
    """``account, period_from, n_postings, balance_in, balance_change, balance_out`` for every month in which an account has postings.

    Postings are summed per account and month before anything is ordered, map-side first, so the running sum sees one row
    per month however many postings an account has. Postings without a day are in a null month before all others; a
    null account is an account; a null amount counts as nothing.
    """
    month = F.trunc(day, "MM").alias("period_from")
    sums = postings.groupBy(account, month).agg(F.count(F.lit(1)).alias("n_postings"), F.sum(F.coalesce(amount, F.lit(0))).alias("balance_change"))
    out = F.sum("balance_change").over(Window.partitionBy(account).orderBy("period_from"))
    return sums.withColumn("balance_out", out).select(
        account, "period_from", "n_postings", (F.col("balance_out") - F.col("balance_change")).alias("balance_in"), "balance_change", "balance_out"
    )


def running_balances(postings: DataFrame, account: str, order: Sequence[str], amount: str) -> DataFrame:
    """``postings`` with ``balance``, the sum of an account's amounts up to and with the posting, in ``order`` and then that of
    the other columns.

    Postings are dealt out by ranges of (account, order) and so get their place in the account; sums of blocks of places
    are carried from one block to the next. No task holds an account, were it a third of all postings. A null account is an account.
    """
    placed, _ = numbered(postings.withColumn("_amount", F.coalesce(amount, F.lit(0))), [account], [F.col(c) for c in order])
    placed = placed.withColumn("_account", F.struct(account))  # a struct is never null
    summed = running_total(placed, ["_account"], "_pos", "_amount", "_before", BLOCK)
    return summed.withColumn("balance", F.col("_before") + F.col("_amount")).select(*postings.columns, "balance")
