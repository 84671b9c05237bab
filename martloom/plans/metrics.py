"""Daily transaction metrics in a base currency."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.operators.writes import first_per_key, merge_insert_only, upsert_last_wins

BASE_CURRENCY = 420
KEYS = ["date_update", "currency_from"]
# Partial sums of a part of a day, see ``day_state``.
STATE = "date_update date, currency_from int, account long, cnt long, amount_local decimal(29,0)"
COLUMNS = [
    "date_update", "currency_from", "amount_total", "cnt_transactions",
    "avg_transactions_per_account", "cnt_accounts_make_transactions", "load_dt", "load_src"]


def valid_transactions(transactions: DataFrame, loaded_after=None) -> DataFrame:
    """Finished transactions of real accounts, optionally only those loaded after a date."""
    valid = transactions.where("status = 'done' and account_number_from > 0")
    if loaded_after is None:
        return valid
    return valid.where(F.col("load_dt") > F.lit(loaded_after).cast("date").cast("timestamp_ntz"))


def day_state(transactions: DataFrame) -> DataFrame:
    """Mergeable partial sums of valid transactions: rows of ``STATE``.

    One row per account of a day and currency, so that distinct accounts stay exact when parts of a day are merged.
    The state has at most as many rows as there are transactions, however the account numbers are spread.
    """
    return (
        valid_transactions(transactions)
        .groupBy(F.to_date("transaction_dt").alias("date_update"), F.col("currency_code").alias("currency_from"),
                 F.col("account_number_from").alias("account"))
        .agg(F.count("operation_id").alias("cnt"),
             F.sum(F.col("amount").cast("decimal(19,0)")).cast("decimal(29,0)").alias("amount_local")))


def merged_days(state: DataFrame) -> DataFrame:
    """One row per (day, currency) from any number of partial sums, none of them twice."""
    return (
        state.groupBy(*KEYS, "account")
        .agg(F.sum("cnt").alias("cnt"), F.sum("amount_local").alias("amount_local"))
        .groupBy(*KEYS)
        .agg(F.sum("cnt").alias("cnt_transactions"), F.count(F.lit(1)).alias("cnt_accounts_make_transactions"),
             F.sum("amount_local").cast("decimal(29,0)").alias("amount_local")))


def daily_rates(currencies: DataFrame, base_currency: int) -> DataFrame:
    """Rate to the base per currency and day; the one loaded last if there are several."""
    to_base = currencies.where(F.col("currency_code_with") == base_currency).select(
        F.col("currency_code").alias("currency_from"), F.to_date("date_update").alias("date_update"),
        F.col("currency_with_div").alias("rate"), F.col("load_dt").alias("rate_load_dt"))
    return first_per_key(to_base, KEYS, [F.desc("rate_load_dt"), F.desc("rate")]).drop("rate_load_dt")


def daily_metrics(
    transactions: DataFrame, currencies: DataFrame, load_dt, base_currency: int = BASE_CURRENCY,
    loaded_after=None, base_as_one: bool = False,
) -> DataFrame:
    """Counts and sums per currency and day; days without a rate to the base are left out.

    ``base_as_one`` keeps the base currency itself, at rate 1.  The rates join
    the aggregate, not the transactions.
    """
    per_day = (
        valid_transactions(transactions, loaded_after)
        .groupBy(F.col("currency_code").alias("currency_from"), F.to_date("transaction_dt").alias("date_update"))
        .agg(F.count("operation_id").alias("cnt_transactions"),
             F.count_distinct("account_number_from").alias("cnt_accounts_make_transactions"),
             F.sum(F.col("amount").cast("decimal(19,0)")).alias("amount_local")))
    return in_base_currency(per_day, currencies, load_dt, base_currency, base_as_one)


def in_base_currency(
    per_day: DataFrame, currencies: DataFrame, load_dt, base_currency: int = BASE_CURRENCY, base_as_one: bool = False,
) -> DataFrame:
    """The mart's rows from sums per (day, currency)."""
    rates = daily_rates(currencies, base_currency)
    if base_as_one:
        base = per_day.where(F.col("currency_from") == base_currency).select(
            *[F.col(c) for c in ("currency_from", "date_update")],
            F.lit(1).cast("decimal(5,3)").alias("rate"))
        rates = rates.where(F.col("currency_from") != base_currency).unionByName(base)
    return per_day.join(rates, KEYS).select(
        "date_update", "currency_from",
        (F.col("amount_local") * F.col("rate")).cast("decimal(38,6)").alias("amount_total"),
        "cnt_transactions",
        (F.col("amount_local") / F.col("cnt_accounts_make_transactions"))
        .cast("decimal(38,6)").alias("avg_transactions_per_account"),
        "cnt_accounts_make_transactions",
        F.lit(load_dt).cast("timestamp_ntz").alias("load_dt"), F.lit("STG").alias("load_src"))


def merge_metrics(existing: DataFrame, fresh: DataFrame, mode: str = "insert") -> DataFrame:
    """Bring a run's metrics into the mart.

    ``insert`` keeps days that are already there; ``upsert`` replaces them.
    """
    if mode == "upsert":  # ``fresh`` holds whole days, see ``merged_days``
        return upsert_last_wins(existing, fresh, KEYS, ["load_dt"])
    return merge_insert_only(existing, fresh, KEYS, ["load_dt"])
