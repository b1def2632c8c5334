"""Comparing aligned sources, in memory of the cluster or through written accounts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from weftable import classification as c
from weftable.operators.compare import compare_sources
from weftable.operators.convert import convert_currency
from weftable.schemas import COMPARISON_KEYS, Accounts
from weftable.sources.locate import list_sources
from weftable.sources.sinks import with_ids, write_account_csv, write_csv
from weftable.sources.tables import read_account_csv

# Emissions are no money and are never converted.
MONEY_ACCOUNTS = ("Z", "VA", "D")

Rates = Mapping[str, Column | float]


def _converted(account: str, source: str, df: DataFrame, rates: Rates) -> DataFrame:
    if account in MONEY_ACCOUNTS and source in rates:
        return convert_currency(df, rates[source], "^value$")
    return df


def compare_accounts(
    sources: Mapping[str, Accounts], rates: Rates | None = None
) -> dict[str, DataFrame]:
    """One comparison per account; ``rates`` names the sources to convert and by how much."""
    rates = rates or {}
    named = {source: accounts.by_name() for source, accounts in sources.items()}
    compared = {}
    for account, keys in COMPARISON_KEYS.items():
        parts = {
            source: _converted(account, source, with_ids(accounts[account], account), rates)
            for source, accounts in named.items()
            if account in accounts
        }
        if parts:
            compared[account] = compare_sources(parts, keys)
    return compared


def write_source(accounts: Accounts, folder: str, source: str) -> None:
    """Write the accounts of one source below the output folder."""
    for account, df in accounts.by_name().items():
        write_account_csv(df, f"{folder.rstrip('/')}/{source}", account)


def compare_folder(
    spark: SparkSession, folder: str, rates: Rates | None = None, write: bool = True
) -> dict[str, DataFrame]:
    """Compare every source written below ``folder``; the result goes there as well."""
    rates = rates or {}
    folder = folder.rstrip("/")
    sources = list_sources(spark, folder)
    compared = {}
    for account, keys in COMPARISON_KEYS.items():
        parts = {
            source: _converted(
                account,
                source,
                read_account_csv(spark, f"{folder}/{source}/{account}.csv", account),
                rates,
            )
            for source in sources
        }
        compared[account] = compare_sources(parts, keys)
        if write:
            write_csv(compared[account], f"{folder}/{c.COMPARISON_FOLDER}/{account}.csv")
    return compared
