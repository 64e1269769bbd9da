"""From published files to lists: read, triage, check, rank, and write the document.

One folder holds the seven inputs, each in a folder of its own name (`INPUTS`). Reports, registry, statements and rates must be there; factsheets,
investor profiles and holdings are optional and count as empty where they are missing. A row that corrects another stands after it, in a
later file or further down, and the origin of rows is kept until the last of each key has been picked.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peervane.operators.dedup import last_per_key
from peervane.operators.triage import (
    assert_contract,
    assert_quarantine_within,
    clean_rows,
    quarantine,
    rejection_reason,
    triage,
)
from peervane.params import metrics_of
from peervane.plans.ranking import Inputs, Ranking, Settings, rank
from peervane.session import materialise
from peervane.sources import filings
from peervane.sources.documents import ranking_document, write_document
from peervane.sources.staged import read_or_empty, write_quarantine
from peervane.sources.text import ORIGIN

INPUTS = ("reports", "classes", "funds", "statements", "factsheets", "profiles", "holdings", "rates")
MAX_QUARANTINED = 0.05
REGISTRY = (
    "entity", "name", "grp", "manager", "classification", "status", "condominium", "exclusive", "target_investor", "long_term",
    "constituted", "holds_funds",
)
PRICED = ("entity", "ts", "price", "assets", "inflow", "outflow", "holders")
TERMS = ("entity", "ts", "fee", "redemption_days", "minimum_investment")
TERMS_SCHEMA = "entity string, ts date, fee double, redemption_days bigint, minimum_investment double"
HOLDERS_SCHEMA = "entity string, individuals double, distributors double"
HOLDINGS_SCHEMA = "src string, dst string, value double"


@dataclass(frozen=True)
class Run:
    judged: DataFrame
    inputs: Inputs
    ranking: Ranking
    document: DataFrame


def with_columns(frame: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The named columns; those that no release carries are null."""
    return frame.select(*[F.col(c) if c in frame.columns else F.lit(None).cast("string").alias(c) for c in names])


def judged_reports(spark: SparkSession, path, reference: dt.date) -> DataFrame:
    """The last row of every entity and day with its fate, stored."""
    rows = filings.read_daily_report(spark, path, with_origin=True)
    reason = rejection_reason(F.col("entity"), F.col("ts"), F.col("price"), F.col("assets"))
    judged = triage(rows, ["entity", "ts"], "ts", reason, reference, [F.col(c) for c in ORIGIN])
    return materialise(judged.drop(*ORIGIN), "judged")


def last_terms(frame: DataFrame) -> DataFrame:
    """One filing for each entity and day, the last in file order."""
    kept = last_per_key(frame, ["entity", "ts"], [F.col(c) for c in ORIGIN])
    return kept.select(*TERMS)


def loaded(spark: SparkSession, folder: str, judged: DataFrame) -> Inputs:
    """The seven inputs of a folder as the tables a ranking needs, with the clean rows of the reports."""
    at = {name: f"{folder.rstrip('/')}/{name}" for name in INPUTS}
    holdings = read_or_empty(spark, at["holdings"], filings.read_holdings, HOLDINGS_SCHEMA)
    factsheets = read_or_empty(
        spark, at["factsheets"], lambda s, p: last_terms(filings.read_factsheet(s, p, with_origin=True)), TERMS_SCHEMA
    )
    return Inputs(
        panel=clean_rows(judged).select(*PRICED),
        registry=materialise(with_columns(filings.read_registry(spark, at["classes"], at["funds"]), REGISTRY), "registry"),
        primary_terms=last_terms(filings.read_statement(spark, at["statements"], with_origin=True)),
        fallback_terms=factsheets,
        rates=materialise(filings.read_rates(spark, at["rates"]), "rates"),
        holdings=holdings,
        holders=read_or_empty(spark, at["profiles"], filings.read_investor_profile, HOLDERS_SCHEMA),
    )


def run(
    spark: SparkSession, folder: str, settings: Settings, reference: dt.date, target: str | None = None,
    max_quarantined: float = MAX_QUARANTINED,
) -> Run:
    """Rank what a folder of published files says as of a date.

    Stops with an error before anything is ranked when more than `max_quarantined` of the rows received are unusable, or when clean rows break
    the contract. With a target, rejected rows are written to `target`/quarantine, by reason, and the document, once checked, to `target`/document.
    """
    judged = judged_reports(spark, f"{folder.rstrip('/')}/reports", reference)
    if target is not None:
        write_quarantine(quarantine(judged), f"{target}/quarantine")
    assert_quarantine_within(judged, max_quarantined)
    inputs = loaded(spark, folder, judged)
    assert_contract(inputs.panel, "entity", "ts", "price", "assets", "holders")
    made = rank(inputs, settings, reference)
    document = ranking_document(
        made.listed, made.displaced, made.struck, made.weights, made.shares, made.scored, metrics_of(settings.profiles),
        reference, settings.months, made.start, settings.selection.top_n,
    )
    if target is not None:
        document = materialise(document, "document")
        write_document(document, f"{target}/document")
    return Run(judged, inputs, made, document)
