"""From raw exports to the delivery and its reports, as stages that are kept."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from panelproj.operators.audit import LookupAudit, cross_source_duplicates
from panelproj.operators.position import with_position
from panelproj.operators.review import duplicate_key_check, price_check_matrix, tender_coverage, uniformity_report
from panelproj.operators.standardize import FACT_KEYS, standardize_panel
from panelproj.plans.delivery_run import Inputs, Parameters, run_delivery
from panelproj.plans.stages import StageStore, files_version
from panelproj.sources import ingest

_TEXT = ("project", "quarter", "month", "province", "city", "county", "hospital_name", "atc4_code", "molecule_desc", "packcode")
_ORDER = ("project", "year", "quarter", "month", "province", "city", "county", "hospital_name", "atc4_code", "molecule_desc", "packcode", "volume", "price", "value")
RAW_SCHEMA = StructType([StructField(c, StringType() if c in _TEXT else IntegerType() if c == "year" else DoubleType()) for c in _ORDER])


@dataclass(frozen=True)
class RawSource:
    """Exports of one provider, in reading order, and how they are standardised (keyword arguments of `standardize_panel`)."""

    name: str
    paths: Sequence[str]
    charset: str = "GB18030"
    schema: StructType = field(default_factory=lambda: RAW_SCHEMA)
    rules: Mapping = field(default_factory=dict)


@dataclass(frozen=True)
class Lookups:
    """Reference data of a run. `version` tells its states apart, see `files_version`."""

    version: str
    places: DataFrame  # place, centre name -> pchc
    markets: DataFrame  # atc3, molecule -> market
    registry: DataFrame
    tiers: DataFrame
    master: DataFrame
    tenders: DataFrame
    rounds: DataFrame
    city_names: DataFrame
    history: DataFrame
    external: DataFrame


@dataclass(frozen=True)
class Result:
    delivery: DataFrame
    problems: Mapping[str, DataFrame]  # by source: cells that do not fit
    reports: Mapping[str, DataFrame]


def whole_run(store: StageStore, sources: Sequence[RawSource], lookups: Lookups, params: Parameters, tender_sheet: int = 2) -> Result:
    """Ingest each source by line position, standardise, combine, project, format, assemble and review.

    Every stage is published in the store under a key of its parameters and of all before it.
    """
    spark = store.manifest.spark
    store.source("lookups", lookups.version)
    facts, problems = [], {}
    for source in sources:
        store.source(f"files of {source.name}", files_version(spark, *source.paths))
        told = (source.charset, source.schema.json(), list(source.paths))
        read = cache(lambda s=source: ingest(spark, s.paths, s.schema, charset=s.charset))
        raw = store.stage(f"raw-{source.name}", lambda r=read: with_position(r().rows), [f"files of {source.name}"], told)
        problems[source.name] = store.stage(f"problems-{source.name}", lambda r=read: r().problems, [f"files of {source.name}"], told)

        def standard(raw: DataFrame = raw, rules: Mapping = source.rules) -> DataFrame:
            return standardize_panel(raw, lookups.places, lookups.markets, quarters=[params.quarter], **rules)

        facts.append(store.stage(f"facts-{source.name}", standard, [f"raw-{source.name}", "lookups"], [repr(sorted(source.rules.items())), params.quarter]))

    inputs = Inputs(
        facts, lookups.registry, lookups.tiers, lookups.master, lookups.tenders, lookups.rounds, lookups.city_names, lookups.history, lookups.external
    )
    delivery = run_delivery(inputs, params, store, ["lookups", *[f"facts-{s.name}" for s in sources]])
    reports = {
        "duplicates-of-sources": lambda: cross_source_duplicates(facts, FACT_KEYS),
        "uniformity": lambda: uniformity_report(delivery),
        "duplicate-keys": lambda: duplicate_key_check(delivery),
        "prices": lambda: price_check_matrix(delivery),
        "tenders": lambda: tender_coverage(lookups.tenders, delivery, sheet=tender_sheet),
        "lookups": lambda: _lookup_report(store, delivery, lookups),
    }
    kept = {name: store.stage(f"report-{name}", build, ["delivery"], tender_sheet) for name, build in reports.items()}
    return Result(delivery, problems, kept)


def _lookup_report(store: StageStore, delivery: DataFrame, lookups: Lookups) -> DataFrame:
    """What the lookups of names and packs do to the delivered rows."""
    audit = LookupAudit()
    named = audit.lookup(delivery.select("city", "packid"), lookups.city_names.select("city", "city_en"), ["city"], "city names")
    known = audit.lookup(named.select("city", "packid"), lookups.master.select("packid", "molecule"), ["packid"], "packs")
    known.write.format("noop").mode("overwrite").save()
    return audit.report(store.manifest.spark)
