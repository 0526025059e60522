"""The whole batch: standardised panels in, delivery table out.

Every stage's result is written to the shared folder on the way (combined panel, total
sample, priced projection, quarter). That cuts the lineage: after the loss of an executor
only the current stage is recomputed. With a `StageStore` the stages are kept, and a rerun
starts at the first one that is not done.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelproj.operators.delivery import DeliveryRules, format_delivery
from panelproj.operators.dims import build_universe, city_tier
from panelproj.operators.impute import knn_impute
from panelproj.operators.periods import (
    assemble_delivery,
    complete_quarter,
    growth_rollforward,
    moving_annual_total,
    self_rollforward,
)
from panelproj.operators.price import update_price
from panelproj.operators.project import project_nation, project_sample
from panelproj.operators.relational import union_strict
from panelproj.operators.standardize import combine_panels
from panelproj.plans.stages import StageStore
from panelproj.sources import materialize


@dataclass
class Inputs:
    panels: Sequence[DataFrame]  # canonical facts, one frame per source
    registry: DataFrame  # centres with size
    tiers: DataFrame  # raw city tiers
    master: DataFrame  # product master
    tenders: DataFrame
    rounds: DataFrame
    city_names: DataFrame
    history: DataFrame  # earlier deliveries
    external: DataFrame  # wide external panel
    second_channel: DataFrame | None = None


@dataclass
class Parameters:
    quarter: str
    target_cities: Sequence[str]
    impute_region: str
    impute_market: str
    missing_city: str
    proxy_city: str
    residual_molecule: str
    impute_column: str = "province"
    tier_order: Sequence[str] = ("city_tier",)
    exclude_donor_provinces: Sequence[str] = ()
    tcm_products: Sequence[str] = ()
    rules: DeliveryRules = field(default_factory=DeliveryRules)


def run_delivery(inputs: Inputs, params: Parameters, store: StageStore | None = None, after: Sequence[str] = ()) -> DataFrame:
    """Delivery rows: history, the completed quarter and its moving annual totals.

    `after` names what the inputs come from, in the store.
    """

    def step(name: str, build: Callable[[], DataFrame], *before: str) -> DataFrame:
        if store is None:
            return materialize(build(), name)
        return store.stage(name, build, (*after, *before), repr(params))

    def combined() -> DataFrame:
        # The run projects one quarter: centres that reported in it are its sample.
        return combine_panels(*[p.filter(F.col("quarter") == params.quarter) for p in inputs.panels])

    panel = step("panel", combined)

    def with_imputed() -> DataFrame:
        imputed = knn_impute(
            panel, target=params.impute_region, target_column=params.impute_column, market=params.impute_market
        )
        return union_strict(panel, imputed)

    sample = step("sample", with_imputed, "panel")

    def projected() -> DataFrame:
        universe = build_universe(sample, inputs.registry)
        everywhere = project_nation(
            project_sample(sample, universe),
            universe,
            city_tier(inputs.tiers, params.tier_order),
            exclude_provinces=params.exclude_donor_provinces,
        ).withColumn("channel", F.lit("CHC"))
        if inputs.second_channel is not None:
            everywhere = union_strict(everywhere, inputs.second_channel.filter(F.col("quarter") == params.quarter))
        return update_price(everywhere, sample)

    priced = step("priced", projected, "sample")

    def formatted() -> DataFrame:
        return format_delivery(
            priced,
            inputs.master,
            inputs.tenders,
            inputs.rounds,
            inputs.city_names,
            target_cities=params.target_cities,
            tcm_products=params.tcm_products,
            rules=params.rules,
        )

    rows = step("quarter", formatted, "priced")

    def completed() -> DataFrame:
        city = growth_rollforward(
            rows, inputs.history, inputs.external,
            missing_city=params.missing_city, proxy_city=params.proxy_city, quarter=params.quarter,
        )
        residual = self_rollforward(inputs.history, molecule=params.residual_molecule, quarter=params.quarter)
        return complete_quarter(rows, params.missing_city, city, residual)

    current = step("current", completed, "quarter")

    def assembled() -> DataFrame:
        mat = moving_annual_total(inputs.history, current, quarter=params.quarter)
        return assemble_delivery(inputs.history, current, mat)

    return assembled() if store is None else step("delivery", assembled, "current")
