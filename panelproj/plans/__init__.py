from panelproj.plans.client_values import published_parameters
from panelproj.plans.delivery_run import Inputs, Parameters, run_delivery
from panelproj.plans.stages import StageStore, files_version
from panelproj.plans.whole_run import Lookups, RawSource, Result, whole_run

__all__ = [
    "Inputs",
    "Lookups",
    "Parameters",
    "RawSource",
    "Result",
    "StageStore",
    "files_version",
    "published_parameters",
    "run_delivery",
    "whole_run",
]
