from hazeline.plans.extract import Calls, CallsFailed, extract, fetch, fetch_and_transform
from hazeline.plans.ranking import rank_sql, rank_table, top_table
from hazeline.plans.rejects import AllRejected
from hazeline.plans.run import NoRun, Paths, committed, run_all
from hazeline.plans.stations import load_stations, load_stations_two_step
from hazeline.plans.transform import transform_forecasts, transform_observations

__all__ = [
    "AllRejected",
    "Calls",
    "CallsFailed",
    "NoRun",
    "Paths",
    "committed",
    "extract",
    "fetch",
    "fetch_and_transform",
    "load_stations",
    "load_stations_two_step",
    "rank_sql",
    "rank_table",
    "run_all",
    "top_table",
    "transform_forecasts",
    "transform_observations",
]
