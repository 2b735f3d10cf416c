from hazeline.operators.entries import (
    drop_terminator,
    entries_or_reasons,
    explode_responses,
    open_responses,
    parse_entries,
    repeat_entries,
    response_rejects,
    split_rejects,
)
from hazeline.operators.ranking import filter_parameter, rank_by_aqi, top_aqi
from hazeline.operators.requests import build_requests, split_locations
from hazeline.operators.stations import filter_states, project_locations, table_shape

__all__ = [
    "build_requests",
    "drop_terminator",
    "entries_or_reasons",
    "explode_responses",
    "filter_parameter",
    "filter_states",
    "open_responses",
    "parse_entries",
    "project_locations",
    "rank_by_aqi",
    "repeat_entries",
    "response_rejects",
    "split_rejects",
    "split_locations",
    "table_shape",
    "top_aqi",
]
