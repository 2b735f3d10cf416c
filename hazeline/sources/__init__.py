from hazeline.sources.entries import infer_entry_schema, scan_json_array, scan_json_lines
from hazeline.sources.landing import land_files, land_raw, list_source_files, scan_gz_text
from hazeline.sources.stations import scan_stations, scan_stations_raw, stations_from_rows
from hazeline.sources.tables import scan_table
from hazeline.sources.web import HttpTransport, Reply, fetch_responses

__all__ = [
    "HttpTransport",
    "Reply",
    "fetch_responses",
    "infer_entry_schema",
    "land_files",
    "land_raw",
    "list_source_files",
    "scan_gz_text",
    "scan_json_array",
    "scan_json_lines",
    "scan_stations",
    "scan_stations_raw",
    "scan_table",
    "stations_from_rows",
]
