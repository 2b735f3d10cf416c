from hazeline.functions.coordinates import coordinate_text, is_coordinate, round_coordinate
from hazeline.functions.entries import any_value, opened_array, parse_json, whole_rows
from hazeline.functions.text import decode_line, split_fields

__all__ = [
    "any_value",
    "coordinate_text",
    "decode_line",
    "is_coordinate",
    "opened_array",
    "parse_json",
    "round_coordinate",
    "split_fields",
    "whole_rows",
]
