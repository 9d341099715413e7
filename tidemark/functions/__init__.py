from .versions import BEGINNING, MAX_VERSION, rv_to_hex, hex_to_rv, parse_version, format_version
from .defaults import null_default, with_default, fill_type_defaults
from .duration import format_duration
from .timefn import minute_boundaries, second_boundaries, boundaries_crossed, ts_literal
from .text import ordered_list, key_list_text, join_clause_text
