"""Column helpers.  Each takes and returns ``Column`` and stays inside codegen."""

from grainframe.functions.arrays import (
    explode_list,
    has_tag,
    sort_desc,
    tag_map,
    tag_value,
)
from grainframe.functions.conditions import (
    age_bucket,
    band,
    calc_percent,
    case_map,
    generation,
    only_if,
    ratio,
    unless_sentinel,
)
from grainframe.functions.dates import (
    add_units,
    date_from_parts,
    day_name,
    day_of_week,
    fuzzy_date,
    holiday_label,
    julian_to_date,
    month_start,
    within_last,
    year_diff,
)
from grainframe.functions.geometry import (
    box_ring,
    in_ring,
    in_rings,
    ring_area,
    ring_bounds,
    ring_centroid,
    rings_area,
    rings_bounds,
    rings_centroid,
)
from grainframe.functions.strings import (
    capital_first,
    hash_color,
    regexp_group,
    root_domain,
    split_part,
    strip_flag,
)
from grainframe.functions.traits import combined_unit, register_trait, tag, traits

__all__ = [
    "combined_unit",
    "add_units",
    "age_bucket",
    "band",
    "box_ring",
    "calc_percent",
    "capital_first",
    "case_map",
    "date_from_parts",
    "day_name",
    "day_of_week",
    "explode_list",
    "fuzzy_date",
    "generation",
    "has_tag",
    "hash_color",
    "holiday_label",
    "in_ring",
    "in_rings",
    "julian_to_date",
    "month_start",
    "only_if",
    "ratio",
    "regexp_group",
    "register_trait",
    "ring_area",
    "ring_bounds",
    "ring_centroid",
    "rings_area",
    "rings_bounds",
    "rings_centroid",
    "root_domain",
    "sort_desc",
    "split_part",
    "strip_flag",
    "tag",
    "tag_map",
    "tag_value",
    "traits",
    "unless_sentinel",
    "within_last",
    "year_diff",
]
