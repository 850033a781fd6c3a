"""DataFrame operators: joins, hierarchies, spatial joins, aggregation, ranking, sets."""

from grainframe.operators.hierarchy import ancestors, root_of, with_parent
from grainframe.operators.joins import (
    align,
    bridge,
    combine_facts,
    decode,
    drill_across,
    enrich,
    enrich_from_dim,
    has_match,
    keep_in,
    keep_not_in,
    link,
    link_all,
)
from grainframe.operators.measures import (
    additive,
    agg_by,
    agg_native,
    agg_of_agg,
    collect_label,
    count_keys,
    count_owners,
    count_rows,
    headline,
    latest,
    nest,
    nest_flat,
    pct_of_parent,
    pct_of_total,
    regrain,
    share_within,
    symmetric_measures,
    with_total,
)
from grainframe.operators.ordering import global_rank, row_id, running_total
from grainframe.operators.projection import apply_filter, replace_columns, select_hidden
from grainframe.operators.sets import topk, union_sides
from grainframe.operators.spatial import points_in_polygons
from grainframe.operators.windows import fill_periods, lagged, moving_avg, rank_entities, top_entities

__all__ = [
    "additive",
    "agg_by",
    "agg_native",
    "agg_of_agg",
    "align",
    "ancestors",
    "apply_filter",
    "bridge",
    "collect_label",
    "combine_facts",
    "count_keys",
    "count_owners",
    "count_rows",
    "decode",
    "drill_across",
    "enrich",
    "enrich_from_dim",
    "global_rank",
    "has_match",
    "fill_periods",
    "headline",
    "keep_in",
    "keep_not_in",
    "lagged",
    "latest",
    "link",
    "link_all",
    "moving_avg",
    "nest",
    "nest_flat",
    "pct_of_parent",
    "pct_of_total",
    "points_in_polygons",
    "rank_entities",
    "regrain",
    "replace_columns",
    "root_of",
    "row_id",
    "running_total",
    "select_hidden",
    "share_within",
    "symmetric_measures",
    "top_entities",
    "topk",
    "union_sides",
    "with_parent",
    "with_total",
]
