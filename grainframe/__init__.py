"""grainframe: grain-aware analytics on PySpark DataFrames.

Declare tables once (row-identifying columns, references between tables and
whether those references are partial or nullable) and compute with plain
``DataFrame -> DataFrame`` functions that keep totals right.
"""

from grainframe.catalog import Catalog, Dataset, Edge, Measure, star_select
from grainframe.session import build_session, cut_lineage, drop_scratch, scratch_path

__all__ = [
    "Catalog",
    "Dataset",
    "Edge",
    "Measure",
    "build_session",
    "cut_lineage",
    "drop_scratch",
    "scratch_path",
    "star_select",
]
