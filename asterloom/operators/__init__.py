"""DataFrame operators: cleaning, modelling, incremental loading, quality metrics."""

from asterloom.operators.clean import (
    clean,
    drop_column,
    keep_one,
    map_columns,
    rejects,
    require_columns,
    split_array,
    trim_columns,
)
from asterloom.operators.load import (
    LoadResult,
    incremental_append,
    ledger,
    load_once,
    new_rows,
    read_loads,
)
from asterloom.operators.model import (
    EntitySpec,
    FactSpec,
    build_fact,
    build_fact_from_arrays,
    date_dimension,
    entity_dimension,
    left_join_children,
    static_dimension,
)
from asterloom.operators.quality import (
    metrics_row,
    orphans,
    require_non_empty,
    row_count,
)

__all__ = [
    "EntitySpec",
    "FactSpec",
    "LoadResult",
    "build_fact",
    "build_fact_from_arrays",
    "clean",
    "date_dimension",
    "drop_column",
    "entity_dimension",
    "incremental_append",
    "keep_one",
    "ledger",
    "left_join_children",
    "load_once",
    "map_columns",
    "metrics_row",
    "new_rows",
    "orphans",
    "read_loads",
    "rejects",
    "require_columns",
    "require_non_empty",
    "row_count",
    "split_array",
    "static_dimension",
    "trim_columns",
]
