"""Frame-level operators: positional projection, guards, de-duplication,
stacking. Each takes and returns a DataFrame so they chain with
``df.transform``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terrace.functions.columns import strip_space


def pick_by_position(df: DataFrame, positions: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Select columns by 0-based position and give them new names."""
    if len(positions) != len(names):
        raise ValueError(f"{len(positions)} positions but {len(names)} names")
    cols = df.columns
    missing = [p for p in positions if p >= len(cols)]
    if missing:
        raise ValueError(f"frame has {len(cols)} columns, positions {missing} are out of range")
    return df.select(*[F.col(f"`{cols[p]}`").alias(n) for p, n in zip(positions, names)])


def cells_by_position(cells: str | Column, positions: Sequence[int], names: Sequence[str]) -> list[Column]:
    """Columns picked out of an array of cell texts; NULL past the array end."""
    arr = F.col(cells) if isinstance(cells, str) else cells
    return [F.get(arr, F.lit(p)).alias(n) for p, n in zip(positions, names)]


def as_text(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Cast the given columns (default: all) to string, in place."""
    cols = set(df.columns if cols is None else cols)
    return df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c) for c in df.columns])


def trim_all(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Strip all leading/trailing white space from the string columns."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    cols = set(cols)
    return df.select(*[strip_space(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows where every given column is not NULL."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def drop_blank_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose given columns (default: all) are all NULL."""
    return df.na.drop(how="all", subset=list(subset) if subset else None)


def load_slice(df: DataFrame, load_date, date_col: str = "load_date") -> DataFrame:
    """One load batch. With the raw table partitioned by ``date_col`` this
    prunes to a single partition directory."""
    return df.filter(F.col(date_col) == F.lit(str(load_date)).cast("date"))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Exact full-row de-duplication (partial + final hash aggregate)."""
    return df.distinct()


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` values, ties
    broken by the remaining columns so the winner is deterministic.

    Written as a ``max`` over one struct of all non-key columns, the ordering
    columns first, not as a ``row_number`` window: the aggregate combines
    map-side, so a key holding a large share of the rows is reduced before
    the shuffle instead of being sorted in one task, and every column is
    carried once.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordering = list(order_by) + [c for c in rest if c not in order_by]
    out = df.groupBy(*keys).agg(F.max(F.struct(*ordering)).alias("_w"))
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_w.{c}").alias(c) for c in rest]).select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """Keys that occur more than once, with their row counts (NULL key parts
    included as values)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union-all by position; every frame must have the same width."""
    if not frames:
        raise ValueError("nothing to stack")
    out = frames[0]
    for f in frames[1:]:
        if len(f.columns) != len(out.columns):
            raise ValueError(f"cannot stack {len(f.columns)} columns onto {len(out.columns)}")
        out = out.union(f)
    return out


def observed(observation: Observation, otherwise: Callable[[], dict]) -> dict:
    """An observation's values; ``otherwise()`` when the plan that ran had no
    rows left to observe (adaptive execution replaces empty inputs and the
    observation goes with them)."""
    try:
        return dict(observation.get)
    except Py4JJavaError:
        return otherwise()


def lineage(path: str | Column) -> Column:
    """``./<parent folder>/<file name>`` from a file path or URI."""
    p = F.col(path) if isinstance(path, str) else path
    parts = F.split(F.regexp_replace(p, "/+$", ""), "/")
    return F.concat(F.lit("./"), F.array_join(F.slice(parts, -2, 2), "/"))


def file_name(path: str | Column) -> Column:
    """Last path segment."""
    p = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(p, "/"), -1)
