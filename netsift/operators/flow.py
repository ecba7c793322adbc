"""Flow records: envelope -> named cells -> typed view, rejects, and back to a line.

All narrow projections: no shuffle, whole-stage codegen, and the same code on
batch and streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift import schemas
from netsift.functions.ipaddr import trim_sql

# cells the derived features read, with the type they must parse to
TYPED_CELLS = {"sp": "int", "dp": "int", "ipkt": "bigint", "opkt": "bigint", "ibyt": "double", "obyt": "double"}
# cells a feature cannot do without: a row failing one of these is a reject
REQUIRED_CELLS = ("dp", "ipkt", "opkt", "ibyt", "obyt")
# the cells of a record after those the header names
EXTRA_CELLS = "extra_cells"


def decode_value(df: DataFrame, column: str = "value") -> Column:
    """Envelope payload as UTF-8 text."""
    return F.col(column).cast("string")


def split_cells(line: Column, compat_trailing: bool = False) -> Column:
    """Split a record on commas.

    Spark's split keeps trailing empty cells. ``compat_trailing=True`` drops
    them, as a JVM ``String.split`` does, for byte-identical re-serialization
    of such lines.
    """
    if compat_trailing:
        line = F.regexp_replace(line, ",+$", "")
    return F.split(line, ",", -1)


def parse_flow(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    keep: Sequence[str] = ("key", "partition", "offset"),
    compat_trailing: bool = False,
    mode: str = "permissive",
) -> DataFrame:
    """Envelope rows -> one string column per cell, typed views, reject reason.

    Output: ``keep`` envelope columns, the raw cells by name (text kept as is,
    whitespace included; NULL where the record is too short), ``n_cells``,
    ``extra_cells`` (what follows the named cells, NULL if nothing does), typed
    ``*_n`` views of the numeric cells, ``reject_reason`` (NULL for a good row)
    and ``rejected_record`` (the text of a bad one). ``mode="strict"`` raises
    on the first bad row instead, as a failing record parse would, whichever
    columns are read.
    """
    columns = list(columns or schemas.flow_columns())
    keep = [c for c in keep if c in df.columns]
    missing = [c for c in REQUIRED_CELLS if c not in columns]
    if missing:
        raise ValueError(f"flow header lacks cells needed for features: {missing}")
    cells = split_cells(decode_value(df), compat_trailing)
    # The cells array is produced by a one-row Generate: filters on the parsed
    # cells (rejects, good rows) stop above it instead of being rewritten
    # into one more split of the record per referenced cell.
    parsed = df.select(*keep, decode_value(df).alias("_line"), F.explode(F.array(cells)).alias("_cells"))
    # wide projections as SQL text: one gateway call per column, same plan
    n = len(columns)
    raw = [f"get(_cells, {i}) AS `{name}`" for i, name in enumerate(columns)]
    extra = f"CASE WHEN size(_cells) > {n} THEN slice(_cells, {n + 1}, size(_cells) - {n}) END AS {EXTRA_CELLS}"
    typed = [f"try_cast({trim_sql(f'get(_cells, {columns.index(c)})')} AS {t}) AS `{c}_n`"
             for c, t in TYPED_CELLS.items() if c in columns]
    parsed = parsed.selectExpr(*[f"`{c}`" for c in keep], "_line", *raw, "size(_cells) AS n_cells", extra, *typed)
    checks = [f"WHEN `{c}_n` IS NULL THEN '{c} is not a number'" for c in REQUIRED_CELLS]
    reason = (f"CASE WHEN _line IS NULL THEN 'null record' WHEN n_cells < {n} "
              f"THEN 'fewer than {n} cells' {' '.join(checks)} END")
    parsed = parsed.withColumn("reject_reason", F.expr(reason))
    parsed = parsed.withColumn("rejected_record", F.expr("CASE WHEN reject_reason IS NOT NULL THEN _line END")).drop("_line")
    if mode == "strict":
        # a filter: column pruning cannot remove it
        parsed = parsed.filter(
            F.when(F.col("reject_reason").isNull(), F.lit(True)).otherwise(
                F.raise_error(F.concat(F.lit("bad flow record: "), "reject_reason")).cast("boolean")
            )
        )
    elif mode != "permissive":
        raise ValueError(f"unknown mode {mode!r}")
    return parsed


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull())


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull())


def whole_rows(parsed: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that have every named cell, whether or not the numbers in them parse."""
    return parsed.filter(F.col("n_cells") >= len(list(columns or schemas.flow_columns())))


def to_flow_line(df: DataFrame, columns: Sequence[str]) -> Column:
    """Cells -> one comma-joined line (P5/P6); numbers in JVM text form.

    Cells beyond the header (``extra_cells``) are written back in their place,
    before the derived ones; a NULL cell is an empty one, so positions hold.
    """
    def text(c: str) -> str:
        return f"coalesce(cast(`{c}` as string), '')"

    own = [text(c) for c in columns if c not in schemas.DERIVED_COLUMNS]
    extra = [EXTRA_CELLS] if EXTRA_CELLS in df.columns else []
    derived = [text(c) for c in columns if c in schemas.DERIVED_COLUMNS]
    return F.expr(f"concat_ws(',', {', '.join(own + extra + derived)})")


def select_cells(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pick cells by header name (P4); an unknown name fails at plan time."""
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"unknown flow columns: {unknown}")
    return df.select(*names)
