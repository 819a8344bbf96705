"""Row and cell level cleaning operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskpipe.functions.columns import as_double, col, present
from riskpipe.functions.missing import missing_cells
from riskpipe.operators.profile import modes
from riskpipe.operators.quantiles import quantile_rank, quantiles
from riskpipe.spec import DatasetSpec

QUARTILES = (0.25, 0.75)
SIEVE_BITS = 1 << 26  # of the bitmap that tells repeated rows; 8 MB


def drop_ids(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Drop the spec's id columns; absent ones are ignored."""
    return df.drop(*spec.drop)


def to_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Leniently cast the given columns that exist and are not double yet, in one projection.

    Filter before the cast, or a table that was written after it: a filter over very many casts,
    moved below them, makes the optimizer derive a constraint for every subset of the columns.
    """
    types = dict(df.dtypes)
    casts = {name: as_double(name) for name in present(df, cols) if types[name] != "double"}
    return df.withColumns(casts) if casts else df


def completeness_limit(n_columns: int, max_fraction: float = 0.5) -> int:
    """Missing cells a row may have: the fraction of its columns, rounded down."""
    return int(n_columns * max_fraction)


def drop_sparse_rows(
    df: DataFrame, max_fraction: float = 0.5, tokens: Sequence[str] = ("N/A", "")
) -> DataFrame:
    """Keep the rows in which at most the given fraction of the cells is missing."""
    limit = completeness_limit(len(df.columns), max_fraction)
    return df.filter(missing_cells(df, tokens) <= limit)


def medians(df: DataFrame, cols: Sequence[str], error: float = 0.01) -> dict[str, float]:
    found = quantiles(df, present(df, cols), [0.5], error)
    return {name: values[0] for name, values in found.items() if values}


def mode_values(
    df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = ("N/A",)
) -> dict[str, str]:
    """Most frequent value per column; a column without any value is left out."""
    cols = present(df, cols)
    if not cols:
        return {}
    # At most one row per column comes back.
    return {r["column_name"]: r["mode_value"] for r in modes(df, cols, tokens).collect()}


def fill_missing(
    df: DataFrame,
    numbers: Mapping[str, float],
    texts: Mapping[str, str],
    tokens: Sequence[str] = ("N/A",),
) -> DataFrame:
    """Replace null and NaN numbers, and null or token texts, by the values given per column."""
    if numbers:
        df = df.na.fill(dict(numbers))
    filled = {}
    for name, value in texts.items():
        cell = col(name)
        lacking = cell.isNull()
        if isinstance(df.schema[name].dataType, StringType):
            lacking = lacking | cell.isin(*tokens)
        value_typed = F.lit(value).cast(df.schema[name].dataType)
        filled[name] = F.when(lacking, value_typed).otherwise(cell)
    return df.withColumns(filled) if filled else df


def impute_median(df: DataFrame, cols: Sequence[str], error: float = 0.01) -> DataFrame:
    """Fill missing numbers with the column's median; an all-missing column stays as it is."""
    return fill_missing(df, medians(df, cols, error), {})


def impute_mode(
    df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = ("N/A",)
) -> DataFrame:
    """Fill null and token texts with the column's mode; empty text is a value and stays."""
    return fill_missing(df, {}, mode_values(df, cols, tokens), tokens)


def outlier_bounds(quartiles: Sequence[float], k: float = 1.5) -> tuple[float, float] | None:
    """Inclusive limits from two quartiles; None where there is no spread to judge by."""
    if len(quartiles) != 2:
        return None
    q1, q3 = quartiles
    spread = q3 - q1
    if not spread > 0:
        return None
    return q1 - k * spread, q3 + k * spread


def _within(name: str, bounds: tuple[float, float] | None) -> Column | None:
    return None if bounds is None else col(name).between(*bounds)


def outlier_conditions(
    df: DataFrame,
    cols: Sequence[str],
    k: float = 1.5,
    sequential: bool = True,
    error: float = 0.01,
) -> list[Column]:
    """The conditions that ``remove_outliers`` keeps rows by, in the order of the columns."""
    cols = present(df, cols)
    if sequential:
        found = sequential_quartiles(df, cols, k, error)
    else:
        found = quantiles(df, cols, QUARTILES, error)
    return [c for name in cols if (c := _within(name, outlier_bounds(found[name], k))) is not None]


def sequential_quartiles(
    df: DataFrame, cols: Sequence[str], k: float = 1.5, error: float = 0.01
) -> dict[str, list[float]]:
    """Each column's quartiles among the rows that the bounds of the columns before it keep.

    All columns are settled together.  Quartiles are guessed for all of them at once; one counting
    pass then tells, for every column, whether its guess holds among the rows that the guesses
    before it keep.  What holds up to the first column that does not is final, as nothing before
    it can move any more.  From that column on all are guessed anew, under the bounds found so far,
    so every round settles a column at least; a round costs the same few jobs however many columns
    there are.  With an ``error`` a guess holds as long as its rank is that near.
    """
    found = quantiles(df, cols, QUARTILES, error)
    open_cols = list(cols)[1:]  # nothing is filtered before the first
    while open_cols:
        kept = _kept_up_to(df, cols, found, k)
        held = _holds(kept, open_cols, found, error)
        first = next((i for i, name in enumerate(open_cols) if not held[name]), len(open_cols))
        open_cols = open_cols[first:]
        if open_cols:
            found |= quantiles(kept, open_cols, QUARTILES, error)
            open_cols = open_cols[1:]  # guessed under final bounds
    return found


def _kept_up_to(
    df: DataFrame, cols: Sequence[str], found: Mapping[str, Sequence[float]], k: float
) -> DataFrame:
    """The columns as numbers, each null where the bounds of a column before it drop the row."""
    dropped = F.lit(len(cols))
    for i, name in reversed(list(enumerate(cols))):
        condition = _within(name, outlier_bounds(found[name], k))
        if condition is not None:
            dropped = F.when(F.coalesce(condition, F.lit(False)), dropped).otherwise(i)
    at = "__dropped_at"
    numbers = df.select(*[as_double(name).alias(name) for name in cols], dropped.alias(at))
    return numbers.select(*[F.when(F.col(at) >= i, col(name)).alias(name) for i, name in enumerate(cols)])


def _holds(
    kept: DataFrame, cols: Sequence[str], found: Mapping[str, Sequence[float]], error: float
) -> dict[str, bool]:
    """Whether the quartiles of each column are those of its values, by exact counts."""
    wanted = []
    for i, name in enumerate(cols):
        value = F.nanvl(col(name), F.lit(None).cast("double"))
        wanted.append(F.count(value).alias(f"n{i}"))
        for j, quartile in enumerate(found[name]):
            wanted.append(F.count_if(value < quartile).alias(f"below{i}_{j}"))
            wanted.append(F.count_if(value <= quartile).alias(f"upto{i}_{j}"))
    counts = kept.agg(*wanted).first()

    def holds(i: int, name: str) -> bool:
        rows = counts[f"n{i}"]
        if not found[name] or not rows:
            return bool(found[name]) == bool(rows)
        slack = error * rows
        ranks = [quantile_rank(prob, rows) for prob in QUARTILES]
        return all(
            counts[f"below{i}_{j}"] - slack < rank <= counts[f"upto{i}_{j}"] + slack
            for j, rank in enumerate(ranks)
        )

    return {name: holds(i, name) for i, name in enumerate(cols)}


def remove_outliers(
    df: DataFrame,
    cols: Sequence[str],
    k: float = 1.5,
    sequential: bool = True,
    error: float = 0.01,
) -> DataFrame:
    """Keep rows whose values lie within ``k`` interquartile ranges of the quartiles.

    Sequentially, each column's quartiles are those of the rows the earlier columns left (see
    ``sequential_quartiles``).  With ``sequential=False`` all quartiles are taken from the input:
    a different, order-free result.
    """
    for condition in outlier_conditions(df, cols, k, sequential, error):
        df = df.filter(condition)
    return df


def drop_duplicate_rows(df: DataFrame, sieve_bits: int = SIEVE_BITS) -> DataFrame:
    """Keep one row of each set of equal rows.

    Digests are counted first, 16 bytes a row in place of the row.  Those met more than once set a
    bit each in a broadcast bitmap of at most ``sieve_bits`` bits.  Rows whose bit is not set have
    no equal and stay where they are; only the others are shuffled, and compared in full.  A bit
    that different digests share brings rows there for nothing, but changes no result.  ``df`` is
    read three times and must give the same rows each time.
    """
    digest, other = _digests(df)
    free = "__sieve"
    while any(name.lower().startswith(free) for name in df.columns):
        free += "_"
    cell, place, marks, key = (f"{free}_{part}" for part in ("cell", "place", "marks", "key"))
    repeated = (
        df.select(digest.alias("d"), other.alias("e"))
        .groupBy("d", "e")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.pmod("d", F.lit(sieve_bits)).alias("bit"))
    )
    sieve = repeated.groupBy(F.shiftright("bit", 6).alias(key)).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias(marks)
    )
    bit = F.pmod(digest, F.lit(sieve_bits))
    placed = {cell: F.shiftright(bit, 6), place: bit.bitwiseAND(F.lit(63)).cast("int")}
    marked = df.withColumns(placed).join(F.broadcast(sieve), F.col(cell) == F.col(key), "left")
    may_repeat = F.expr(f"coalesce((shiftrightunsigned({marks}, {place}) & 1) = 1, false)")
    rows = [col(name) for name in df.columns]
    single, several = marked.filter(~may_repeat).select(*rows), marked.filter(may_repeat).select(*rows)
    return single.unionAll(several.dropDuplicates())


def _digests(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a row, equal for equal rows."""
    cells = [col(name) for name in df.columns]
    return F.xxhash64(*cells), F.xxhash64(F.lit("second"), *cells)


def validate_schema(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """``(column_name, present, expected_type, actual_type)`` for the columns of the spec."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    expected = {name: "double" for name in spec.numeric}
    expected |= {name: "string" for name in spec.categorical}
    expected[spec.target] = spec.target_type
    rows = [(name, name in actual, want, actual.get(name)) for name, want in expected.items()]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, present boolean, expected_type string, actual_type string"
    )
