"""Refreshing metrics by new days, without reading the history again.

A state holds of each product its last rows (as many as the longest look-back needs, and all of the last calendar year with
the row before it), and a seed: what the rows before them come to since inception (their number, first row, lowest and
highest value, mean and deviation of the step returns, highest peak and deepest decline). New rows are computed behind
the state's rows, in the same windows as ever; what is known since inception goes on from the seed.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from navspan.functions.fixed import DATE, PRODUCT, VALUE, WINDOWS
from navspan.operators import declines, prepare, series
from navspan.operators.series import BEFORE, add, by_product, over, over_backwards, unless
from navspan.plans.registry import metric_keys, metrics

SEED = (
    "struct<rows: bigint, first_date: date, first_val: double, lowest: double, high: double, n: double, mean: double, m2: double, "
    "peak: array<double>, deep: array<double>>"
)
STATE = f"{PRODUCT} string, {DATE} date, {VALUE} double, _longest int, _seed {SEED}"


def _seeds(df, longest):
    """Rows with ``_seed`` as those after them need it, cut to the last ones."""
    style = declines.Style(detail=True)
    df = series.calendar_columns(add(df, declines.day_column()))
    df = series.unique_dates(add(df, {**series.neighbours(seeded=True), **series.place(over())}))
    df = add(df, series.step_return())
    high = f"greatest(max({VALUE}) {over(frame=BEFORE)}, _seed.high)"
    df = add(df, {**prepare.running_moments(), "_high_0": high, **declines.peak_column(0, "product", style, seeded=True)})
    df = declines.add_deepest(df, [0], style, seeded=True, keep=("_deep_0",))
    n, mean, m2 = prepare.merged_moments()
    seed = (
        f"named_struct('rows', bigint(_i), 'first_date', _first_date, 'first_val', _first_val, 'lowest', _lowest, 'high', _high_0, "
        f"'n', {n}, 'mean', {mean}, 'm2', {m2}, 'peak', _peak_0, 'deep', _deep_0)"
    )
    back = over_backwards()
    df = add(df, {"_here": seed, "_n": f"row_number() {back}", "_next": f"lag({DATE}) {back}", "_last": f"max({DATE}) {over_backwards('ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW')}"})
    df = df.where(f"_n <= {longest + 1} OR _next >= trunc(_last, 'YEAR')")
    return df.selectExpr(PRODUCT, DATE, VALUE, f"{longest} AS _longest", f"first(_here) OVER (PARTITION BY {PRODUCT} ORDER BY {DATE}) AS _seed")


def state_of(nav, longest=max(WINDOWS), partitions="session"):
    """The state after a whole series (product, date, value), for look-backs of up to ``longest`` rows: a table to store."""
    rows = by_product(nav.select(PRODUCT, DATE, VALUE), partitions).select("*", F.lit(None).cast(SEED).alias("_seed"))
    return _seeds(rows, longest)


def _joined(state, new, partitions):
    """Rows of the state and new ones, each with its product's seed and ``_new``."""
    rows = state.select(PRODUCT, DATE, VALUE, "_seed", F.lit(False).alias("_new"))
    rows = rows.unionByName(new.select(PRODUCT, DATE, VALUE, F.lit(None).cast(SEED).alias("_seed"), F.lit(True).alias("_new")))
    whole = Window.partitionBy(PRODUCT)
    rows = by_product(rows, partitions).select(
        PRODUCT, DATE, VALUE, "_new", F.first("_seed", ignorenulls=True).over(whole).alias("_seed"), F.max(F.when(~F.col("_new"), F.col(DATE))).over(whole).alias("_known"))
    return rows.filter(unless(f"_new AND {DATE} <= _known", problem="a new row that is not after the known ones,")).drop("_known")


def refreshed(state, new, names, windows=None, periods=None, partitions="session", **options):
    """``metrics`` of the rows of ``new`` alone, whose products go on from their state or begin; the history is not read.

    Equal to the same rows of a run over the whole series. New rows that are not later than all known ones of their
    product are an error, as are look-backs longer than those that the state was made for.
    """
    names = [names] if isinstance(names, str) else list(names)
    kept = state.agg(F.min("_longest")).first()[0]
    asked = max([k for name in names for k in metric_keys((options.get("own") or {}).get(name, name), windows, periods) if isinstance(k, int)], default=0)
    if kept is not None and asked > kept:
        raise ValueError(f"the state holds look-backs of up to {kept} rows, not {asked}")
    table = metrics(_joined(state, new, partitions), names, windows, periods, None, kept=("_new",), seeded=True, **options)
    return table.where("_new").drop("_new")


def next_state(state, new, longest=max(WINDOWS), partitions="session"):
    """The state after ``new``, as ``state_of`` of the whole series; products without new rows keep theirs."""
    return _seeds(_joined(state, new, partitions).drop("_new"), longest)
