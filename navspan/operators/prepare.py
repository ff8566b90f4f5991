"""Frame columns that the metrics share, each computed once whatever the number of metrics.

A metric asks for parts by name:

``("start", N)``      first row of the look-back of N rows (0 = inception)
``("base", P)``       row before the period so far, its first row, and its number of rows
``("moments", K)``    mean and deviation of the step returns of the frame
``("inner", P)``      the same, of the steps that lie inside [period anchor, date]
``("high", K)``       highest value of the frame without the current row
``("decline", K)``    deepest decline with days
``("depth", K)``      deepest decline, value only
``(Monoid, N)``       a user's own summary of a look-back (``operators.sliding``)

Order matters for width: sliding frames come first, on rows that carry little else.
"""

from navspan.functions.dates import period_anchor
from navspan.functions.fixed import CURRENT, DATE, PERIODS, PRODUCT, VALUE
from navspan.functions.keys import is_window
from navspan.operators import declines, series, sliding
from navspan.operators.series import BEFORE, SO_FAR, add, over
from navspan.session import hold_methods


def prepare(nav, parts, outputs, partitions="session", kept=(), seeded=False):
    """NAV rows with the output columns, a list of (name, key, parts, SQL expression), and those ``kept``.

    An output is computed as soon as its parts are there, so that rows stay narrow and the generated
    code of one step stays small. ``seeded`` rows have a column ``_seed``, from which what is known since inception goes on.
    """
    hold_methods(nav.sparkSession)
    parts = _expand(parts)
    fall_keys = sorted({*_keys(parts, "decline"), *_keys(parts, "depth")}, key=_order)
    look_backs = [k for k in fall_keys if _slides(k)]
    # Where the run has levels of moments anyway, a row's worth of look-backs rides on them; else blocks look backwards.
    rides = bool(_windows(parts, "moments")) and len(look_backs) <= declines.GROUP
    fall_windows, riding = ([], look_backs) if rides else (look_backs, [])
    style = declines.Style(detail=bool(_keys(parts, "decline")))

    df = series.by_product(nav.select(PRODUCT, DATE, VALUE, *kept, *(["_seed"] if seeded else [])), partitions)
    if fall_keys:
        df = add(df, declines.day_column())
    if fall_windows:
        # The look backwards comes first, so the check does too; its sort serves the tails.
        df = series.unique_dates(add(df, series.place(series.over_backwards())))
    df = declines.add_tails(df, fall_windows, style)
    df = series.calendar_columns(df)
    if fall_windows:
        df = add(df, series.neighbours(seeded))
    else:
        df = series.unique_dates(add(df, {**series.neighbours(seeded), **series.place(over())}))
    own = {m.name: m for m, _ in parts if isinstance(m, sliding.Monoid)}
    if own or _keys(parts, "moments") or _keys(parts, "inner"):
        df = add(df, series.step_return())
    df = sliding.add_sliding(
        df, _windows(parts, "moments"), _windows(parts, "high"), [(m, _windows(parts, m)) for m in own.values()], riding, style.detail,
        _product_columns(parts, fall_keys, fall_windows, style, seeded))
    df = _emit(df, outputs, lambda key, kinds: _slides(key) and kinds <= {"moments", "high", *own.values()})
    for group in declines.groups(fall_windows):
        df = declines.add_deepest(df, group, style)
        df = _emit(df, outputs, lambda key, kinds: key in group)
    if seeded and ("moments", 0) in parts:
        df = add(df, since_inception())
    # Structs are slower to pass on than the numbers they are made of, so those of the declines come last.
    df = _emit(df, outputs, lambda key, kinds: is_window(key) and not kinds & ({"decline"} if key in riding else {"decline", "depth"}))
    for period in reversed(PERIODS):
        df = add(df, _period_columns(parts, period, fall_keys, style))
        df = _emit(df, outputs, lambda key, kinds: key == period and not kinds & {"decline", "depth"})
    for group in declines.groups([k for k in fall_keys if not _slides(k)]):
        df = declines.add_deepest(df, group, style, seeded)
        df = _emit(df, outputs, lambda key, kinds: key in group)
    return _emit(df, outputs, lambda key, kinds: True)


def _slides(key):
    return is_window(key) and key > 0


def _emit(df, outputs, ready):
    done = set(df.columns)
    return add(df, {
        name: sql for name, key, parts, sql in outputs
        if name not in done and ready(key, {kind for kind, _ in parts})
    })


def _order(key):
    """Look-backs by length, then inception, then periods."""
    return (not is_window(key), key == 0, key if is_window(key) else PERIODS.index(key))


def _windows(parts, kind):
    return [k for k in _keys(parts, kind) if _slides(k)]


def _keys(parts, kind):
    return [k for kind_, k in parts if kind_ is kind or kind_ == kind]


def _expand(parts):
    parts = set(parts)
    for kind, key in list(parts):
        if isinstance(kind, sliding.Monoid) and not _slides(key):
            raise ValueError(f"{kind.name} is a metric of look-backs; it has none for {key!r}")
        if kind in ("high", "decline", "depth", "moments", "inner") and key in PERIODS:
            parts.add(("base", key))
    return sorted(parts, key=lambda p: (getattr(p[0], "name", p[0]), _order(p[1])))


def _moments(name, x, part):
    window = over(part, SO_FAR)
    return {f"_mean{name}": f"avg({x}) {window}", f"_std{name}": f"stddev_samp({x}) {window}"}


def running_moments():
    """Number, mean and squared deviations of the step returns so far, without those of the seed."""
    w = over(frame=SO_FAR)
    return {"_run_n": f"double(count(_x) {w})", "_run_mean": f"coalesce(avg(_x) {w}, 0D)", "_run_m2": f"coalesce(var_pop(_x) {w} * count(_x) {w}, 0D)"}


def merged_moments():
    """The same with those of the seed: (n, mean, squared deviations)."""
    n = "(_run_n + coalesce(_seed.n, 0D))"
    delta = "(_run_mean - coalesce(_seed.mean, 0D))"
    mean = f"if({n} > 0D, (_run_n * _run_mean + coalesce(_seed.n * _seed.mean, 0D)) / {n}, 0D)"
    return n, mean, f"(_run_m2 + coalesce(_seed.m2, 0D) + if({n} > 0D, {delta} * {delta} * _run_n * coalesce(_seed.n, 0D) / {n}, 0D))"


def since_inception():
    n, mean, m2 = merged_moments()
    return {"_mean_0": f"if({n} > 0D, {mean}, NULL)", "_std_0": f"if({n} > 1D, sqrt({m2} / ({n} - 1D)), NULL)"}


def _product_columns(parts, fall_keys, fall_windows, style, seeded=False):
    columns = {}
    for n in sorted({*_windows(parts, "start"), *_windows(parts, "decline")}):
        if n not in fall_windows:
            columns.update(series.row_offset_start(n))
    if ("high", 0) in parts:
        columns["_high_0"] = f"max({VALUE}) {over(frame=BEFORE)}"
        if seeded:
            columns["_high_0"] = f"greatest({columns['_high_0']}, _seed.high)"
    if ("moments", 0) in parts:
        columns.update(running_moments() if seeded else _moments("_0", "_x", "product"))
    if 0 in fall_keys:
        columns.update(declines.peak_column(0, "product", style, seeded))
    return columns


def _period_columns(parts, period, fall_keys, style):
    columns = {}
    if ("base", period) in parts:
        first = over(period, SO_FAR)
        columns = {
            f"_base_prev_date_{period}": f"first(_prev_date) {first}",
            f"_base_prev_val_{period}": f"first(_prev_val) {first}",
            f"_base_own_date_{period}": f"first({DATE}) {first}",
            f"_base_own_val_{period}": f"first({VALUE}) {first}",
            f"_rows_{period}": f"count(1) {first}",
        }
    if ("moments", period) in parts:
        columns.update(_moments(f"_{period}", "_x", period))
    if ("inner", period) in parts:
        inside = f"if(_prev_date >= {period_anchor(DATE, period)}, _x, NULL)"
        columns.update(_moments(f"_inner_{period}", inside, period))
    if ("high", period) in parts:
        columns[f"_high_{period}"] = f"max({VALUE}) {over(period, BEFORE)}"
    if period in fall_keys:
        columns.update(declines.peak_column(period, period, style))
    return columns


def has_row_on_anchor(period):
    """Whether a row lies exactly on the day before the period."""
    return f"coalesce(_base_prev_date_{period} = {period_anchor(DATE, period)}, false)"


def _yesterday():
    return f"coalesce(_prev_date = {period_anchor(DATE, CURRENT)}, false)"


def start_row(key):
    """(date, value) of the frame's first row. Periods: the last row before, else their first row."""
    if key == 0:
        return "_first_date", "_first_val"
    if is_window(key):
        return f"_start_date_{key}", f"_start_val_{key}"
    if key == CURRENT:
        return f"coalesce(_prev_date, {DATE})", f"coalesce(_prev_val, {VALUE})"
    return tuple(f"coalesce(_base_prev_{f}_{key}, _base_own_{f}_{key})" for f in ("date", "val"))


def forward_row(key):
    """(date, value) of the first row on or after the anchor of the key."""
    if is_window(key):
        return start_row(key)
    if key == CURRENT:
        return tuple(f"if({_yesterday()}, {a}, {b})" for a, b in (("_prev_date", DATE), ("_prev_val", VALUE)))
    return tuple(
        f"if({has_row_on_anchor(key)}, _base_prev_{f}_{key}, _base_own_{f}_{key})" for f in ("date", "val")
    )


def frame_rows(key):
    """Rows of the frame, its start row included."""
    if key == 0:
        return "bigint(_i + 1)"
    if is_window(key):
        return f"bigint(least(_i, {key}) + 1)"
    rows, before = ("1", "_prev_date") if key == CURRENT else (f"_rows_{key}", f"_base_prev_date_{key}")
    return f"bigint({rows} + int({before} IS NOT NULL))"


def rows_in_range(key):
    """Rows dated from the key's anchor to the current date."""
    if is_window(key):
        return frame_rows(key)
    if key == CURRENT:
        return f"bigint(1 + int({_yesterday()}))"
    return f"bigint(_rows_{key} + int({has_row_on_anchor(key)}))"
