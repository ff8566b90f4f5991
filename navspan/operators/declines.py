"""Deepest peak-to-trough decline of many frames at once, O(1) per row and frame.

Frames that only grow (since inception, calendar periods) need a running peak and the running minimum
of the falls below it. A sliding frame of N + 1 rows is cut in two at the border of fixed blocks of
N + 1 rows: the tail of one block, summarised from the newest row backwards, and the head of the next,
summarised forwards. The answer is the deepest of the tail's, the one across, and the head's.

A running aggregate restarts at a border without a partition of its own: it is the maximum of an array
whose first element is the border's number, which only grows. So all frames share the product window.
Ties go to the earliest trough, then the earliest peak; a drop of 0 stands for none.

Summaries are arrays of doubles (days as numbers): passing one on takes little generated code, and a
method over 8000 bytecodes is not compiled by the JVM (``session.DEFAULTS`` has Spark split larger ones).
Frames are worked off ``GROUP`` at a time, which bounds the width of a row for long lists of windows. Look-backs of a run
that has levels of moments ride on those instead (``sliding``), without the look backwards.
"""

from dataclasses import dataclass

from navspan.functions.fixed import DATE, VALUE
from navspan.operators.series import ALL, SO_FAR, add, over, over_backwards, row_offset_start

GROUP = 8
_DAY = "_day"


def _item(array, position):
    return f"get({array}, {position})"


@dataclass(frozen=True)
class Style:
    """Whether a decline carries the days of its trough and peak or the drop alone."""

    detail: bool

    @property
    def fields(self):
        return ("m", "t", "s") if self.detail else ("m",)

    def highest(self, border, value, window):
        """Running maximum since the border, of equal values the earliest: (border, value, -day)."""
        day = f", -{_DAY}" if self.detail else ""
        return f"max(array({border}, {value}{day})) {window}"

    def fall(self, name, low, high, trough, peak):
        columns = {f"{name}_m": f"if({low} < {high} AND {high} > 0D, ({low} - {high}) / {high}, 0D)"}
        if self.detail:
            columns.update({f"{name}_t": trough, f"{name}_s": peak})
        return columns

    def deepest(self, border, name, high, window):
        """Running deepest of the falls ``name_*`` since the border: (border, -m, -t, high, -s). Drops to
        zero are equal from any peak, so of one trough's the highest peak comes first."""
        rest = f", -{name}_t, {high}, -{name}_s" if self.detail else ""
        return f"max(array({border}, -{name}_m{rest})) {window}"

    def unpack(self, name, deepest):
        positions = {"m": 1, "t": 2, "s": 4}
        return {f"{name}_{f}": f"-{_item(deepest, positions[f])}" for f in self.fields}


def groups(keys):
    return [keys[i:i + GROUP] for i in range(0, len(keys), GROUP)]


def add_tails(df, windows, style):
    """``_tail_N``: (m, v, t, s, day of v), the deepest decline and the highest value of the rows from the
    current one to the end of its block; null for a whole block, which its head covers."""
    if not windows:
        return df
    w = over_backwards(SO_FAR)
    df = add(df, {"_at": f"count(1) {over_backwards(ALL)} - row_number() {over_backwards()}"})
    df = add(df, {f"_block_{n}": f"floor(double(_at) / {n + 1}D) * 1D" for n in windows})
    for group in groups(windows):
        kept = df.columns
        extremes, falls, deepest, out = {}, {}, {}, {}
        for n in group:
            border = f"-_block_{n}"
            extremes[f"_low_{n}"] = style.highest(border, f"-{VALUE}", w)
            extremes[f"_high_{n}"] = style.highest(border, VALUE, w)
            low = f"_low_{n}"
            falls.update(style.fall(f"_fall_{n}", f"-{_item(low, 1)}", VALUE, f"-{_item(low, 2)}", _DAY))
            deepest[f"_deep_{n}"] = style.deepest(border, f"_fall_{n}", VALUE, w)
            found = style.unpack(n, f"_deep_{n}")
            items = [found[f"{n}_m"], _item(f"_high_{n}", 1)]
            if style.detail:
                items += [found[f"{n}_t"], found[f"{n}_s"], f"-{_item(f'_high_{n}', 2)}"]
            whole = f"_at = _block_{n} * {n + 1}D"
            out[f"_tail_{n}"] = f"if({whole}, NULL, array({', '.join(items)}))"
        df = add(add(add(df, extremes), falls), deepest)
        df = df.selectExpr(*kept, *[f"{sql} AS {name}" for name, sql in out.items()])
    return df


def day_column():
    return {_DAY: f"double(unix_date({DATE}))"}


def _seed(field, length, style):
    """An array of the seed, without the days where none are carried."""
    return f"_seed.{field}" if style.detail else f"slice(_seed.{field}, 1, {length})"


def peak_column(key, part, style, seeded=False):
    """Window column: running peak of a frame that starts with the partition, or that goes on from a seed."""
    highest = style.highest("0D", VALUE, over(part, SO_FAR))
    return {f"_peak_{key}": f"greatest({highest}, {_seed('peak', 2, style)})" if seeded else highest}


def _heads(n, style):
    """Window columns: running peak and low of each block, and the tail that starts the frame."""
    w = over(frame=SO_FAR)
    return {
        **row_offset_start(n),
        f"_peak_{n}": style.highest(f"_block_{n}", VALUE, w),
        f"_low_{n}": style.highest(f"_block_{n}", f"-{VALUE}", w),
        f"_old_{n}": f"lag(_tail_{n}, {n}) {over()}",
    }


def _top(key, style):
    """(columns, peak, peak's day) of the current row; a period's peak may be the row before it."""
    high, day = _item(f"_peak_{key}", 1), f"-{_item(f'_peak_{key}', 2)}" if style.detail else "0"
    if not isinstance(key, str):
        return {f"_top_{key}": high}, f"_top_{key}", day
    before = f"_base_prev_val_{key}"
    columns = {
        f"_top_{key}": f"greatest({high}, {before})",
        f"_border_{key}": f"double(unix_date(trunc({DATE}, '{key}')))",
    }
    if style.detail:
        base_day = f"double(unix_date(_base_prev_date_{key}))"
        columns[f"_top_day_{key}"] = f"if({before} >= {high}, {base_day}, {day})"
    return columns, f"_top_{key}", f"_top_day_{key}"


def _parts(key, style):
    """Falls of a look-back: across the border of its blocks, and in the tail before it."""
    low, old = f"_low_{key}", f"_old_{key}"
    columns = style.fall(
        f"_cross_{key}", f"-{_item(low, 1)}", _item(old, 1), f"-{_item(low, 2)}", _item(old, 4)
    )
    columns[f"_old_{key}_m"] = f"coalesce({_item(old, 0)}, 0D)"
    if style.detail:
        columns.update({f"_old_{key}_t": _item(old, 2), f"_old_{key}_s": _item(old, 3)})
    return columns


def _pick(key, style):
    """The deepest of a look-back's three falls; of equals the tail's, else the one across unless the
    head has a higher peak for the same trough."""
    old, cross, head = (f"_{part}_{key}" for part in ("old", "cross", "head"))
    least = f"least({old}_m, {cross}_m, {head}_m)"
    higher = f"{_item(f'_old_{key}', 1)} >= {_item(f'_deep_{key}', 3)}"
    first = f"({cross}_m < {head}_m OR {cross}_t < {head}_t OR {higher})"
    columns = {f"_dd_{key}_m": least}
    for f in style.fields[1:]:
        columns[f"_dd_{key}_{f}"] = (
            f"CASE WHEN {old}_m = {least} THEN {old}_{f} "
            f"WHEN {cross}_m = {least} AND {first} THEN {cross}_{f} ELSE {head}_{f} END"
        )
    return columns


def add_deepest(df, keys, style, seeded=False, keep=()):
    """Append ``_dd_K_m``, and days ``_dd_K_t`` and ``_dd_K_s``: the deepest decline of a group of keys,
    and the start rows of its look-backs; ``keep`` names columns of the way there that stay."""
    w = over(frame=SO_FAR)
    kept = df.columns
    heads, tops, falls, deepest, parts, out = {}, {}, {}, {}, {}, {}
    for key in keys:
        sliding = not isinstance(key, str) and key > 0
        columns, peak, peak_day = _top(key, style)
        tops.update(columns)
        border = f"_block_{key}" if sliding else "0D" if key == 0 else f"_border_{key}"
        falls.update(style.fall(f"_fall_{key}", VALUE, peak, _DAY, peak_day))
        deepest[f"_deep_{key}"] = style.deepest(border, f"_fall_{key}", peak, w)
        if seeded and key == 0:
            deepest["_deep_0"] = f"greatest({deepest['_deep_0']}, {_seed('deep', 2, style)})"
        parts.update(style.unpack(f"_head_{key}", f"_deep_{key}"))
        if sliding:
            heads.update(_heads(key, style))
            parts.update(_parts(key, style))
            out.update(_pick(key, style))
        else:
            out.update({f"_dd_{key}_{f}": f"_head_{key}_{f}" for f in style.fields})
    df = add(add(add(add(add(df, heads), tops), falls), deepest), parts)
    kept = [*kept, *keep]
    kept += [c for c in heads if c.startswith("_start_")]
    return df.selectExpr(*kept, *[f"{sql} AS {name}" for name, sql in out.items()])
