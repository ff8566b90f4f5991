"""Mean, deviation, maximum and deepest decline of sliding frames in O(log length) per row.

Spark's own sliding frame re-reads the whole frame for every row. Here a summary of ``radix**k`` rows
is merged from ``radix`` summaries of the level below, taken by ``lag``. Frames grow along with the
levels: at level ``k`` a frame takes as many summaries as its length has in that digit, so a row
carries one level and one summary per frame at a time. Every ``lag`` runs on the product window:
nothing is shuffled or sorted again.
"""

from collections.abc import Callable
from dataclasses import dataclass

from navspan.functions.fixed import VALUE
from navspan.operators.series import add, over


def _digits(number, radix):
    digits = []
    while number:
        number, digit = divmod(number, radix)
        digits.append(digit)
    return digits


class _Moments:
    """Count, mean and squared deviations of ``_x`` over the last N rows, merged without cancellation."""

    radix = 3
    fields = ("n", "mean", "m2")
    missing = "0D"

    def __init__(self, windows):
        self.digits = {n: _digits(n, self.radix) for n in windows}
        self.levels = max((len(d) for d in self.digits.values()), default=0)

    def leaf(self):
        return {"_mo_n": "if(_x IS NULL, 0D, 1D)", "_mo_mean": "coalesce(_x, 0D)", "_mo_m2": "0D"}

    def merges(self, k):
        """{target column: [("column" or lag)]} at level k, newest piece first."""
        size = self.radix ** k
        found = {}
        for n, digits in self.digits.items():
            if k < len(digits) and digits[k]:
                held = sum(d * self.radix ** j for j, d in enumerate(digits[:k]))
                pieces = [f"_frame_{n}"] if held else []
                found[f"_frame_{n}"] = pieces + [held + j * size for j in range(digits[k])]
        if k + 1 < self.levels:
            found["_mo"] = [j * size for j in range(self.radix)]
        return found

    def steps(self, target, pieces):
        def total(template):
            return " + ".join(template.format(p=p) for p in pieces)

        counts = total("{p}_n")
        mean = f"({total('{p}_n * {p}_mean')}) / greatest({counts}, 1D)"
        spread = total("{p}_n * pow({p}_mean - " + f"{mean}, 2D)")
        # The mean is written out, as Spark computes it once: a step of its own would write the wide row once more.
        return [{f"{target}_n": counts, f"{target}_mean": mean, f"{target}_m2": f"{total('{p}_m2')} + {spread}"}]

    def results(self):
        columns = {}
        for n in self.digits:
            rows = f"_frame_{n}_n"
            columns[f"_mean_{n}"] = f"if({rows} > 0, _frame_{n}_mean, NULL)"
            columns[f"_std_{n}"] = f"if({rows} > 1, sqrt(_frame_{n}_m2 / ({rows} - 1)), NULL)"
        return columns


class _Highest:
    """Highest value of the N rows before the current one. Pieces may overlap, so few are needed."""

    radix = 8
    fields = ("v",)
    missing = "NULL"

    def __init__(self, windows):
        self.top = {n: len(_digits(n, self.radix)) - 1 for n in windows}
        self.levels = max((t + 1 for t in self.top.values()), default=0)

    def leaf(self):
        return {"_hi_v": VALUE}

    def merges(self, k):
        size = self.radix ** k
        found = {}
        for n, top in self.top.items():
            if top == k:
                starts = list(range(0, n - size + 1, size))
                if starts[-1] < n - size:
                    starts.append(n - size)
                found[f"_high_{n}"] = [1 + s for s in starts]
        if k + 1 < self.levels:
            found["_hi"] = [j * size for j in range(self.radix)]
        return found

    def steps(self, target, pieces):
        values = [f"{p}_v" for p in pieces]
        merged = f"greatest({', '.join(values)})" if len(values) > 1 else values[0]
        return [{f"{target}_v": merged}]

    def results(self):
        return {f"_high_{n}": f"_high_{n}_v" for n in self.top}


class _Falls:
    """Deepest decline of the current row and the N before it, with ``detail`` its days.

    A run of rows has its highest and lowest value, of equals the earliest (``hi``, ``lo``, days ``hd`` and ``ld``), and the
    size of its deepest fall (``d``; 0 = none) with the trough's day, the peak's day and the peak (``t``, ``s``, ``ph``). Two
    neighbouring runs have a third fall between them, from the older one's highest to the newer one's lowest value.
    All are plain doubles: a row of arrays takes several times as long to pass from step to step.
    """

    radix = 3

    def __init__(self, windows, detail):
        self.detail = detail
        self.digits = {n: _digits(n + 1, self.radix) for n in windows}
        self.levels = max((len(d) for d in self.digits.values()), default=0)
        lowest, highest = "double('-Infinity')", "double('Infinity')"
        self.missing = {"hi": lowest, "lo": highest, "d": "0D"}
        if detail:
            self.missing.update({"hd": "0D", "ld": "0D", "t": "0D", "s": "0D", "ph": lowest})
        self.fields = tuple(self.missing)
        self.found = ("d", "t", "s") if detail else ("d",)

    def leaf(self):
        hi, lo = (f"coalesce({VALUE}, {self.missing[f]})" for f in ("hi", "lo"))
        values = {"hi": hi, "lo": lo, "d": "0D", "ph": hi}
        return {f"_fa_{f}": values.get(f, "_day") for f in self.fields}

    def merges(self, k):
        size, found = self.radix ** k, {}
        for n, digits in self.digits.items():
            if k < len(digits) and digits[k]:
                held = sum(d * self.radix ** j for j, d in enumerate(digits[:k]))
                pieces = [f"_fell_{n}"] if held else []
                target = f"_fell_{n}" if k + 1 < len(digits) else f"_deepest_{n}"
                found[target] = pieces + [held + j * size for j in range(digits[k])]
        if k + 1 < self.levels:
            found["_fa"] = [j * size for j in range(self.radix)]
        return found

    def spent(self, k):
        """Columns that no later level asks for."""
        return {f"_fell_{n}_{f}" for n, digits in self.digits.items() if len(digits) == k + 1 for f in self.fields}

    def steps(self, target, pieces):
        wanted = self.found if target.startswith("_deepest_") else self.fields
        if len(pieces) == 1:
            return [{f"{target}_{f}": f"{pieces[0]}_{f}" for f in wanted}]
        older, *newer = runs = pieces[::-1]
        values = self._values(runs)
        if not self.detail:
            return [{f"{target}_{f}": values[f] for f in wanted}]
        steps = [{f"{target}_between0": self._between(f"{older}_hi", newer[0])}]
        for i, piece in enumerate(newer):
            days, last = self._days(older, piece, f"{target}_between{i}"), piece is newer[-1]
            if last:
                steps.append({f"{target}_{f}": {**days, **values}[f] for f in wanted})
            else:
                older, merged = f"{target}_part{i}", {**days, **self._values(runs[:i + 2])}
                steps.append({f"{older}_{f}": merged[f] for f in self.fields})
                steps[-1][f"{target}_between{i + 1}"] = self._between(merged["hi"], newer[i + 1])
        return steps

    def _between(self, high, newer):
        return f"if({newer}_lo < {high} AND {high} > 0D, ({high} - {newer}_lo) / {high}, 0D)"

    def _values(self, runs):
        """Of runs from old to new, without a step between: what a query does not ask days of, computes none."""
        highs = [f"greatest({', '.join(f'{r}_hi' for r in runs[:i])})" if i > 1 else f"{runs[0]}_hi" for i in range(1, len(runs) + 1)]
        falls = [f"{r}_d" for r in runs] + [self._between(high, newer) for high, newer in zip(highs, runs[1:])]
        return {"hi": highs[-1], "lo": f"least({', '.join(f'{r}_lo' for r in runs)})", "d": f"greatest({', '.join(falls)})"}

    def _days(self, a, b, between):
        """Of equal falls the earliest trough's, of one trough's the one from the highest peak, then the earliest."""
        first = f"{between} > {b}_d OR ({between} = {b}_d AND ({b}_ld < {b}_t OR {a}_hi >= {b}_ph))"
        days = {"hd": f"if({a}_hi >= {b}_hi, {a}_hd, {b}_hd)", "ld": f"if({a}_lo <= {b}_lo, {a}_ld, {b}_ld)"}
        for f, across in (("t", f"{b}_ld"), ("s", f"{a}_hd"), ("ph", f"{a}_hi")):
            days[f] = f"CASE WHEN {a}_d >= {between} AND {a}_d >= {b}_d THEN {a}_{f} WHEN {first} THEN {across} ELSE {b}_{f} END"
        return days

    def results(self):
        columns = {f"_dd_{n}_m": f"0D - _deepest_{n}_d" for n in self.digits}
        columns.update({f"_dd_{n}_{f}": f"_deepest_{n}_{f}" for n in self.digits for f in self.found[1:]})
        return columns


@dataclass(frozen=True, eq=False)
class Monoid:
    """A user's aggregate over sliding frames, as SQL.

    ``lift`` {field: SQL over a row} is a row's summary, with the row's own columns, ``_x`` (its step return), ``_prev_val``
    and ``_prev_date``; ``empty`` {field: SQL} that of no rows. ``combine(a, b)`` gives {field: SQL} of two neighbouring runs
    of rows, a before b, whose fields are the columns ``{a}_field`` and ``{b}_field``; it must be associative, and may
    depend on the order. A frame of N is the current row and the N before it, with ``steps`` the last N rows, which hold
    the frame's N step returns.
    """

    name: str
    lift: dict[str, str]
    empty: dict[str, str]
    combine: Callable[[str, str], dict[str, str]]
    steps: bool = False

    def frame(self, window):
        """Prefix of the columns that hold the summary of a look-back."""
        return f"_frame_{self.name}_{window}"


class _Own:
    """The summaries of a monoid: pieces are two at a time, the older one first."""

    radix = 2

    def __init__(self, monoid, windows):
        self.monoid, self.fields, self.missing = monoid, tuple(monoid.lift), monoid.empty
        self.name = f"_own_{monoid.name}"
        self.digits = {n: _digits(n if monoid.steps else n + 1, 2) for n in windows}
        self.levels = max((len(d) for d in self.digits.values()), default=0)

    def leaf(self):
        return {f"{self.name}_{field}": sql for field, sql in self.monoid.lift.items()}

    def merges(self, k):
        size, found = 2 ** k, {}
        for n, digits in self.digits.items():
            if k < len(digits) and digits[k]:
                held = sum(d * 2 ** j for j, d in enumerate(digits[:k]))
                found[self.monoid.frame(n)] = ([self.monoid.frame(n)] if held else []) + [held]
        if k + 1 < self.levels:
            found[self.name] = [0, size]
        return found

    def steps(self, target, pieces):
        if len(pieces) == 1:
            return [{f"{target}_{f}": f"{pieces[0]}_{f}" for f in self.fields}]
        newer, older = pieces
        return [{f"{target}_{f}": sql for f, sql in self.monoid.combine(older, newer).items()}]

    def results(self):
        return {f"{self.monoid.frame(n)}_{f}": f"{self.monoid.frame(n)}_{f}" for n in self.digits for f in self.fields}


def _advance(df, kept, levels, k, beside):
    """One level of all summaries: one window of lags and the columns ``beside``, then the merges, in as many steps as they take."""
    lags, steps, spent = dict(beside), [], set()
    for name, summary in levels.items():
        missing = summary.missing if isinstance(summary.missing, dict) else dict.fromkeys(summary.fields, summary.missing)
        if isinstance(summary, _Falls):
            spent |= summary.spent(k)
        for target, pieces in summary.merges(k).items():
            columns = []
            for piece in pieces:
                column = piece
                if not isinstance(piece, str):
                    column = name if piece == 0 else f"{name}_lag{piece}"
                    if piece:
                        for f in summary.fields:
                            lags[f"{column}_{f}"] = f"lag({name}_{f}, {piece}, {missing[f]}) {over()}"
                columns.append(column)
            steps.append(summary.steps(target, columns))
    last = {column: sql for found in steps for column, sql in found[-1].items()}
    carried = [c for c in [*df.columns, *beside] if c in kept or c.startswith(("_frame_", "_high_", "_fell_", "_deepest_")) and c not in spent]
    df = add(df, lags)
    for i in range(max(len(found) for found in steps) - 1):
        df = add(df, {column: sql for found in steps if i < len(found) - 1 for column, sql in found[i].items()})
    return df.selectExpr(*[c for c in carried if c not in last], *[f"{sql} AS {name}" for name, sql in last.items()])


def add_sliding(df, moment_windows, high_windows, own=(), fall_windows=(), detail=False, beside=None):
    """Append ``_mean_N`` and ``_std_N`` of the last N step returns, ``_high_N`` of the N rows before, the frames of
    each (monoid, windows) of ``own``, and ``_dd_N_m``, with ``detail`` also ``_dd_N_t`` and ``_dd_N_s``, as
    ``declines.add_deepest`` does. Columns ``beside`` over the product window share that of the last level."""
    levels = {}
    if moment_windows:
        levels["_mo"] = _Moments(moment_windows)
    if high_windows:
        levels["_hi"] = _Highest(high_windows)
    if fall_windows:
        levels["_fa"] = _Falls(fall_windows, detail)
    for monoid, windows in own:
        summary = _Own(monoid, windows)
        levels[summary.name] = summary
    beside = beside or {}
    if not levels:
        return add(df, beside)
    kept = [*df.columns, *beside]
    results, leaves = {}, {}
    for summary in levels.values():
        leaves.update(summary.leaf())
        results.update(summary.results())
    df = add(df, leaves)
    last = max(s.levels for s in levels.values()) - 1
    for k in range(last + 1):
        df = _advance(df, kept, {n: s for n, s in levels.items() if k < s.levels}, k, beside if k == last else {})
    return df.selectExpr(*kept, *[f"{sql} AS {name}" for name, sql in results.items()])
