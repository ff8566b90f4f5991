"""The same results in plain SQL, by other means: frames are found by position and as-of joins and
then read out row by row, where the library runs windows.
"""

# Fixed values, stated here again: look-backs, and the rows that a volatility asks for.
WINDOWS = (7, 14, 30, 91, 182, 365, 730, 1095, 0)
VOLATILITY_ROWS = {
    "month": 12, "quarter": 12, "year": 12, 0: 182, 30: 12, 91: 12, 182: 6, 365: 12, 730: 24, 1095: 36,
}
CUSTOM_WINDOWS = (3, 21, 60)
POINT_DATE = "1996-06-28"
_CENTS = "cast(round({v} * 1e2) AS BIGINT)"
_PERIODS = ("month", "quarter", "year")
_VOLATILITY = tuple(w for w in WINDOWS if w not in (7, 14))


def _nav(key, date, amount, tables):
    cents = _CENTS.format(v=amount)
    return (
        f"SELECT {key} AS prod_reg_code, cast({date} AS DATE) AS date, "
        f"cast((2 * sum({cents}) + count({amount})) // (2 * count({amount})) AS DOUBLE) / 1e2 AS net_val "
        f"FROM {tables} GROUP BY 1, 2"
    )


SEGMENT = _nav("c_mktsegment", "o_orderdate", "o_totalprice", "orders JOIN customer ON o_custkey = c_custkey")
NATION = _nav(
    "n_name", "o_orderdate", "o_totalprice",
    "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
)
EVENTS = _nav("event_type", "ts", "value", "events")
SUPPLIERS = _nav("cast(l_suppkey AS VARCHAR)", "l_shipdate", "l_extendedprice", "lineitem")
PARTS = _nav("cast(l_partkey AS VARCHAR)", "l_shipdate", "l_extendedprice", "lineitem")


def _round(x, digits=4):
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits} + 0e0)"


def _text(date):
    return f"strftime({date}, '%Y-%m-%d')"


def _anchor(period, date):
    if period == "current":
        return f"cast({date} - INTERVAL 1 DAY AS DATE)"
    return f"cast(date_trunc('{period}', {date}) - INTERVAL 1 DAY AS DATE)"


def _rows(nav):
    """``r``: the series with position, previous row, age in days and step return."""
    return f"""nav AS ({nav}),
p AS MATERIALIZED (SELECT *, row_number() OVER w - 1 AS i, lag(date) OVER w AS pd, lag(net_val) OVER w AS pv,
  date - first_value(date) OVER w AS age FROM nav WINDOW w AS (PARTITION BY prod_reg_code ORDER BY date)),
r AS MATERIALIZED (SELECT *, (net_val - pv) / nullif(pv, 0) / (date - pd) AS x FROM p)"""


def _frames(keys, forward=False):
    """``f``: one row per row of ``r`` and key, with the position ``lo`` where its frame starts."""
    parts = []
    for key in keys:
        if isinstance(key, int):
            lo = "0" if key == 0 else f"greatest(i - {key}, 0)"
            parts.append(f"SELECT prod_reg_code, date, i, net_val, age, '{key}' AS k, {lo} AS lo FROM r")
        else:
            way = "<=" if forward else ">="
            parts.append(
                f"SELECT a.prod_reg_code, a.date, a.i, a.net_val, a.age, '{key}' AS k, coalesce(b.i, 0) AS lo "
                f"FROM r a ASOF LEFT JOIN r b ON a.prod_reg_code = b.prod_reg_code "
                f"AND {_anchor(key, 'a.date')} {way} b.date"
            )
    return "f AS MATERIALIZED (" + " UNION ALL ".join(parts) + ")"


def _wide(prefix, keys, column="y", source="o", more=()):
    """Long results to one column per key."""
    picks = [f"max(CASE WHEN k = '{k}' THEN {column} END) AS \"{prefix}_{k}D\"" for k in keys]
    for suffix, c in more:
        picks += [f"max(CASE WHEN k = '{k}' THEN {c} END) AS \"{prefix}_{k}D_{suffix}\"" for k in keys]
    return (
        f"SELECT prod_reg_code, {_text('date')} AS date, {', '.join(picks)} FROM {source} "
        "GROUP BY prod_reg_code, date"
    )


def _least(keys, zero, min_points=None):
    """Days or rows a key asks for; ``min_points`` for other look-backs than the usual ones."""
    def least(k):
        if isinstance(k, int) and k not in WINDOWS and min_points is not None:
            return min_points
        return k if isinstance(k, int) and k else zero

    return "(CASE k " + " ".join(f"WHEN '{k}' THEN {least(k)}" for k in keys) + " END)"


def _start(keys, forward=False):
    return f"""{_frames(keys, forward)},
s AS (SELECT f.*, b.date AS sd, b.net_val AS sv FROM f JOIN r b ON f.prod_reg_code = b.prod_reg_code AND f.lo = b.i)"""


_YEARLY = "(net_val - sv) / nullif(sv, 0) * (365e0 / nullif(date - sd, 0))"


def returns(nav, keys):
    return (
        f"WITH {_rows(nav)}, {_start(keys)}, o AS (SELECT *, {_round(_YEARLY)} AS y FROM s) "
        + _wide("Returns", keys)
    )


def _strict(nav, keys, min_points=None):
    least = _least(keys, 1, min_points)
    return f"""WITH {_rows(nav)}, {_start(keys, forward=True)},
o AS (SELECT *, CASE WHEN i - lo + 1 >= {least} AND date - sd >= {least}
  THEN {_round(_YEARLY, 6)} END AS y FROM s) """


def strict(nav, keys, min_points=None, prefix="Returns"):
    return _strict(nav, keys, min_points) + _wide(prefix, keys)


def strict_long(nav, keys):
    return _strict(nav, keys) + (
        f"SELECT prod_reg_code, {_text('date')} AS date, 'Returns_' || k || 'D' AS name, y AS value FROM o"
    )


def strict_positions(nav, keys):
    place = " ".join(f"WHEN '{k}' THEN {j}" for j, k in enumerate(keys))
    return _strict(nav, keys) + (
        "SELECT prod_reg_code, strftime(date, '%Y%m%d') AS date, "
        f"cast(CASE k {place} END AS INTEGER) AS position, 'Returns_' || k || 'D' AS name, y AS value FROM o"
    )


def counts(nav, keys, forward=False):
    return f"WITH {_rows(nav)}, {_frames(keys, forward)} " + _wide("Count", keys, "i - lo + 1", "f")


# key -> (days of a scaled step, periods a year)
_CODED = {
    "month": (365, 365), "quarter": (7, 52), 91: (7, 52),
    **{k: (30, 12) for k in ("year", 0, 182, 365, 730, 1095)},
}
# key -> rows for daily, weekly, monthly steps
_DOCUMENTED = {
    "month": (12,), 30: (12,), "quarter": (36, 12), 91: (36, 12), 182: (72, 24, 6), "year": (144, 48, 12),
    365: (144, 48, 12), 730: (288, 96, 24), 1095: (432, 144, 36),
}
# key -> (periods a year, rows from which a step is 7 days; 365 days before)
_CHAINED = {
    "month": (365, None), "quarter": (52, None), 91: (52, None), "year": (12, 48), 365: (12, 48),
    182: (12, 24), 730: (12, 96), 1095: (12, 144), 0: (12, 0),
}


def _scaling(keys, mode, daily=365):
    days, freq = [], []
    for key in keys:
        d, q = "1e0", f"{daily}e0"
        if mode == "coded" and key in _CODED:
            d, q = (f"{v}e0" for v in _CODED[key])
        elif mode == "chained" and key in _CHAINED:
            q, seven = f"{_CHAINED[key][0]}e0", _CHAINED[key][1]
            d = "365e0" if seven is None else f"(CASE WHEN n >= {seven} THEN 7e0 ELSE 365e0 END)"
        elif mode == "documented" and key in _DOCUMENTED:
            rungs = list(zip(_DOCUMENTED[key], (("1e0", "365e0"), ("7e0", "52e0"), ("30e0", "12e0"))))
            d = "(CASE " + " ".join(f"WHEN n >= {need} THEN {step[0]}" for need, step in rungs) + " END)"
            q = "(CASE " + " ".join(f"WHEN n >= {need} THEN {step[1]}" for need, step in rungs) + " END)"
        days.append(f"WHEN '{key}' THEN {d}")
        freq.append(f"WHEN '{key}' THEN {q}")
    # Daily steps: so many a year.
    freq = [q.replace("365e0", f"{daily}e0") for q in freq]
    return f"(CASE k {' '.join(days)} END)", f"(CASE k {' '.join(freq)} END)"


def _gate(keys, min_points):
    cases = " ".join(f"WHEN '{k}' THEN {VOLATILITY_ROWS.get(k, min_points)}" for k in keys)
    return f"n >= (CASE k {cases} END)"


def _volatility(nav, keys, mode="coded", min_points=12, forward=False, daily=365):
    """``o``: volatility ``std`` and scaled mean step ``step`` per row and key, null before the gate."""
    days, freq = _scaling(keys, mode, daily)
    gate = _gate(keys, min_points)
    return f"""WITH {_rows(nav)}, {_frames(keys, forward)},
m AS (SELECT f.prod_reg_code, f.date, f.k, any_value(f.i - f.lo + 1) AS n, stddev_samp(b.x) AS sd, avg(b.x) AS mean
  FROM f LEFT JOIN r b ON f.prod_reg_code = b.prod_reg_code AND b.i > f.lo AND b.i <= f.i GROUP BY ALL),
o AS (SELECT *, CASE WHEN {gate} THEN sd * {days} * sqrt({freq}) END AS std,
  CASE WHEN {gate} THEN mean * {days} END AS step FROM m) """


def volatility(nav, keys, mode="coded", min_points=12, daily=365):
    return _volatility(nav, keys, mode, min_points, daily=daily) + _wide("Volatility", keys, _round("std"))


def list_volatility(nav, keys, daily=365):
    return _volatility(nav, keys, "chained", forward=True, daily=daily) + _wide("Volatility", keys, _round("std", 6))


def steps(nav, keys):
    return _volatility(nav, keys) + _wide("Step", keys, _round("step", 6))


def sharpe(nav, keys, min_points=12, risk_free="15e-3"):
    ratio = _round(f"(step * 365e0 - {risk_free}) / nullif({_round('std')}, 0)")
    return _volatility(nav, keys, min_points=min_points) + _wide("Sharpe", keys, ratio)


def volatility_asof(nav):
    """For each product the 17th of every month with a row: frames end at the last row up to then."""
    keys = _VOLATILITY + _PERIODS
    days, freq = _scaling(keys, "chained")
    parts = []
    for key in keys:
        if isinstance(key, int):
            lo = "0" if key == 0 else f"greatest(i - {key}, 0)"
        else:
            lo = (f"(SELECT min(b.i) FROM r b WHERE b.prod_reg_code = e.prod_reg_code AND b.i <= e.i "
                  f"AND b.date >= {_anchor(key, 'e.end_date')})")
        parts.append(f"SELECT prod_reg_code, end_date, date, i, '{key}' AS k, {lo} AS lo FROM e")
    picks = [f"max(CASE WHEN k = '{k}' THEN {_round('std', 6)} END) AS \"Volatility_{k}D\"" for k in keys]
    return f"""WITH {_rows(nav)},
a AS (SELECT DISTINCT prod_reg_code, cast(date_trunc('month', date) + INTERVAL 16 DAY AS DATE) AS end_date FROM nav),
e AS MATERIALIZED (SELECT a.*, r.date, r.i FROM a ASOF LEFT JOIN r
  ON a.prod_reg_code = r.prod_reg_code AND a.end_date >= r.date),
f AS MATERIALIZED ({' UNION ALL '.join(parts)}),
m AS (SELECT f.prod_reg_code, f.end_date, f.date, f.k, any_value(f.i - f.lo + 1) AS n, stddev_samp(b.x) AS sd
  FROM f LEFT JOIN r b ON f.prod_reg_code = b.prod_reg_code AND b.i > f.lo AND b.i <= f.i GROUP BY ALL),
o AS (SELECT *, CASE WHEN {_gate(keys, 12)} THEN sd * {days} * sqrt({freq}) END AS std FROM m)
SELECT prod_reg_code, {_text('end_date')} AS end_date, {_text('date')} AS date, {', '.join(picks)}
FROM o GROUP BY prod_reg_code, end_date, date"""


def metrics_asof(nav, keys):
    """Of every row its metrics, then for the 17th of every month those of the last row up to then."""
    table = (f"SELECT * FROM ({returns(nav, keys)}) JOIN ({drawdown(nav, keys)}) USING (prod_reg_code, date) "
             f"JOIN ({calmar(nav, keys)}) USING (prod_reg_code, date)")
    picks = []
    for name in ("Returns", "Drawdown", "Calmer"):
        for key in keys:
            same = "true" if isinstance(key, int) else f"date_trunc('{key}', t.day) = date_trunc('{key}', a.end_date)"
            picks.append(f'CASE WHEN {same} THEN "{name}_{key}D" END AS "{name}_{key}D"')
    return f"""WITH a AS (SELECT DISTINCT prod_reg_code, cast(date_trunc('month', date) + INTERVAL 16 DAY AS DATE) AS end_date FROM ({nav})),
t AS MATERIALIZED (SELECT *, cast(date AS DATE) AS day FROM ({table}))
SELECT a.prod_reg_code, {_text('a.end_date')} AS end_date, t.date, {', '.join(picks)}
FROM a ASOF LEFT JOIN t ON a.prod_reg_code = t.prod_reg_code AND a.end_date >= t.day"""


def _declines(nav, keys, min_points=None):
    """``d``: per frame its deepest drop ``m`` (0 = none), gated by the product's age."""
    return f"""WITH {_rows(nav)}, {_frames(keys)},
e AS (SELECT f.prod_reg_code, f.date, f.k, f.i, f.lo, b.i AS j, b.date AS bd, b.net_val AS v,
  max(b.net_val) OVER (PARTITION BY f.prod_reg_code, f.k, f.i ORDER BY b.i) AS peak
  FROM f JOIN r b ON f.prod_reg_code = b.prod_reg_code AND b.i BETWEEN f.lo AND f.i
  WHERE f.age >= {_least(keys, 1, min_points)}),
d AS (SELECT prod_reg_code, date, k, i, lo, min((v - peak) / peak) AS m, arg_min(j, ((v - peak) / peak, j)) AS tj,
  arg_min(peak, ((v - peak) / peak, j)) AS top FROM e GROUP BY ALL) """


def max_drawdown(nav, keys, min_points=None):
    return _declines(nav, keys, min_points) + f""", o AS (SELECT r.prod_reg_code, r.date, d.k, d.m FROM r LEFT JOIN d
  ON r.prod_reg_code = d.prod_reg_code AND r.i = d.i) """ + _wide("Max_drawdown", keys, _round("m"))


def _dated(nav, keys):
    """``o``: declines with peak and trough date; without a drop first and last date of the frame."""
    return _declines(nav, keys) + """, o AS (SELECT r.prod_reg_code, r.date, d.k, d.m,
  CASE WHEN d.m < 0 THEN (SELECT min(b.date) FROM r b WHERE b.prod_reg_code = d.prod_reg_code
    AND b.i BETWEEN d.lo AND d.tj AND b.net_val = d.top)
  ELSE (SELECT b.date FROM r b WHERE b.prod_reg_code = d.prod_reg_code AND b.i = d.lo) END AS s,
  CASE WHEN d.m < 0 THEN (SELECT b.date FROM r b WHERE b.prod_reg_code = d.prod_reg_code AND b.i = d.tj)
  ELSE d.date END AS t
  FROM r LEFT JOIN d ON r.prod_reg_code = d.prod_reg_code AND r.i = d.i) """


def max_drawdown_detail(nav, keys):
    parts = [("value", _round("m")), ("s", _text("s")), ("t", _text("t")), ("drd", "cast(t - s AS INTEGER)")]
    picks = [
        f"max(CASE WHEN k = '{k}' THEN {sql} END) AS \"Max_drawdown_{k}D_{name}\"" for k in keys for name, sql in parts
    ]
    return _dated(nav, keys) + (
        f"SELECT prod_reg_code, {_text('date')} AS date, {', '.join(picks)} FROM o GROUP BY prod_reg_code, date"
    )


def max_drawdown_text(nav, keys):
    rounded = "round_even(m * 1e4, 0) / 1e4"
    sign = f"CASE WHEN m < 0 AND {rounded} = 0 THEN '-0.0' ELSE cast({rounded} AS VARCHAR) END"
    text = (f"{sign} || '(S:' || strftime(s, '%Y%m%d') || ',T:' || strftime(t, '%Y%m%d') "
            "|| ',DRD:' || cast(t - s AS VARCHAR) || ')'")
    picks = [
        f"coalesce(max(CASE WHEN k = '{k}' THEN {text} END), 'None(S:None,T:None,DRD:None)') AS \"Max_drawdown_{k}D\""
        for k in keys
    ]
    return _dated(nav, keys) + (
        f"SELECT prod_reg_code, {_text('date')} AS date, {', '.join(picks)} FROM o GROUP BY prod_reg_code, date"
    )


def calmar(nav, keys, min_points=None):
    ratio = f"{_round(_YEARLY)} / nullif(abs({_round('m')}), 0)"
    return _declines(nav, keys, min_points) + f""", o AS (SELECT f.prod_reg_code, f.date, f.k, f.net_val, b.date AS sd,
  b.net_val AS sv, d.m FROM f JOIN r b ON f.prod_reg_code = b.prod_reg_code AND f.lo = b.i
  LEFT JOIN d ON f.prod_reg_code = d.prod_reg_code AND f.i = d.i AND f.k = d.k) """ + _wide(
        "Calmer", keys, _round(ratio, 6)
    )


def _drawdown(nav, keys, min_points=None):
    return f"""WITH {_rows(nav)}, {_frames(keys)},
o AS (SELECT f.prod_reg_code, f.date, f.k, CASE WHEN any_value(f.age) >= any_value({_least(keys, 1, min_points)})
  THEN {_round('min((f.net_val - b.net_val) / nullif(b.net_val, 0))')} END AS y
  FROM f LEFT JOIN r b ON f.prod_reg_code = b.prod_reg_code AND b.i >= f.lo AND b.i < f.i
  GROUP BY f.prod_reg_code, f.date, f.k) """


def drawdown(nav, keys, min_points=None):
    return _drawdown(nav, keys, min_points) + _wide("Drawdown", keys)


def bundle(nav):
    every = WINDOWS + _PERIODS
    return f"""SELECT * FROM ({volatility(nav, _VOLATILITY + _PERIODS)}) JOIN ({counts(nav, every)})
USING (prod_reg_code, date) JOIN ({returns(nav, every + ('current',))}) USING (prod_reg_code, date)
JOIN ({drawdown(nav, every)}) USING (prod_reg_code, date)"""


def product_metrics(nav):
    names = ", ".join(f'"Volatility_{k}D"' for k in _VOLATILITY + _PERIODS)
    return f"""SELECT prod_reg_code, date, {names}, "Count_yearD" AS valuation_count,
"Returns_currentD" AS annualized_return, "Drawdown_yearD" AS drawdown FROM ({bundle(nav)})"""


def indicators(nav):
    every = WINDOWS + _PERIODS
    return f"""SELECT * FROM ({bundle(nav)}) JOIN ({sharpe(nav, _VOLATILITY + _PERIODS)}) USING (prod_reg_code, date)
JOIN ({max_drawdown(nav, every)}) USING (prod_reg_code, date) JOIN ({calmar(nav, every)}) USING (prod_reg_code, date)"""


def refreshed(nav, keys):
    """The metrics of the whole series at once."""
    parts = [returns(nav, keys), counts(nav, keys), volatility(nav, keys), max_drawdown(nav, keys), calmar(nav, keys), drawdown(nav, keys)]
    return f"SELECT * FROM ({parts[0]}) " + " ".join(f"JOIN ({p}) USING (prod_reg_code, date)" for p in parts[1:])


def _point(table):
    """Of each product the last row up to the date."""
    return f"""SELECT * FROM ({table}) WHERE date <= '{POINT_DATE}'
QUALIFY row_number() OVER (PARTITION BY prod_reg_code ORDER BY date DESC) = 1"""


def _stored_outer_join():
    some = f"SELECT * FROM ({SEGMENT}) WHERE prod_reg_code = 'BUILDING' UNION ALL {EVENTS}"
    return f"SELECT * FROM ({_outer_join()}) FULL JOIN ({drawdown(some, (30,))}) USING (prod_reg_code, date)"


def drawdown_ranges(nav):
    """Every pair of rows of a range, the lower one later: the deepest fall, its first trough, and the first of the
    highest rows before it."""
    return f"""WITH nav AS ({nav}),
m AS (SELECT DISTINCT prod_reg_code, cast(date_trunc('month', date) + INTERVAL 9 DAY AS DATE) AS start FROM nav),
q AS MATERIALIZED (SELECT prod_reg_code, start, start + n AS "end" FROM m, (VALUES (0), (30), (95), (400), (999)) AS t(n)),
e AS (SELECT q.*, b.date, b.net_val AS v, max(b.net_val) OVER (PARTITION BY q.prod_reg_code, q.start, q."end" ORDER BY b.date) AS peak
  FROM q JOIN nav b ON q.prod_reg_code = b.prod_reg_code AND b.date BETWEEN q.start AND q."end"),
d AS (SELECT prod_reg_code, start, "end", count(*) AS n, min(date) AS first, max(date) AS last, min((v - peak) / peak) AS m,
  arg_min(date, ((v - peak) / peak, date)) AS trough, arg_min(peak, ((v - peak) / peak, date)) AS top FROM e GROUP BY ALL),
o AS (SELECT d.*, CASE WHEN m < 0 THEN (SELECT min(e.date) FROM e WHERE e.prod_reg_code = d.prod_reg_code AND e.start = d.start
  AND e."end" = d."end" AND e.v = d.top AND e.date <= d.trough) ELSE first END AS s, CASE WHEN m < 0 THEN trough ELSE last END AS t FROM d)
SELECT q.prod_reg_code, {_text('q.start')} AS start, {_text('q."end"')} AS "end", {_round('m')} AS value, {_text('s')} AS s,
{_text('t')} AS t, cast(t - s AS INTEGER) AS drd, coalesce(n, 0) AS rows
FROM q LEFT JOIN o ON q.prod_reg_code = o.prod_reg_code AND q.start = o.start AND o."end" = q."end"
"""


def _outer_join():
    some = f"SELECT * FROM ({SEGMENT}) WHERE prod_reg_code = 'BUILDING' UNION ALL {EVENTS}"
    return f"""SELECT * FROM ({returns(SEGMENT, (30,))}) FULL JOIN ({counts(some, (30,))})
USING (prod_reg_code, date)"""


def _both():
    keys = _EVERY + ("current",)
    picks = _wide("Returns", keys, _round(_YEARLY), "s")
    return f"SELECT * FROM (WITH {_rows(NATION)}, {_start(keys)} {picks}) JOIN ({strict(NATION, keys, prefix='Strict')}) USING (prod_reg_code, date)"


def _ratio():
    frames = {0: "ROWS UNBOUNDED PRECEDING", 30: "ROWS 30 PRECEDING"}
    picks = [
        _round(f"net_val / max(net_val) OVER (PARTITION BY prod_reg_code ORDER BY date {frame})", 6) + f' AS "Ratio_{k}D"'
        for k, frame in frames.items()
    ]
    return f"WITH nav AS ({NATION}) SELECT prod_reg_code, {_text('date')} AS date, {', '.join(picks)} FROM nav"


def downside(nav, keys):
    return f"""WITH {_rows(nav)}, {_frames(keys)},
o AS (SELECT f.prod_reg_code, f.date, f.k, sqrt(avg(CASE WHEN b.x < 0 THEN b.x * b.x WHEN b.x >= 0 THEN 0 END)) AS y
  FROM f LEFT JOIN r b ON f.prod_reg_code = b.prod_reg_code AND b.i > f.lo AND b.i <= f.i GROUP BY ALL) """ + _wide(
        "Downside", keys, _round("y", 6))


def longest_rise(nav, keys):
    """Rows in a row that rise, up to each row; of a frame the most, cut at its first row that has a row before it."""
    return f"""SELECT * FROM (WITH {_rows(nav)}, {_frames(keys)},
g AS (SELECT *, i - max(CASE WHEN coalesce(net_val > pv, false) THEN -1 ELSE i END) OVER (PARTITION BY prod_reg_code ORDER BY i) AS run FROM r),
o AS (SELECT f.prod_reg_code, f.date, f.k, cast(max(least(b.run, b.i - greatest(f.i - cast(f.k AS INTEGER), -1))) AS INTEGER) AS y
  FROM f JOIN g b ON f.prod_reg_code = b.prod_reg_code AND b.i > f.i - cast(f.k AS INTEGER) AND b.i <= f.i GROUP BY ALL)
{_wide("Rise", keys)}) JOIN ({returns(nav, keys)}) USING (prod_reg_code, date)"""


def _average():
    """The weights of an exponential average: what is left out beyond 150 rows is below 1e-22 of it."""
    weight = "power(7e-1, a.i - b.i) * (CASE WHEN b.i > 0 THEN 3e-1 ELSE 1e0 END)"
    return f"""WITH {_rows(SEGMENT)} SELECT a.prod_reg_code, {_text('a.date')} AS date,
{_round(f'sum(b.net_val * {weight})', 6)} AS average
FROM r a JOIN r b ON a.prod_reg_code = b.prod_reg_code AND b.i BETWEEN a.i - 150 AND a.i GROUP BY a.prod_reg_code, a.date"""


def trailing_stop(nav):
    """Row after row of all products at once: whether it is held, and the best or worst value since that began."""
    edge = "CASE WHEN s.held THEN greatest(s.edge, p.net_val) ELSE least(s.edge, p.net_val) END"
    turned = f"(CASE WHEN s.held THEN 3 * p.net_val <= 2 * {edge} ELSE 3 * p.net_val >= 4 * {edge} END)"
    return f"""WITH RECURSIVE {_rows(nav)},
s AS (SELECT prod_reg_code, i, date, true AS held, net_val AS edge FROM p WHERE i = 0
  UNION ALL SELECT p.prod_reg_code, p.i, p.date, s.held <> {turned}, CASE WHEN {turned} THEN p.net_val ELSE {edge} END
  FROM s JOIN p ON p.prod_reg_code = s.prod_reg_code AND p.i = s.i + 1)
SELECT prod_reg_code, {_text('date')} AS date, held, edge FROM s"""


def _report():
    names = {7: "d7", 14: "d14", 30: "m1", 91: "m3", 182: "m6", 365: "y1"}
    picks = ", ".join(f'cast("Returns_{w}D" AS FLOAT) AS {n}_returns' for w, n in names.items())
    return f"""SELECT prod_reg_code, replace(date, '-', '') AS net_val_date, {picks}
FROM ({returns(SEGMENT, tuple(names))})"""


def _lookup(way):
    start = "first_value" if way == ">=" else None
    fallback = (
        ", (SELECT min(b.date) FROM nav b WHERE b.prod_reg_code = a.prod_reg_code) AS first_date" if start else ""
    )
    date = "coalesce(r.date, a.first_date)" if start else "r.date"
    return f"""WITH nav AS MATERIALIZED ({NATION}),
d AS (SELECT DISTINCT prod_reg_code, cast(date_trunc('month', date) + INTERVAL 16 DAY AS DATE) AS anchor FROM nav),
a AS (SELECT *{fallback} FROM d a),
o AS (SELECT a.prod_reg_code, a.anchor, {date} AS date FROM a ASOF LEFT JOIN nav r
  ON a.prod_reg_code = r.prod_reg_code AND a.anchor {way} r.date)
SELECT o.prod_reg_code, {_text('o.anchor')} AS anchor, {_text('o.date')} AS date, n.net_val
FROM o LEFT JOIN nav n ON o.prod_reg_code = n.prod_reg_code AND o.date = n.date"""


def _anchors():
    picks = []
    for p in _PERIODS + ("current",):
        anchor = _anchor(p, "date")
        picks.append(f"strftime({anchor}, '%Y%m%d') AS {p}_anchor, cast(date - {anchor} AS INTEGER) AS {p}_days")
    return f"SELECT prod_reg_code, {_text('date')} AS date, {', '.join(picks)} FROM ({NATION})"


def _per_day(pick):
    return f"""SELECT o_orderpriority AS prod_reg_code, {_text('cast(o_orderdate AS DATE)')} AS date,
{pick}(o_totalprice, o_orderkey) AS net_val FROM orders GROUP BY 1, 2"""


_EVERY = WINDOWS + _PERIODS

ORACLES = {
    "returns_windows": returns(SEGMENT, WINDOWS),
    "returns_periods": returns(NATION, _PERIODS + ("current",)),
    "returns_custom_windows": returns(NATION, CUSTOM_WINDOWS + ("current",)),
    "returns_short_history": returns(EVENTS, _EVERY + ("current",)),
    "returns_strict": strict(NATION, _EVERY + ("current",)),
    "returns_long": strict_long(NATION, _EVERY + ("current",)),
    "returns_nested": strict_positions(SEGMENT, _EVERY + ("current",)),
    "returns_output_schema": _report(),
    "valuation_count": counts(NATION, _EVERY),
    "valuation_count_range": counts(NATION, _EVERY + ("current",), forward=True),
    "volatility_windows": volatility(SEGMENT, _VOLATILITY),
    "volatility_periods": volatility(NATION, _PERIODS),
    "volatility_custom_windows": volatility(NATION, CUSTOM_WINDOWS, min_points=4),
    "volatility_documented": volatility(SEGMENT, _VOLATILITY + _PERIODS, "documented"),
    "volatility_list": list_volatility(NATION, _VOLATILITY + _PERIODS),
    "volatility_steps": steps(NATION, _VOLATILITY + _PERIODS),
    "step_returns": f"""WITH {_rows(NATION)} SELECT prod_reg_code, {_text('date')} AS date,
cast(date - pd AS INTEGER) AS days, {_round('(net_val - pv) / nullif(pv, 0)', 6)} AS change, {_round('x', 6)} AS step
FROM r""",
    "volatility_asof": volatility_asof(NATION),
    "metrics_asof": metrics_asof(NATION, (30, 182, 0) + _PERIODS),
    "sharpe": sharpe(SEGMENT, _VOLATILITY + _PERIODS),
    "max_drawdown_windows": max_drawdown(SEGMENT, WINDOWS),
    "max_drawdown_periods": max_drawdown(NATION, (0,) + _PERIODS + ("current",)),
    "max_drawdown_detail": max_drawdown_detail(SEGMENT, (30, 365, 0, "month", "year")),
    "max_drawdown_text": max_drawdown_text(SEGMENT, (91, "quarter")),
    "calmar": calmar(NATION, _EVERY),
    "drawdown_windows": drawdown(SEGMENT, WINDOWS),
    "drawdown_periods": drawdown(NATION, _PERIODS),
    "metrics_bundle": bundle(SEGMENT),
    "product_metrics": product_metrics(SEGMENT),
    "metrics_outer_join": _outer_join(),
    "stored_outer_join": _stored_outer_join(),
    "union_products": counts(f"{SEGMENT} UNION ALL {NATION} UNION ALL {EVENTS}", _EVERY),
    "point_metric": _point(volatility(NATION, (30,))),
    "point_period": f"""SELECT prod_reg_code, date, CASE WHEN date >= '1996-04-01' THEN "Returns_quarterD" END AS "Returns_quarterD"
FROM ({_point(strict(NATION, ("quarter",)))})""",
    "point_drawdown": _point(drawdown(SEGMENT, (91,))),
    "stored_volatility": _point(volatility(NATION, (30,))),
    "stored_calmar": _point(calmar(NATION, (182,))),
    "stored_drawdown": _point(drawdown(SEGMENT, (91,))),
    "drawdown_ranges": drawdown_ranges(NATION),
    "custom_metric": _ratio(),
    "refreshed": refreshed(NATION, (30, 365, 0) + _PERIODS),
    "downside_deviation": downside(NATION, (30, 91, 182)),
    "longest_rise": longest_rise(SEGMENT, (7, 30, 365)),
    "custom_group": _average(),
    "custom_state": trailing_stop(NATION),
    "constant_column": f"SELECT prod_reg_code, {_text('date')} AS date, net_val, 'CNY' AS currency, cast(NULL AS VARCHAR) AS note FROM ({SEGMENT})",
    "returns_both": _both(),
    "strict_return_custom": strict(NATION, CUSTOM_WINDOWS, min_points=2),
    "count_custom": counts(NATION, CUSTOM_WINDOWS),
    "sharpe_custom": sharpe(NATION, CUSTOM_WINDOWS, min_points=4),
    "max_drawdown_custom": max_drawdown(NATION, CUSTOM_WINDOWS, min_points=40),
    "calmar_custom": calmar(NATION, CUSTOM_WINDOWS, min_points=40),
    "drawdown_custom": drawdown(NATION, CUSTOM_WINDOWS, min_points=40),
    "volatility_daily_252": volatility(NATION, _VOLATILITY + _PERIODS, daily=252),
    "volatility_list_daily_252": list_volatility(NATION, _VOLATILITY + _PERIODS, daily=252),
    "sharpe_risk_free": sharpe(SEGMENT, (30, 365, "year"), risk_free="3e-2"),
    "supplier_returns": returns(SUPPLIERS, (30, 91, 182, 365) + _PERIODS + ("current",)),
    "supplier_volatility": volatility(SUPPLIERS, (30, 91, 182, 365) + _PERIODS),
    "part_max_drawdown": max_drawdown(PARTS, (7, 14, 30, 0) + _PERIODS),
    "part_calmar": calmar(PARTS, (7, 14, 30, 0) + _PERIODS),
    "part_bundle": bundle(PARTS),
    "all_indicators": indicators(PARTS),
    "asof_start": _lookup(">="),
    "forward_start": _lookup("<="),
    "period_anchors": _anchors(),
    "packed_parse": f"SELECT prod_reg_code, {_text('date')} AS date, net_val FROM ({NATION})",
    "packed_map": f"SELECT prod_reg_code, strftime(date, '%Y%m%d') AS date, net_val FROM ({NATION})",
    "packed_fanout": f"""SELECT p AS prod_reg_code, {_text('date')} AS date,
cast(floor(net_val) AS INTEGER) AS net_val FROM ({SEGMENT}), (VALUES ('P001'), ('P002')) AS t(p)""",
    "nav_normalize": f"""SELECT o_orderpriority AS prod_reg_code, {_text('cast(o_orderdate AS DATE)')} AS date,
o_totalprice AS net_val FROM orders WHERE o_orderstatus <> 'P'""",
    "nav_last_per_day": _per_day("arg_max"),
    "nav_first_per_day": _per_day("arg_min"),
    "nav_range": f"""SELECT prod_reg_code, {_text('date')} AS date, net_val FROM ({SEGMENT})
WHERE prod_reg_code = 'BUILDING' AND date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
    "nav_products": "SELECT DISTINCT n_name AS prod_reg_code FROM nation JOIN customer ON n_nationkey = c_nationkey "
                    "JOIN orders ON c_custkey = o_custkey",
}
