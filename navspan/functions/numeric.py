"""Arithmetic shared by the metrics: SQL expressions in, SQL expressions out. A zero base gives null,
never an error."""

from navspan.functions.dates import format_date
from navspan.functions.fixed import DAYS_PER_YEAR


def round_even(x, digits=4):
    """Half-even on the scaled double; keeps the sign of a small negative as -0.0."""
    scale = f"{10 ** digits}D"
    return f"rint(({x}) * {scale}) / {scale}"


def pct_change(value, base):
    return f"try_divide({value} - {base}, {base})"


def annualize(change, days):
    return f"{change} * try_divide({DAYS_PER_YEAR}D, {days})"


def python_text(x, digits=4):
    """A double of at most ``digits`` decimals as Python prints it: 0.0, -0.5, -0.0001."""
    text = f"regexp_replace(string(cast({x} AS decimal(38, {digits}))), '0+$', '')"
    return f"CASE WHEN string({x}) = '-0.0' THEN '-0.0' ELSE regexp_replace({text}, '[.]$', '.0') END"


def drawdown_text(drawdown):
    """Drawdown struct as ``value(S:start,T:trough,DRD:days)``, None for what is missing."""
    def part(sql):
        return f"coalesce({sql}, 'None')"

    return (
        f"concat({part(python_text(f'{drawdown}.value'))}, '(S:', {part(format_date(f'{drawdown}.s'))}, "
        f"',T:', {part(format_date(f'{drawdown}.t'))}, ',DRD:', {part(f'string({drawdown}.drd)')}, ')')"
    )
