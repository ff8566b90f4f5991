"""Packed text series: ``yyyyMMdd^value`` entries joined by commas, one text per product.

Parsing stays inside the row: no shuffle, whole texts.
"""

from pyspark.sql import functions as F

from navspan.functions.dates import format_date, parse_date
from navspan.functions.fixed import DATE, FANOUT_PRODUCTS, PRODUCT, VALUE
from navspan.sources.nav import one_row_per_day

ENTRY_SEPARATOR = ","
VALUE_SEPARATOR = "^"


def _entry(text, position):
    """An entry's date and value: the sign stands after the eight digits, and nowhere else."""
    value = F.substring(text, 10, 1 << 20)
    good = (F.substring(text, 9, 1) == VALUE_SEPARATOR) & (F.instr(value, VALUE_SEPARATOR) == 0)
    message = F.concat(F.lit("not a date^value entry: "), text)
    key = F.when(good, F.substring(text, 1, 8)).otherwise(F.raise_error(message).cast("string"))
    return F.struct(key.alias("key"), position.alias("pos"), value.alias("text"))


def _latest_entries(df, text):
    """Column ``_entries``: sorted by date, of several entries of a date the last one in the text."""
    entries = F.sort_array(F.transform(F.split(text, ENTRY_SEPARATOR), _entry))
    df = df.select("*", entries.alias("_sorted"))
    following = F.slice(F.transform("_sorted", lambda e: e["key"]), 2, F.size("_sorted"))
    df = df.select("*", following.alias("_next"))
    paired = F.filter(
        F.arrays_zip(F.col("_sorted").alias("entry"), F.col("_next").alias("next")),
        lambda z: z["next"].isNull() | (z["next"] != z["entry"]["key"]),
    )
    kept = F.transform(paired, lambda z: z["entry"])
    return df.select("*", kept.alias("_entries")).drop("_sorted", "_next")


def parse_packed(df, product=PRODUCT, text="packed"):
    """NAV rows of packed texts, one row per date."""
    parsed = _latest_entries(df.select(F.col(product).alias(PRODUCT), F.col(text).alias("_text")), F.col("_text"))
    entry = parsed.select(PRODUCT, F.explode("_entries").alias("e"))
    return entry.selectExpr(PRODUCT, f"{parse_date('e.key')} AS {DATE}", f"double(e.text) AS {VALUE}")


def parse_packed_map(df, product=PRODUCT, text="packed"):
    """One row per text with a map from yyyyMMdd to value."""
    parsed = _latest_entries(df.select(F.col(product).alias(PRODUCT), F.col(text).alias("_text")), F.col("_text"))
    pairs = F.transform("_entries", lambda e: F.struct(e["key"], e["text"].cast("double")))
    return parsed.select(PRODUCT, F.map_from_entries(pairs).alias("nav"))


def fan_out(df, text="packed", products=FANOUT_PRODUCTS):
    """Every entry once for each of the given products, whole-number values, duplicates kept."""
    codes = F.array(*[F.lit(p) for p in products])
    entries = df.select(F.posexplode(F.split(F.col(text), ENTRY_SEPARATOR)).alias("pos", "token"))
    entries = entries.select(_entry(F.col("token"), F.col("pos")).alias("e"))
    entries = entries.select(F.explode(codes).alias(PRODUCT), "e")
    return entries.selectExpr(PRODUCT, f"{parse_date('e.key')} AS {DATE}", f"int(e.text) AS {VALUE}")


def pack(nav):
    """Packed text per product: the inverse of ``parse_packed``. A second row on a date is an error, found
    before the rows of a product meet."""
    nav = one_row_per_day(nav)
    entry = F.concat(F.expr(format_date(DATE)), F.lit(VALUE_SEPARATOR), F.col(VALUE).cast("string"))
    texts = F.transform(F.sort_array(F.collect_list(F.struct(F.col(DATE), entry.alias("e")))), lambda s: s["e"])
    return nav.groupBy(PRODUCT).agg(F.array_join(texts, ENTRY_SEPARATOR).alias("packed"))
