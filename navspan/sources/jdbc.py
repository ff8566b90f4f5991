"""JDBC source and sink. Credentials and addresses come from the caller."""

from datetime import date, timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType

from navspan.functions.fixed import JDBC_WRITE_DEFAULTS
from navspan.sources.nav import normalize

#: How far from its rank a border between ranges may lie, as a share of the ranges' own.
_SLACK = 0.1
_CONNECTION = ("url", "table", "user", "password", "driver")


def _connection(config):
    missing = [k for k in ("url", "table") if not config.get(k)]
    if missing:
        raise ValueError(f"JDBC settings without {', '.join(missing)}")
    options = {k: config[k] for k in _CONNECTION if config.get(k) is not None}
    options["dbtable"] = options.pop("table")
    return options


def read_options(config):
    """Reader options. ``split`` = (column, lower, upper, partitions) reads in parallel ranges of even width, ``ranges``, a
    list of conditions (``even_ranges``), in those; one reader for the whole table takes an explicit ``single_reader``.

    Splitting on the date keeps the ranges even when one product holds most rows.
    """
    options = _connection(config)
    if sum(bool(config.get(way)) for way in ("split", "ranges", "single_reader")) != 1:
        raise ValueError("JDBC settings need one of split, ranges and single_reader")
    if config.get("split"):
        column, lower, upper, partitions = config["split"]
        options.update(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions)
        )
    if config.get("fetchsize"):
        options["fetchsize"] = str(config["fetchsize"])
    return options


def write_options(config):
    sizes = {k: str(config.get(k, default)) for k, default in JDBC_WRITE_DEFAULTS.items()}
    return {**_connection(config), **sizes, **({"truncate": "true"} if config.get("truncate") else {})}


def even_ranges(sample, column, partitions):
    """Conditions on a date or number column that cut a table into about as many rows each, by the quantiles of
    ``sample`` (the column of some or all rows). Every row meets one of them: the outer ranges are open, the first takes
    nulls. A value that many rows share makes one range, so there may be fewer than asked for.
    """
    kind = sample.schema[column].dataType
    is_date = isinstance(kind, DateType)
    if not is_date and not isinstance(kind, NumericType):
        raise ValueError(f"ranges need a column of dates or numbers, not {kind.simpleString()}")
    place = F.unix_date(column) if is_date else F.col(column).cast("double")
    shares = [i / partitions for i in range(1, partitions)]
    found = sample.select(place.cast("double").alias("x")).where("x IS NOT NULL").approxQuantile("x", shares, _SLACK / partitions) if shares else []

    def text(x):
        return f"'{date(1970, 1, 1) + timedelta(days=int(x))}'" if is_date else repr(int(x) if x == int(x) else x)

    borders = [text(x) for x in sorted(set(found))]
    if not borders:
        return ["1 = 1"]
    inner = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(borders, borders[1:])]
    return [f"{column} <= {borders[0]} OR {column} IS NULL", *inner, f"{column} > {borders[-1]}"]


def read_nav(spark, config):
    """NAV rows of a database table."""
    if config.get("ranges"):
        options = read_options(config)
        url, table = options.pop("url"), options.pop("dbtable")
        return normalize(spark.read.jdbc(url, table, predicates=list(config["ranges"]), properties=options))
    return normalize(spark.read.format("jdbc").options(**read_options(config)).load())


def write_metrics(df, config):
    """Write to a database table; overwrites unless ``mode`` says otherwise, with ``truncate`` without dropping it."""
    df.write.format("jdbc").options(**write_options(config)).mode(config.get("mode", "overwrite")).save()
