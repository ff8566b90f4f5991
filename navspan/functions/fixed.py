"""Values every result depends on."""

# Look-backs, calendar periods, row gates, scaling rungs, output names.
WINDOWS = (7, 14, 30, 91, 182, 365, 730, 1095, 0)
PERIODS = ("month", "quarter", "year")
CURRENT = "current"
WINDOWS_WITHOUT_VOLATILITY = (7, 14)
DEFAULT_MIN_POINTS = 12
VOLATILITY_MIN_ROWS = {
    "month": 12, "quarter": 12, "year": 12,
    0: 182, 30: 12, 91: 12, 182: 6, 365: 12, 730: 24, 1095: 36,
}
# key -> (rows needed, periods a year), finest first; key 0 counts rows per 182 rows held
SCALING_RUNGS = {
    "month": ((12, 365),),
    "quarter": ((36, 365), (12, 52)),
    "year": ((144, 365), (48, 52), (12, 12)),
    0: ((72, 365), (24, 52), (6, 12)),
    91: ((36, 365), (12, 52)),
    182: ((72, 365), (24, 52), (6, 12)),
    365: ((144, 365), (48, 52), (12, 12)),
    730: ((288, 365), (96, 52), (24, 12)),
    1095: ((432, 365), (144, 52), (36, 12)),
}
INCEPTION_ROWS_PER_STEP = 182
PERIOD_DAYS = {365: 365, 52: 7, 12: 30}
DAYS_PER_YEAR = 365
RISK_FREE = 0.015
FANOUT_PRODUCTS = ("P001", "P002")
REPORT_RETURNS = {
    "d7_returns": 7, "d14_returns": 14, "m1_returns": 30,
    "m3_returns": 91, "m6_returns": 182, "y1_returns": 365,
}
JDBC_WRITE_DEFAULTS = {"numPartitions": 100, "batchsize": 10000}

# Column names of a NAV table
PRODUCT = "prod_reg_code"
DATE = "date"
VALUE = "net_val"
