"""The series, tickers and limits that stored data and work lists are defined by."""

#: Prefix of the newer spelling of a series.
PREFIX = "KX"

#: Days in one request window, by candle minutes.
WINDOW_DAYS = {1: 3, 60: 30, 1440: 365}

#: Candles at which a page is full.
FULL_PAGE = 5_000

#: Series of the catalog.
SERIES = (
    "KXCPI", "KXCPIYOY", "KXACPI", "KXCPICORE", "KXPCECORE", "KXCPICOREYOY", "KXU3", "KXJOBLESS", "KXPAYROLLS",
    "KXGDP", "KXGDPYEAR", "KXRECSSNBER", "KXFEDDECISION", "KXFED", "KXFEDMEET",
)

#: Markets that live feeds follow.
FOCUS = (
    "KXFED-26SEP-T2.75", "KXFED-26SEP-T3.00", "KXFED-26SEP-T3.25", "KXFED-26SEP-T3.50", "KXFED-26SEP-T3.75",
    "KXFED-26SEP-T4.00", "KXFED-26SEP-T4.25", "KXFED-26SEP-T4.50",
    "KXFEDDECISION-26SEP-C25", "KXFEDDECISION-26SEP-C26", "KXFEDDECISION-26SEP-H0", "KXFEDDECISION-26SEP-H25", "KXFEDDECISION-26SEP-H26",
    "KXCPIYOY-26JUL-T3.2", "KXCPIYOY-26JUL-T3.3", "KXCPIYOY-26JUL-T3.4", "KXCPIYOY-26JUL-T3.5", "KXCPIYOY-26JUL-T3.6",
    "KXCPIYOY-26JUL-T3.7", "KXCPIYOY-26JUL-T3.8", "KXCPIYOY-26JUL-T3.9", "KXCPIYOY-26JUL-T4.0",
    "KXPAYROLLS-26AUG-T-25000", "KXPAYROLLS-26AUG-T0", "KXPAYROLLS-26AUG-T50000", "KXPAYROLLS-26AUG-T60000",
    "KXPAYROLLS-26AUG-T70000", "KXPAYROLLS-26AUG-T80000", "KXPAYROLLS-26AUG-T90000", "KXPAYROLLS-26AUG-T100000",
    "KXU3-26AUG-T3.9", "KXU3-26AUG-T4.0", "KXU3-26AUG-T4.1", "KXU3-26AUG-T4.2", "KXU3-26AUG-T4.3", "KXU3-26AUG-T4.4", "KXU3-26AUG-T4.5",
)

#: Volumes from which a market's hourly and minute candles are worth pulling: all time and last 30 days, last 30 days.
HOURLY_TOTAL, HOURLY_RECENT, MINUTE_RECENT = 1000, 100, 500

#: Title of a market whose template was never filled in.
TEMPLATE_TITLE = "above_below_between"

#: Seconds between refreshes of the live feeds.
CADENCE = {"minute": 60, "trades": 60, "orderbook": 60, "hourly": 900, "daily": 21_600}
