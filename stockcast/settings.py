"""Defaults of the forecasting jobs. Every operator takes these as parameters."""

# Codes and tables that must match the source system.
NONE_TEXT = "None"
WHITESPACE = " \t\n\r\x0b\x0c"
SPECIAL_CUSTOMER = "0000000811"
SPECIAL_CUTOFF = "2025-02-02"
SPINE_START = "2025-02-02"
WAREHOUSE_CANDIDATES = ["warehousecode", "warehouse_code", "WarehouseCode", "WH_CODE"]
SKU_RENAMES = {
    "0000000811": {
        "Z236CT683AXHMXXX18": "Z236CT683AXHMTGX18",
        "Z236CT683HMXXXXX18": "Z236CT683HMTGXXX18",
        "Z236CT670VHMXXXX18": "Z236CT670VHMTGXX18",
        "Z236S290XXXXXXXX18": "Z236S290TGXXXXXX18",
        "Z234S17HMXXXXXXX11": "Z234S17HMTGXXXXX11",
        "Z236CT673HMXXXXX18": "Z236CT673HMTGXXX18",
        "Z236CT666NWHMXXX16": "Z236CT666NWHMTGX16",
        "Z235CT709HMXXXXX18": "Z235CT709HMTGXXX18",
        "Z236CT680AXHMXXX18": "Z236CT680AXHMTGX18",
        "Z231CT1700HMXXXX11": "Z231CT1700HMTGXX11",
        "Z220C11003H0000010": "Z220C11003H0400010",
        "Z236CT665HMXXXXX18": "Z236CT665HMTGXXX18",
        "Z236CT665NHMXXXX18": "Z236CT665NHMTGXX18",
        "Z227V00181XWH11000": "Z227V00181NWH01000",
        "Z227V00181XBL11000": "Z227V00181NBL01000",
        "Z227V00181XRO11000": "Z227V00181NRO01000",
        "Z220C13512X0000510": "Z220C13512X1100510",
        "Z220C10192X0000510": "Z220C10192X0100510",
        "Z220C9208XX0001010": "Z220C9208XX0201010",
        "Z220C9205XX0001010": "Z220C9205XX0101010",
        "Z220C9377XX0009000": "Z220C9377XX0209000",
        "Z220C9206XX0001010": "Z236MF6011HMXXXX11",
        "Z220C12531X1100510": "Z220C12531X2200510",
        "Z220C13440X0000010": "Z220C13440X1000010",
        "Z231CT1161XXXXXX11": "Z231CT1161ANXXXX11",
        "Z220C1032XX0300510": "Z220C1032XX0700510",
    },
}

# Holiday code -> the setting that turns it on or off.
HOLIDAY_TOGGLES = {
    "doubleday_peak": "use_doubleday_peak",
    "holiday": "use_public_holiday",
    "midmonth_dates": "use_midmonth_dates",
    "payday_dates": "use_payday_dates",
}

# Raw column -> canonical column, per source table type.
COLUMN_MAPS = {
    "gi": {"gi_date": "ds", "customercode": "customer_code", "sku": "Shop_SKU", "qty": "y"},
    "oms_order": {
        "order_date": "ds",
        "sendercode": "customer_code",
        "wh": "warehousecode",
        "sku": "Shop_SKU",
        "qty": "y",
        "paymentdate": "paymentdate",
    },
}

# Built-in settings, the last resort of the precedence rule.
ZSCORE_RULES = [(10, 2.5), (7, 2.0), (5, 1.5)]
DEFAULT_SETTINGS = {
    "lag_days": [1, 7],
    "rolling_mean_windows": [3],
    "impact_top_skus_n": 30,
    "impact_lower_window": 0,
    "impact_upper_window": 1,
    "impact_cv_band_low": 0.2,
    "impact_cv_band_high": 0.6,
    "promo_lower_window": 0,
    "promo_upper_window": 0,
    "prophet_weekly_seasonality": True,
    "prophet_daily_seasonality": True,
    "prophet_seasonality_mode": "multiplicative",
    "prophet_changepoint_prior_scale": 0.5,
    "prophet_changepoint_range": 0.1,
    "prophet_seasonality_prior_scale": 5.0,
    "use_promotions": True,
    "use_doubleday_peak": True,
    "use_public_holiday": True,
    "use_midmonth_dates": True,
    "use_payday_dates": True,
}
VOLUME_SHARE = 0.8
TEST_DAYS = 30
PERIODS = 14
PRODUCTION_DAYS = 14
BIAS_MIN_DEMAND = 5000.0
BIAS_MIN_DAYS = 180
SEED = 42
