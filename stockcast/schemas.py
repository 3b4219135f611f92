"""Explicit schemas as DDL text; nothing in the jobs relies on schema inference."""

from stockcast.settings import DEFAULT_SETTINGS

DEMAND = "ds DATE, customer_code STRING, warehousecode STRING, Shop_SKU STRING, y DOUBLE"
ORDER_LOG = (
    "order_date DATE, sendercode STRING, wh STRING, sku STRING, qty DOUBLE, paymentdate TIMESTAMP"
)
SHIPMENT_LOG = (
    "gi_date STRING, customercode STRING, warehouse_code STRING, sku STRING, qty STRING"
)
HOLIDAY_SOURCE = "holiday_code STRING, ds STRING, lower_window INT, upper_window INT"
PROMOTION = (
    "customer_code STRING, promotion_name STRING, promotion_code STRING, start_date STRING,"
    " end_date STRING, apply_mode STRING, discount STRUCT<amount: DOUBLE, type: STRING>,"
    " include_sku ARRAY<STRUCT<sku_code: STRING, discount_amount: DOUBLE, discount_type: STRING>>"
)

_SETTING_TYPES = {list: "ARRAY<INT>", bool: "BOOLEAN", int: "INT", float: "DOUBLE", str: "STRING"}
SETTING_TYPES = {name: _SETTING_TYPES[type(value)] for name, value in DEFAULT_SETTINGS.items()}
CONFIG = (
    "customercode STRING, warehousecode STRING, "
    + ", ".join(f"{name} {kind}" for name, kind in SETTING_TYPES.items() if not name.startswith("promo_"))
    + ", is_active BOOLEAN, updated_at TIMESTAMP"
)
SCOPE = "customercode STRING, customername STRING, warehousecode STRING, warehousename STRING"
REQUEST = "customer_code STRING, warehousecodes ARRAY<STRING>"
PUBLISHED = "ds TIMESTAMP, customercode STRING, warehousecode STRING, Shop_SKU STRING, yhat BIGINT"

MODEL_BODY = (
    "mode STRING, first_ds STRING, last_ds STRING, span_days DOUBLE, y_scale DOUBLE, slope DOUBLE,"
    " level DOUBLE, change_at ARRAY<DOUBLE>, change_by ARRAY<DOUBLE>, weekly ARRAY<DOUBLE>,"
    " yearly ARRAY<DOUBLE>, holiday_effect MAP<STRING, DOUBLE>,"
    " regressors ARRAY<STRUCT<name: STRING, coef: DOUBLE, center: DOUBLE, scale: DOUBLE, last: DOUBLE>>,"
    " sigma DOUBLE, n_rows INT, daily_seasonality BOOLEAN, rounds INT, converged BOOLEAN"
)
MODEL_STORE = (
    "customer_code STRING, warehousecode STRING, Shop_SKU STRING, object_path STRING,"
    " model_json STRING, last_ds DATE, trained_at TIMESTAMP, run_id STRING"
)
