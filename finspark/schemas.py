"""Target table schemas, keys and NOT NULL columns (warehouse DDL, FIXTURES §B).

Fixed values: column names, types and keys must equal the target tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: tuple
    not_null: tuple
    lengths: dict = field(default_factory=dict)  # VARCHAR lengths by column


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, D, TS, I, L = T.StringType(), T.DateType(), T.TimestampNTZType(), T.IntegerType(), T.LongType()


def DEC(p, s):
    return T.DecimalType(p, s)


STOCK_PRICES = TableSpec("raw.stock_prices", _s(
    ("symbol", S), ("trade_date", D), ("open_price", DEC(18, 4)), ("high_price", DEC(18, 4)),
    ("low_price", DEC(18, 4)), ("close_price", DEC(18, 4)), ("adjusted_close", DEC(18, 4)),
    ("volume", L), ("source_system", S), ("extracted_at", TS)),
    key=("symbol", "trade_date", "source_system"), not_null=("symbol", "trade_date"),
    lengths={"symbol": 20, "source_system": 100})

COMPANY_FINANCIALS = TableSpec("raw.company_financials", _s(
    ("symbol", S), ("fiscal_period", S), ("fiscal_year", I), ("revenue", DEC(20, 2)),
    ("net_income", DEC(20, 2)), ("total_assets", DEC(20, 2)), ("total_liabilities", DEC(20, 2)),
    ("shareholders_equity", DEC(20, 2)), ("cash_flow_operating", DEC(20, 2)),
    ("cash_flow_investing", DEC(20, 2)), ("cash_flow_financing", DEC(20, 2)),
    ("source_system", S), ("extracted_at", TS)),
    key=("symbol", "fiscal_period", "fiscal_year", "source_system"),
    not_null=("symbol", "fiscal_period", "fiscal_year"),
    lengths={"symbol": 20, "fiscal_period": 20, "source_system": 100})

ECONOMIC_INDICATORS = TableSpec("raw.economic_indicators", _s(
    ("indicator_name", S), ("indicator_date", D), ("value", DEC(18, 6)), ("unit", S),
    ("country", S), ("source_system", S), ("extracted_at", TS)),
    key=("indicator_name", "indicator_date", "country", "source_system"),
    not_null=("indicator_name", "indicator_date"),
    lengths={"indicator_name": 100, "unit": 50, "country": 3, "source_system": 100})

MARKET_NEWS = TableSpec("raw.market_news", _s(
    ("news_id", S), ("headline", S), ("summary", S), ("content", S), ("published_at", TS),
    ("source", S), ("symbols", S), ("sentiment_score", DEC(5, 4)), ("extracted_at", TS)),
    key=("news_id",), not_null=("headline",), lengths={"news_id": 255, "source": 255, "symbols": 500})

CRYPTO_PRICES = TableSpec("raw.cryptocurrency_prices", _s(
    ("symbol", S), ("trade_timestamp", TS), ("price_usd", DEC(18, 8)), ("volume_24h", DEC(20, 2)),
    ("market_cap", DEC(20, 2)), ("percent_change_24h", DEC(8, 4)), ("source_system", S),
    ("extracted_at", TS)),
    key=("symbol", "trade_timestamp", "source_system"), not_null=("symbol", "trade_timestamp"),
    lengths={"symbol": 20, "source_system": 100})

DAILY_STOCK_ANALYTICS = TableSpec("analytics.daily_stock_analytics", _s(
    ("symbol", S), ("trade_date", D), ("open_price", DEC(18, 4)), ("high_price", DEC(18, 4)),
    ("low_price", DEC(18, 4)), ("close_price", DEC(18, 4)), ("volume", L),
    ("daily_return", DEC(10, 6)), ("volatility_20d", DEC(10, 6)), ("moving_avg_20d", DEC(18, 4)),
    ("moving_avg_50d", DEC(18, 4)), ("moving_avg_200d", DEC(18, 4)), ("rsi_14d", DEC(6, 2)),
    ("processed_at", TS)),
    key=("symbol", "trade_date"), not_null=("symbol", "trade_date"), lengths={"symbol": 20})

PORTFOLIO_POSITIONS = TableSpec("analytics.portfolio_positions", _s(
    ("portfolio_id", S), ("symbol", S), ("position_date", D), ("quantity", DEC(18, 4)),
    ("avg_cost", DEC(18, 4)), ("current_price", DEC(18, 4)), ("market_value", DEC(20, 2)),
    ("unrealized_pnl", DEC(20, 2)), ("weight", DEC(6, 4)), ("processed_at", TS)),
    key=("portfolio_id", "symbol", "position_date"),
    not_null=("portfolio_id", "symbol", "position_date"), lengths={"portfolio_id": 100, "symbol": 20})

FINANCIAL_RATIOS = TableSpec("analytics.financial_ratios", _s(
    ("symbol", S), ("fiscal_period", S), ("fiscal_year", I), ("pe_ratio", DEC(10, 2)),
    ("pb_ratio", DEC(10, 2)), ("debt_to_equity", DEC(10, 4)), ("current_ratio", DEC(10, 4)),
    ("quick_ratio", DEC(10, 4)), ("roa", DEC(8, 4)), ("roe", DEC(8, 4)),
    ("profit_margin", DEC(8, 4)), ("asset_turnover", DEC(8, 4)), ("processed_at", TS)),
    key=("symbol", "fiscal_period", "fiscal_year"), not_null=("symbol", "fiscal_period", "fiscal_year"),
    lengths={"symbol": 20, "fiscal_period": 20})

ETL_RUN_LOG = TableSpec("metadata.etl_run_log", _s(
    ("run_id", L), ("dag_id", S), ("task_id", S), ("source_name", S), ("run_start_time", TS),
    ("run_end_time", TS), ("status", S), ("records_extracted", L), ("records_validated", L),
    ("records_loaded", L), ("error_message", S), ("created_at", TS)),
    key=("run_id",), not_null=("dag_id", "task_id", "source_name", "run_start_time", "status"),
    lengths={"dag_id": 255, "task_id": 255, "source_name": 255, "status": 50})

DATA_QUALITY_LOG = TableSpec("metadata.data_quality_log", _s(
    ("quality_id", L), ("run_id", L), ("validation_type", S), ("validation_rule", S),
    ("passed_records", L), ("failed_records", L), ("validation_details", S), ("created_at", TS)),
    key=("quality_id",), not_null=("validation_type", "validation_rule"),
    lengths={"validation_type": 100, "validation_rule": 255})

ALL = {t.name: t for t in (STOCK_PRICES, COMPANY_FINANCIALS, ECONOMIC_INDICATORS, MARKET_NEWS,
                           CRYPTO_PRICES, DAILY_STOCK_ANALYTICS, PORTFOLIO_POSITIONS,
                           FINANCIAL_RATIOS, ETL_RUN_LOG, DATA_QUALITY_LOG)}
