"""Schema and rule values shipped with the library.

Fixed values: names, aliases, keywords, keys, tags and rules below decide which rows end up where, so they are
kept as plain data. Pass your own dictionaries of the same shape to :func:`sievemill.registry.build_registry`.
"""

# Schema order matters, the first schema with a keyword hit wins.
SCHEMAS = {
    "weekly_report": {
        "keywords": ["weekly_fut", "weekly_opt", "opendata", "商品名稱"],
        "db_table_name": "fact_weekly_report",
        "required_columns": [
            "trading_date", "product_name", "investor_type", "long_pos_volume", "short_pos_volume",
        ],
        "unique_key": ["trading_date", "product_name", "investor_type"],
        "source_tag": "taifex_weekly_csv",
        "columns_map": {
            "trading_date": {"db_type": "DATE", "aliases": ["日期", "交易日期"]},
            "product_name": {"db_type": "VARCHAR", "aliases": ["商品名稱", "契約"]},
            "investor_type": {"db_type": "VARCHAR", "aliases": ["身份別"]},
            "long_pos_volume": {"db_type": "BIGINT", "aliases": ["多方交易口數"]},
            "long_pos_value": {"db_type": "BIGINT", "aliases": ["多方交易金額"]},
            "short_pos_volume": {"db_type": "BIGINT", "aliases": ["空方交易口數"]},
            "short_pos_value": {"db_type": "BIGINT", "aliases": ["空方交易金額"]},
            "source": {"db_type": "VARCHAR", "aliases": ["source"]},
        },
    },
    "default_daily": {
        "keywords": ["daily", "optionsdaily", "fut", "opt", "2021", "2022", "2023", "2024", "csv", "delta"],
        "db_table_name": "fact_daily_ohlc",
        "required_columns": ["trading_date", "product_id", "close", "volume"],
        "primary_key": ["trading_date", "product_id", "expiry_month", "strike_price", "option_type"],
        "unique_key": ["trading_date", "product_id", "expiry_month", "strike_price", "option_type"],
        "source_tag": "taifex_daily_csv",
        "columns_map": {
            "trading_date": {"db_type": "DATE", "aliases": ["交易日期", "日期"]},
            "product_id": {"db_type": "VARCHAR", "aliases": ["契約代號", "契約", "商品代號"]},
            "expiry_month": {"db_type": "VARCHAR", "aliases": ["到期月份(週別)"]},
            "strike_price": {"db_type": "DOUBLE", "aliases": ["履約價"]},
            "option_type": {"db_type": "VARCHAR", "aliases": ["買賣權"]},
            "open": {"db_type": "DOUBLE", "aliases": ["開盤價"]},
            "high": {"db_type": "DOUBLE", "aliases": ["最高價"]},
            "low": {"db_type": "DOUBLE", "aliases": ["最低價"]},
            "close": {"db_type": "DOUBLE", "aliases": ["收盤價"]},
            "volume": {
                "db_type": "BIGINT",
                "aliases": ["成交量", "成交口數"],
                "clean": ["null_tokens", "thousands", "numeric"],
            },
            "open_interest": {"db_type": "BIGINT", "aliases": ["未沖銷契約量", "未沖銷契約數", "未沖銷口數"]},
            "delta": {"db_type": "DOUBLE", "aliases": ["delta"]},
            "source": {"db_type": "VARCHAR", "aliases": ["source"]},
        },
    },
    "quarantine_table_schema": {
        "db_table_name": "quarantine_data",
        "required_columns": ["quarantine_reason", "source_file"],
        "columns_map": {
            "trading_date": {"db_type": "VARCHAR"},
            "product_id": {"db_type": "VARCHAR"},
            "expiry_month": {"db_type": "VARCHAR"},
            "strike_price": {"db_type": "VARCHAR"},
            "option_type": {"db_type": "VARCHAR"},
            "open": {"db_type": "VARCHAR"},
            "high": {"db_type": "VARCHAR"},
            "low": {"db_type": "VARCHAR"},
            "close": {"db_type": "VARCHAR"},
            "volume": {"db_type": "VARCHAR"},
            "open_interest": {"db_type": "VARCHAR"},
            "delta": {"db_type": "VARCHAR"},
            "product_name": {"db_type": "VARCHAR"},
            "investor_type": {"db_type": "VARCHAR"},
            "long_pos_volume": {"db_type": "VARCHAR"},
            "long_pos_value": {"db_type": "VARCHAR"},
            "short_pos_volume": {"db_type": "VARCHAR"},
            "short_pos_value": {"db_type": "VARCHAR"},
            "source": {"db_type": "VARCHAR"},
            "quarantine_reason": {"db_type": "VARCHAR"},
            "source_file": {"db_type": "VARCHAR"},
        },
    },
}

# Schema used when no keyword hits, tag of schemas without one of their own.
FALLBACK_SCHEMA = "default_daily"
UNKNOWN_SOURCE_TAG = "unknown_source"
QUARANTINE_SCHEMA = "quarantine_table_schema"

# Default rule set per schema.
VALIDATION_RULES = {
    "default_daily": {
        "trading_date": {"non_null": True},
        "volume": {"non_null": True, "min_value": 0},
        "close": {"non_null": True},
        "product_id": {"non_null": True},
    },
    "weekly_report": {
        "trading_date": {"non_null": True},
        "long_pos_volume": {"min_value": 0},
        "short_pos_volume": {"min_value": 0},
        "product_name": {"non_null": True},
        "investor_type": {"non_null": True},
    },
}
