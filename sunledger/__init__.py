"""Forecast evidence on Spark: honest scoring of solar forecasts and the data behind them."""
