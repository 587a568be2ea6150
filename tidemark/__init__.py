"""Panel forecasting on Spark: driver selection, model selection and forecasts for many series."""
