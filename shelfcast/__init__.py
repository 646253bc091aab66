"""shelfcast: retail demand-forecasting features as composable Spark DataFrame operators."""
