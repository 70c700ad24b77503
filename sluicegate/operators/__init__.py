"""Contract, routing, window metrics, reasons, forecasts, alerts and rankings."""
