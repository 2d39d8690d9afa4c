"""DataFrame -> DataFrame operators: quality, privacy, windows, KPIs, chart data."""
