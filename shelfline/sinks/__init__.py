"""Writers for the bronze, silver and gold layers, alerts and reports."""
