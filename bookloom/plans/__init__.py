"""The tables and reports: intake, silver, gold, increments, report frames."""
