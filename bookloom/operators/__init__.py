"""DataFrame operators shared by the table builders and the reports."""
