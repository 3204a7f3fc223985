"""The engine's operators over the driver's tables, with the SQL each is checked against."""
