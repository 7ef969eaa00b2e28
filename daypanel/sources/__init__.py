"""Text sources read against a contract, and case-series tables read by column name."""
