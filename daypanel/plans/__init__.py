"""The concrete tables and views, and the job that builds them."""
