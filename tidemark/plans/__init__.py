"""Job-level building blocks: staged tables, catalogs, composed pipelines."""
