"""The registered queries, and SQL that an independent engine can check them with."""
