"""tradestar — a Spark-native trade data warehouse.

Bronze tables (CSV, Parquet or JDBC) are cleaned, turned into a star schema
(nine dimensions with dense surrogate keys and one currency-converted fact),
checked for integrity, loaded incrementally and served as analytical marts.
Every step is a lazy DataFrame transformation; only writers and the few
materialisation points (Parquet tables in the checkpoint folder, measured
row counts) run jobs.
"""

from tradestar.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
