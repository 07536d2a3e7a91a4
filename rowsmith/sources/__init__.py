from rowsmith.sources.score_store import append_scores, read_score_table, read_scores, write_scores_json
from rowsmith.sources.tables import load_table, read_table_csv, write_table_csv

__all__ = [
    "append_scores",
    "load_table",
    "read_score_table",
    "read_scores",
    "read_table_csv",
    "write_scores_json",
    "write_table_csv",
]
