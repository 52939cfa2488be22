from .cuts import equal_cuts, with_cuts
from .dims import Split, read_countries, read_dim, read_preferred_vendors, split_dim
from .facts import JdbcSource, jdbc_ranges, read_fact, warehouse_types, write_snapshot
from .lines import OTS_LINE_KEYS, SOT_LINE_KEYS, collapse_lines, read_lines, write_lines
from .scratch import drop_folder, run_folder, scratch_path, session_folder, stage
from .sinks import publish_run, published_files, tee, with_headings, write_book, write_report
from .versions import VersionedFolder, resolve

__all__ = [
    "JdbcSource",
    "OTS_LINE_KEYS",
    "SOT_LINE_KEYS",
    "Split",
    "VersionedFolder",
    "collapse_lines",
    "drop_folder",
    "equal_cuts",
    "jdbc_ranges",
    "publish_run",
    "published_files",
    "read_countries",
    "read_dim",
    "read_fact",
    "read_lines",
    "read_preferred_vendors",
    "resolve",
    "run_folder",
    "scratch_path",
    "session_folder",
    "split_dim",
    "stage",
    "tee",
    "warehouse_types",
    "with_cuts",
    "with_headings",
    "write_book",
    "write_lines",
    "write_report",
    "write_snapshot",
]
