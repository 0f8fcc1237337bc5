from sessionlens.sources.sinks import write_table  # noqa: F401
from sessionlens.sources.tables import Tables, read_table, table_path  # noqa: F401
