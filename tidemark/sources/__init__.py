from .tables import TABLES, read_table, table_path, register_views
