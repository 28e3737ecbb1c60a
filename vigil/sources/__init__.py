from vigil.sources.io import (DRIVER_TABLES, Tables, apply_type_spec, clean_names, literal_table,
                              materialize, read_csv, read_delimited, read_table, rename_with,
                              snake_case, typed_null, write_table)

__all__ = ["DRIVER_TABLES", "Tables", "apply_type_spec", "clean_names", "literal_table", "materialize",
           "read_csv", "read_delimited", "read_table", "rename_with", "snake_case", "typed_null",
           "write_table"]
