from lakekit.sources.files import all_text_schema, catalog_scan, read_raw_csv, read_refined
from lakekit.sources.manifest import changed_files, raw_file_manifest

__all__ = ["all_text_schema", "catalog_scan", "changed_files", "raw_file_manifest", "read_raw_csv", "read_refined"]
