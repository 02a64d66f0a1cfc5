from waitspark.sources.batches import append_months, commit_batch, files_over, manifest, read_months, stage_batch
from waitspark.sources.pages import html_rows, html_table, pages_with_param, row_cells, table_rows, top_elements
from waitspark.sources.tables import (
    append_csv,
    append_in_batches,
    count_csv,
    file_counts,
    preview,
    read_processed,
    read_trips,
    read_weather,
    read_zones,
    sample_files,
    write_processed,
)

__all__ = [
    "append_csv",
    "append_in_batches",
    "append_months",
    "commit_batch",
    "count_csv",
    "file_counts",
    "files_over",
    "html_rows",
    "html_table",
    "manifest",
    "pages_with_param",
    "preview",
    "read_months",
    "read_processed",
    "read_trips",
    "read_weather",
    "read_zones",
    "row_cells",
    "sample_files",
    "stage_batch",
    "table_rows",
    "top_elements",
    "write_processed",
]
