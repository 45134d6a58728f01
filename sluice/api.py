"""One import surface for the operators (``from sluice.api import guarded_slice_load, ...``)."""

from .functions.convert import (datetime_digits, map_bool, map_datetime, map_float, map_int, map_string,
                                python_float_text)
from .functions.money import cents_error, cents_to_decimal, transaction_type, transaction_type_error
from .functions.text import (delimited_list, delimited_list_cap, iso_format, list_cap_error, safe_course_id,
                             url_file_stem)
from .operators.batching import batch_ids, batch_pack, global_rank
from .operators.mapping import flatten_by_mapping
from .operators.records import (conform, conform_json, error_text, raise_on_errors, record_diff, record_replace,
                                record_validate, tsv_decode, tsv_encode)
from .operators.reports import (control_total_check, header_columns, parse_once, parse_response, report_body,
                                report_file_pick, report_columns, report_layout, report_metadata, report_page_rows, report_records, report_rows,
                                report_state, report_status, response_ok, settlement)
from .operators.sitemap import sitemap_index_urls, sitemap_urls
from .operators.sizing import materialised
from .operators.spines import date_spine, date_spine_from, missing_slices, month_spine, month_spine_from, param_product
from .operators.sync import (high_water_filter, high_water_update, incremental_sync, lead_batches, lead_payload,
                             null_split, processed_count, processed_counts, read_mark, unsubscribe_payload, write_mark)
from .sinks.dated import dated_report_sink, sitemap_sink
from .sinks.export import delimited_export, export_dir, manifest_write, ndjson_gzip_export
from .sinks.guard import (guarded_slice_load, read_target, slice_date, slice_exists, slice_present, slice_raw, slice_session, stage_and_swap,
                          swap_overwrite)
from .sinks.load import landed_load, read_ledger
from .sinks.snapshots import vacuum
from .sources.apipages import api_page_links, api_pages_flatten, dangling_pages, page_positions
from .sources.delimited import delimited_load, manifest_entries, manifest_load
from .sources.files import file_select, load_once, numbered_lines, object_inventory, selected_files
from .sources.landing import session_landing, variant_landing
from .sources.scan import projected_scan
from .spec import (BooleanField, DateField, DateTimeField, DelimitedStringField, Field, FloatField, IntegerField,
                   RecordSpec, StringField)
from .streaming.incremental import batch_pack_stream, high_water_stream, load_new_files

__all__ = [n for n in dir() if not n.startswith("_")]
