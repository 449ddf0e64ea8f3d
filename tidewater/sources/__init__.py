from tidewater.sources.arrays import scan_arrays
from tidewater.sources.documents import (
    ids_from_text, incomplete_lists, page_completeness, parse_cancel_xml, parse_dead_letters, parse_detail_envelopes,
    parse_json_array, parse_nested_array_json, parse_note_xml, parse_paged_envelopes,
    parse_sectioned_json, read_id_list, records, rejects, scan_json_array, scan_nested_array_json, scan_sectioned_json,
)
from tidewater.sources.files import (
    arrival, file_day, folder_of, key_from_name, listed_files, landed, landed_stream, new_files, only_new, select_files, strip_bom,
    unread_files, with_folder_code,
)
