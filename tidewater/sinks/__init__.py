from tidewater.sinks.batches import append_batch, changed_keys, compact, delete_keys, last_seq, read_merged, segments
from tidewater.sinks.tables import (
    commit_version, dedupe_last, observed, read_current, refresh, register_all, set_path, soft_delete,
    upsert, upsert_table, verify_count, versions, write_rejects, upsert_partitioned, key_bucket, note_month,
)
