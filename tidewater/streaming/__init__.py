from tidewater.streaming.ingest import ingest_day, ingest_days, ingest_lookback, ingest_stream
from tidewater.streaming.backfill import backfill, chunks_of, ingest_chunks, ledger, open_chunks
