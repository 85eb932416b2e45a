"""Fixed names and table schemas shared by every job."""

from __future__ import annotations

# The required header names, with the column each one feeds.
REQUIRED_HEADERS = {
    "TransactNo": "transact_raw",
    "Scale Name": "scale_raw",
    "CylSize": "cyl_raw",
    "TareWeight": "tare_raw",
    "Fill kgs": "fill_raw",
    "Residual": "residual_raw",
    "Success": "success_raw",
    "Date Time Start": "started_raw",
    "Fill Time": "fill_time_raw",
}
RAW_COLUMNS = list(REQUIRED_HEADERS.values())

# The file status domain and its display labels.
STATUSES = ["NEW", "PROCESSING", "COMPLETED", "FAILED", "DUPLICATE"]
STATUS_LABELS = {"COMPLETED": "[OK]", "FAILED": "[FAIL]", "NEW": "[NEW]", "DUPLICATE": "[DUP]"}
UNKNOWN_STATUS_LABEL = "[?]"

# Where the scales keep their clocks, and where mail comes from.
LOCAL_ZONE = "Africa/Johannesburg"
DEFAULT_SOURCE = "imap"

# Destinations of a message.
INBOX, PROCESSED, FAILED, DUPLICATES = "Inbox", "Processed", "Failed", "Duplicates"

KEY_COLUMNS = ["scale_name", "transact_no"]
MEASURE_COLUMNS = [
    "cyl_size_kg",
    "tare_weight_kg",
    "fill_kg",
    "residual_kg",
    "success",
    "started_at",
    "fill_time_seconds",
]
# Total order of arrival of a row: batch, then file, then place in the file.
ARRIVAL_COLUMNS = ["batch_id", "received_at", "path", "part_index", "row_seq"]

ARRIVALS = (
    "path string, part_index int, filename string, source string, message_id string, "
    "from_email string, subject string, received_at timestamp_ntz, content binary"
)

FILE_ARRIVALS = (
    "path string, part_index int, filename string, source string, message_id string, "
    "from_email string, subject string, received_at timestamp_ntz, file_sha256 string, "
    "length bigint, status string, error string, original_id bigint, original_status string, "
    "created_at timestamp_ntz, batch_id bigint"
)

INGESTION_FILES = (
    "id bigint, source string, message_id string, from_email string, subject string, "
    "received_at timestamp_ntz, filename string, file_sha256 string, status string, "
    "error string, processing_started_at timestamp_ntz, processing_completed_at timestamp_ntz, "
    "correlation_id string, created_at timestamp_ntz, updated_at timestamp_ntz, batch_id bigint"
)

TRANSACTION_VERSIONS = (
    "id bigint, scale_name string, transact_no bigint, cyl_size_kg decimal(10,3), "
    "tare_weight_kg decimal(10,3), fill_kg decimal(10,3), residual_kg decimal(10,3), "
    "success boolean, started_at timestamp_ntz, fill_time_seconds int, "
    "ingestion_file_id bigint, file_sha256 string, correlation_id string, "
    "received_at timestamp_ntz, path string, part_index int, row_seq bigint, "
    "committed_at timestamp_ntz, batch_id bigint"
)

ROW_ERRORS = (
    "file_sha256 string, path string, row_number bigint, field string, code string, "
    "message string, raw_value string, batch_id bigint"
)

DISPOSITIONS = (
    "message_id string, path string, folder string, reason string, batch_id bigint"
)

# DDL of each stored table; ``batch_id`` is the partition column.
TABLES = {
    "file_arrivals": FILE_ARRIVALS,
    "ingestion_files": INGESTION_FILES,
    "scale_transactions": TRANSACTION_VERSIONS,
    "row_errors": ROW_ERRORS,
    "dispositions": DISPOSITIONS,
}
