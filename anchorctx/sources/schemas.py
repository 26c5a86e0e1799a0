"""Column layouts of the three CSV inputs, matched by position."""

# Names, types and order of the columns. Ids and row numbers are wide, so that
# none becomes NULL for its size.
ORDERS = "row_num bigint, order_creation_time timestamp, order_id bigint, device_id string"
POLLING = (
    "row_num bigint, polling_creation_time timestamp, device_id string,"
    " error_code string, status_code int"
)
CONNECTIVITY_STATUS = "row_num bigint, cs_creation_time timestamp, status string, device_id string"

# Names of the files.
ORDERS_FILE = "orders.csv"
POLLING_FILE = "polling.csv"
CONNECTIVITY_STATUS_FILE = "connectivity_status.csv"
REPORT_FILE = "analysis_data.csv"
