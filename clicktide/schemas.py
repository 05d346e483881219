"""Column layouts and fixed values shared by the batch and the streaming side.

Layouts are DDL strings, which every Spark reader and ``from_json`` accept.
``TIMESTAMP_LTZ`` is spelled out so that ``spark.sql.timestampType`` cannot
turn event time into a zone-less type, on which watermarks do not work.
"""

CLICKSTREAM = (
    "user_id STRING, product_id STRING, category STRING, "
    "event_type STRING, timestamp TIMESTAMP_LTZ"
)
CLICKSTREAM_COLUMNS = ["user_id", "product_id", "category", "event_type", "timestamp"]

ARCHIVE = CLICKSTREAM + ", event_date DATE"
ARCHIVE_PARTITION = "event_date"

MESSAGE = "key STRING, value STRING"

USER_SEGMENT = (
    "user_id STRING, views BIGINT, cart_adds BIGINT, purchases BIGINT, segment STRING"
)
CONVERSION = (
    "category STRING, views BIGINT, cart_adds BIGINT, purchases BIGINT, "
    "conversion_rate DOUBLE"
)
CHART_SERIES = "category STRING, percent DOUBLE, label STRING"

ALERT_COLUMNS = [
    "product_id", "category", "window_start", "window_end",
    "views", "purchases", "cart_adds", "alert_type", "recommendation",
]

# Event type -> name of its counter column.
COUNTER_OF_EVENT_TYPE = {
    "view": "views",
    "add_to_cart": "cart_adds",
    "purchase": "purchases",
}

# Segment names.
BUYER = "BUYER"
WINDOW_SHOPPER = "WINDOW_SHOPPER"

# The alert rule, its windows and its texts.
ALERT_VIEWS_OVER = 100
ALERT_PURCHASES_UNDER = 5
WINDOW_SIZE = "10 minutes"
WINDOW_SLIDE = "5 minutes"
ALLOWED_LATENESS = "2 minutes"
ALERT_TYPE = "FLASH_SALE_SUGGESTED"
ALERT_RECOMMENDATION = "High interest, low conversion - consider a discount or flash sale."

# Topics and the archive's commit interval.
EVENT_TOPIC = "clickstream-events"
ALERT_TOPIC = "flash-sale-alerts"
ARCHIVE_TRIGGER = {"processingTime": "30 seconds"}

# Report sizes.
TOP_PRODUCTS = 5
TOP_USERS = 25
CONSOLE_ROWS = 20

# The product catalogue, in product order.
CATALOGUE = {
    "P001": "Laptops",
    "P002": "Laptops",
    "P003": "Smartphones",
    "P004": "Smartphones",
    "P005": "Smartphones",
    "P006": "Headphones",
    "P007": "Headphones",
    "P008": "Cameras",
    "P009": "Cameras",
    "P010": "Smartwatches",
    "P011": "Smartwatches",
    "P012": "Tablets",
}
