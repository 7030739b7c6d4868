"""Word lists, factors, messages and formats that results depend on."""

# --- return reasons (fixed values; matched as case-insensitive substrings) ---
UX_REASONS = (
    "COMPLEX_UI",
    "INCOMPATIBLE",
    "DOCUMENTATION_CONFUSING",
    "DID_NOT_MEET_EXPECTATIONS",
    "SETUP_DIFFICULT",
)
DEFECT_REASONS = (
    "DEFECT",
    "DOA",
    "OVERHEATING",
    "SCREEN_ISSUE",
    "SPEAKER_DISTORTION",
    "FAN_NOISE",
    "BATTERY_DRAIN",
)
LOGISTICS_REASONS = ("DAMAGED_IN_TRANSIT", "UNDERPOWERED_SUPPLY")

# --- product feed (fixed values) ---
FEED_CATEGORIES = (
    "GPUs",
    "AI Hardware",
    "AI Software",
    "Semiconductors",
    "Data Center Products",
    "Automotive Solutions",
    "Networking Products",
    "Cloud Computing",
    "Supercomputing",
    "Gaming Technologies",
    "AI Applications",
    "Professional Workstation",
)
FEED_FIELDS = (
    ("product_id", "str"),
    ("name", "str"),
    ("category", "str"),
    ("brand", "str"),
    ("description", "str"),
    ("price", "float"),
    ("currency", "str"),
    ("in_stock", "bool"),
    ("specifications", "dict"),
    ("images", "list"),
)
PRODUCT_ID_PATTERN = r"^[A-Za-z0-9\-_]{6,50}$"
PRICE_RANGE = (0, 1000000)
CURRENCIES = ("USD", "EUR", "GBP", "JPY", "CNY")
TRUE_WORDS = ("true", "yes", "1", "y")
FALSE_WORDS = ("false", "no", "0", "n")

# --- units (fixed values): unit -> factor to the family's label ---
UNIT_FACTORS = {
    "memory": {"GB": 1.0, "TB": 1024.0, "MB": 1 / 1024},
    "frequency": {"GHz": 1.0, "MHz": 1 / 1000, "kHz": 1 / 1000000},
    "power": {"W": 1.0, "kW": 1000.0, "mW": 1 / 1000},
}
UNIT_LABELS = {"memory": "GB", "frequency": "GHz", "power": "W"}
# A specification belongs to the first family one of whose words its key contains.
FAMILY_KEY_WORDS = (
    ("memory", ("memory", "storage")),
    ("frequency", ("frequency", "speed", "clock")),
    ("power", ("power", "watt")),
)

# --- task list (fixed values) ---
TASK_COLUMNS = ("Task ID", "Task Name", "Description", "Owner", "Estimated Time")
TASK_DURATION_MESSAGE = "Invalid Estimated Time format (expected e.g., '2h')"

# --- value sets of the table checks (fixed values) ---
USER_ROLES = ("admin", "user", "guest")
PAYMENT_STATUSES = ("FAILED", "PENDING", "SUCCESS")
BOOLEAN_WORDS = ("0", "1", "true", "false", "yes", "no")
EMAIL_PATTERN = r"^[\w\.-]+@[\w\.-]+\.\w+$"
DEFAULT_BOOKMARK = "2000-01-01 00:00:00"
NULL_REPLACEMENT = "UNKNOWN"

# --- type names accepted in cleaning rules (fixed values) ---
TYPE_NAMES = {
    "StringType": "string",
    "IntegerType": "int",
    "DoubleType": "double",
    "LongType": "bigint",
    "BooleanType": "boolean",
    "TimestampType": "timestamp",
}

# --- key renames per table (fixed values; joins rely on product_id / user_id) ---
KEY_RENAMES = {
    "address": {"id": "address_id"},
    "cart": {"id": "cart_id"},
    "cart_item": {"id": "cart_item_id"},
    "category": {"id": "category_id"},
    "inventories": {"id": "inventory_id"},
    "inventory_logs": {"id": "log_id"},
    "payment": {"id": "payment_id"},
    "payment_log": {"id": "payment_log_id"},
    "price_history": {"id": "price_history_id"},
    "products": {"id": "product_id"},
    "recently_viewed_products": {"id": "view_id"},
    "returned_items": {"id": "return_id"},
    "reviews": {"id": "review_id"},
    "test_table": {"id": "test_id"},
    "users": {"id": "user_id"},
    "wishlist": {
        "id": "wishlist_id",
        "first_name": "user_first_name",
        "last_name": "user_last_name",
    },
}

# --- column contracts per table (fixed values) ---
CONTRACTS = {
    "cart_item": {
        "required": ["id", "product_id", "quantity"],
        "optional": ["price", "last_updated", "created_at", "status"],
        "disallowed": ["temp_col", "debug_flag"],
    },
    "products": {
        "required": ["id", "name", "brand"],
        "optional": [
            "category_id", "created_at", "updated_at", "description", "model",
            "unit", "average_rating", "is_active", "is_featured", "price",
        ],
        "disallowed": ["legacy_code", "temp_flag"],
    },
    "users": {
        "required": ["id", "first_name", "last_name", "email"],
        "optional": ["created_at", "updated_at", "status"],
        "disallowed": ["temp_flag", "legacy_user"],
    },
}

# --- catalog used when the catalog file is missing or unreadable (fixed values) ---
DEFAULT_CATALOG = (
    (1, "Smart AI Assistant", "AI Consumer Products", 299.99,
     "An intelligent virtual assistant for everyday tasks"),
    (2, "Voice Recognition Module", "AI Consumer Products", 149.99,
     "Advanced voice recognition technology for smart devices"),
    (3, "AI Edge Processor", "AI Consumer Products", 499.99,
     "Process AI workloads locally on your device"),
    (4, "TPU Accelerator Card", "Hardware", 799.99,
     "Tensor Processing Unit for accelerated machine learning"),
    (5, "Neural Network Server", "Hardware", 1299.99,
     "Dedicated server for running neural networks"),
)

# --- event and message names (fixed values) ---
VIEW_EVENT = "product_view"
PURCHASE_EVENT = "product_purchase"
RECOMMENDATION_MESSAGE = "recommendations_generated"
PURCHASE_MESSAGE = "purchase_confirmed"
METRICS_MESSAGE = "metrics_update"
TOPIC_EVENTS = "user-events"
TOPIC_RECOMMENDATIONS = "recommendations"
TOPIC_METRICS = "metrics"
