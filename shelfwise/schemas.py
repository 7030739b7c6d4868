"""Declared schemas, so that no read needs inference."""

CATALOG = "id bigint, name string, category string, price double, description string"

PROFILE = (
    "preferred_categories array<string>, preferred_features array<string>, "
    "price_sensitivity double, viewing_history array<bigint>, purchase_history array<bigint>"
)

EVENT = (
    "event_id bigint, event_type string, timestamp double, user_id bigint, product_id bigint, "
    f"product struct<{CATALOG.replace(' ', ':').replace(',:', ', ')}>, "
    "user_profile struct<preferred_categories:array<string>, preferred_features:array<string>, "
    "price_sensitivity:double, viewing_history:array<bigint>, purchase_history:array<bigint>, "
    "views_before:bigint, purchases_before:bigint>"
)

METRICS = (
    "precision:double, recall:double, f1:double, total_recommendations:bigint, "
    "relevant_recommendations:bigint, total_relevant_products:bigint, runtime_seconds:double, "
    "events_processed:bigint, events_per_second:double, active_user_sessions:bigint"
)

# The output topics carry three message kinds; one schema covers them all.
MESSAGE = (
    "event_id bigint, event_type string, timestamp double, user_id bigint, "
    "viewed_product_id bigint, viewed_product_name string, "
    "recommendations array<struct<id:bigint, name:string, category:string, price:double, "
    "description:string, tier:int>>, recommendation_count int, processing_time_ms double, "
    "has_user_profile boolean, product_id bigint, product_name string, price double, "
    f"metrics struct<{METRICS}>"
)

FEED = (
    "product_id string, name string, category string, brand string, description string, "
    "price string, currency string, in_stock string, specifications string, images string"
)
SPECIFICATIONS = "map<string,string>"
IMAGES = "array<string>"

TASKS = ("`Task ID` string, `Task Name` string, `Description` string, `Owner` string, "
         "`Estimated Time` string")

ORDERS = "id bigint, user_id bigint, created_at timestamp_ntz"
ORDER_ITEMS = "id bigint, order_id bigint, product_id bigint, quantity int"
PRODUCTS = "id bigint, category_id int, brand string, name string"
RETURNS = "id bigint, product_id bigint, user_id bigint, created_at timestamp_ntz, reason string"
