"""Explicit schemas of the raw inputs."""

from __future__ import annotations

# Extended-JSON wrappers used by document collections.
OBJECT_ID = "struct<`$oid`: string>"
DATE = "struct<`$date`: string>"

USER_DOC = f"_id {OBJECT_ID}, name string, login string, update_ts {DATE}"
RESTAURANT_DOC = (
    f"_id {OBJECT_ID}, name string, update_ts {DATE}, "
    f"menu array<struct<_id: {OBJECT_ID}, name: string, price: decimal(12,2)>>"
)
ORDER_DOC = (
    f"_id {OBJECT_ID}, final_status string, update_ts {DATE}, "
    f"user struct<id: {OBJECT_ID}>, restaurant struct<id: {OBJECT_ID}>, "
    f"order_items array<struct<id: {OBJECT_ID}, price: decimal(12,2), quantity: int>>"
)
BONUS_EVENT = (
    "user_id string, order_id string, product_payments array<struct<product_id: string, "
    "price: decimal(12,2), quantity: int, product_cost: decimal(12,2), "
    "bonus_payment: decimal(12,2), bonus_grant: decimal(12,2)>>"
)

COURIER = "_id string, name string"
DELIVERY = (
    "order_id string, order_ts string, delivery_id string, courier_id string, address string, "
    "delivery_ts string, rate int, sum decimal(12,2), tip_sum decimal(12,2)"
)

USERS = "id long, chat_name string, registration_dt timestamp_ntz, country string, age int"
GROUPS = "id long, admin_id long, group_name string, registration_dt timestamp_ntz, is_private boolean"
DIALOGS = (
    "message_id long, message_ts timestamp_ntz, message_from long, message_to long, "
    "message string, message_group long"
)
GROUP_LOG = "group_id long, user_id long, user_id_from long, event string, event_dt timestamp_ntz"

CAMPAIGN = (
    "restaurant_id string, adv_campaign_id string, adv_campaign_content string, "
    "adv_campaign_owner string, adv_campaign_owner_contact string, "
    "adv_campaign_datetime_start long, adv_campaign_datetime_end long, datetime_created long"
)

ORDER_EVENT = (
    "object_id long, object_type string, sent_dttm string, "
    "payload struct<date: string, cost: decimal(12,2), payment: decimal(12,2), final_status: string, "
    "restaurant: struct<id: string>, user: struct<id: string>, "
    "order_items: array<struct<id: string, name: string, price: decimal(12,2), quantity: int>>>"
)
USER_ENTRY = "_id string, name string, login string"
RESTAURANT_ENTRY = "_id string, name string, menu array<struct<_id: string, category: string>>"
ENRICHED_ORDER = (
    "object_id long, object_type string, payload struct<id: long, date: string, "
    "cost: decimal(12,2), payment: decimal(12,2), status: string, "
    "restaurant: struct<id: string, name: string>, "
    "user: struct<id: string, name: string, login: string>, "
    "products: array<struct<id: string, price: decimal(12,2), quantity: int, name: string, category: string>>>"
)
COUNTER_MESSAGE = (
    "user_id string, product_id string, product_name string, "
    "category_id string, category_name string, order_id string"
)

TRANSACTIONS = (
    "operation_id string, account_number_from long, account_number_to long, currency_code int, "
    "country string, status string, transaction_type string, amount long, transaction_dt timestamp_ntz"
)
CURRENCIES = (
    "date_update timestamp_ntz, currency_code int, currency_code_with int, "
    "currency_with_div decimal(5,3)"
)
ENVELOPE = "object_id string, object_type string, sent_dttm string, payload string"
