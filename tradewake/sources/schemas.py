"""Record schemas of the streams and files the jobs read."""

from __future__ import annotations

COMMON = "struct<ar:string,ba:string,ch:string,is_new:string,md:string,mid:string,os:string,uid:string,vc:string,sid:string>"
PAGE = "struct<page_id:string,last_page_id:string,item:string,item_type:string,during_time:bigint,source_type:string>"
DISPLAY = "struct<display_type:string,item:string,item_type:string,order:bigint,pos_id:bigint>"
ACTION = "struct<action_id:string,item:string,item_type:string,ts:bigint>"
START = "struct<entry:string,loading_time:bigint,open_ad_id:string,open_ad_ms:bigint,open_ad_skip_ms:bigint>"

APP_LOG = (
    f"common {COMMON}, page {PAGE}, displays array<{DISPLAY}>, actions array<{ACTION}>, "
    f"start {START}, err struct<error_code:string>, ts bigint"
)
APP_LOG_CHECKED = APP_LOG + ", _corrupt_record string"

# Images are sparse string maps: every source table has its own columns.
ENVELOPE = (
    "op string, before map<string,string>, after map<string,string>, source map<string,string>, ts_ms bigint"
)

SHOP_LOG = (
    "shop_id string, page_id string, event_id string, event_type string, quantity int, device_id string, "
    "user_id string, item_id string, session_id string, event_time string, props map<string,string>"
)

# The 22 fields of the telemetry load, in load order, with their column types.
TELEMETRY = {
    "id": "bigint", "msid": "string", "datatype": "bigint", "data": "string", "upexgmsgregister": "string",
    "vehicleno": "string", "datalen": "bigint", "vehiclecolor": "bigint", "vec1": "bigint", "vec2": "bigint",
    "vec3": "bigint", "encrypy": "bigint", "altitude": "bigint", "alarm": "string", "state": "string",
    "lon": "double", "lat": "double", "msgId": "bigint", "direction": "bigint", "dateTime": "string",
    "ds": "date", "ts": "bigint",
}
