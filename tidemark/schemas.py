"""Column layouts of the tables the operators exchange, as DDL."""

EDIT_EVENT = """
    meta struct<id:string, dt:string>, timestamp bigint, server_url string,
    server_name string, server_script_path string, wiki string, namespace int,
    title string, type string, comment string, user string, bot boolean,
    minor boolean, patrolled boolean, length struct<old:int, new:int>,
    page_qid string, page_country_qid string, page_country_code string,
    geo_method string, geo_confidence int
"""

# The un-enriched feed may carry the namespace under a second, stronger name.
RAW_EDIT = EDIT_EVENT + ", ns int"

EDIT = """
    meta_id string, dt timestamp, timestamp_unix bigint, wiki string,
    server_name string, server_url string, server_script_path string,
    page_id bigint, title string, namespace int, type string, comment string,
    user_text string, bot boolean, minor boolean, patrolled boolean,
    old_len int, new_len int, added int, removed int, page_qid string,
    page_country_qid string, page_country_code string, geo_method string,
    geo_confidence smallint, page_lat double, page_lon double,
    page_geohash string, raw string, topics array<string>
"""

TOPIC = "key string, label string, enabled boolean, keywords array<string>"

TICKER = (
    "id int, symbol string, name string, exchange string, currency string, "
    "mic string, tz string, iso2 string"
)

COUNTRY = "iso2 string, name string"

CENTROID = "iso2 string, lon double, lat double"

BAR = """
    ticker_id int, ts_utc timestamp, interval string, open double, high double,
    low double, close double, volume bigint, prepost boolean, source string,
    ingested_at timestamp, is_final boolean
"""

CLAIM = (
    "qid string, property string, ord int, value_qid string, value_str string"
)

GEO_FEATURE = (
    "properties map<string, string>, "
    "geometry struct<type:string, coordinates:string>"
)
