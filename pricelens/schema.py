"""Record contracts (typed at the boundary, never inferred)."""

from pyspark.sql import types as T

CATEGORY_TYPE = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("code", T.StringType()),
]))

RUNG_TYPE = T.StructType([
    T.StructField("unit", T.LongType()),
    T.StructField("CU_status", T.StringType()),
    T.StructField("price", T.DoubleType()),
])

LADDER_TYPE = T.ArrayType(RUNG_TYPE)

# Output record: field order is the published JSON key order.
PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("brand_name", T.StringType()),
    T.StructField("product_desc", T.StringType()),
    T.StructField("product_image", T.StringType()),
    T.StructField("request_url", T.StringType()),
    T.StructField("product_category", CATEGORY_TYPE),
    T.StructField("product_spec", T.StringType()),
    T.StructField("price", LADDER_TYPE),
    T.StructField("_source", T.StringType()),
    T.StructField("_created_date", T.TimestampType()),
])

PRODUCT_COLS = [f.name for f in PRODUCT_SCHEMA.fields]

REJECT_SCHEMA = T.StructType([
    T.StructField("reason", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("item_url", T.StringType()),
    T.StructField("_source", T.StringType()),
])

REJECT_COLS = [f.name for f in REJECT_SCHEMA.fields]

# One parsed HTML element.  Its descendants are the nodes numbered ord + 1 to
# last; parent is -1 for a top element; classes are sorted and distinct.
NODE_TYPE = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("last", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("sib_tag_pos", T.IntegerType()),
    T.StructField("texts", T.ArrayType(T.StringType())),
])

NODES_TYPE = T.ArrayType(NODE_TYPE)

# A stored page as landed by a fetcher.  The driver's ``pages`` table has
# the first three columns.
PAGE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("site", T.StringType()),
    T.StructField("page_type", T.StringType()),
])

# Page types, named after the step of the walk that leads to them.
HOME, SUBCATEGORY, PAGINATION, LISTING, PRODUCT = (
    "home", "subcategory", "pagination", "listing", "product")
