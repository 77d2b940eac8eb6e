from growthlens.sources.io import (
    load_feed,
    overwrite_roundtrip,
    publish_table,
    read_feed,
    read_table,
    stamp_loaded_at,
    write_table,
)
from growthlens.sources.schemas import FEED_SCHEMAS
from growthlens.sources.testdata_feeds import feeds_from_testdata

__all__ = [
    "FEED_SCHEMAS",
    "load_feed",
    "overwrite_roundtrip",
    "publish_table",
    "read_feed",
    "read_table",
    "stamp_loaded_at",
    "feeds_from_testdata",
    "write_table",
]
