"""Column -> Column building blocks; all JVM-side built-ins."""

from hourglass.functions.buckets import (  # noqa: F401
    day_bucket, epoch_secs, granularity_buckets, hour_bucket, idiv,
    month_bucket, view_period, week_bucket,
)
from hourglass.functions.ids import (  # noqa: F401
    dataunit_id, gender, is_person_id, parse_int, parse_long, person_id,
)
from hourglass.functions.keys import (  # noqa: F401
    bucketed_key, bucketed_key_string, deserialize_long, key_bucket,
    key_granularity, key_url, serialize_long,
)
from hourglass.functions.urls import is_valid_url, normalize_url, opaque  # noqa: F401
