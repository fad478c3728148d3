"""Column functions. Every one is a Catalyst expression; none is a Python UDF."""

from streetflow.functions.display import (  # noqa: F401
    alert_text, band, first_text, radius, residual, speed_color,
)
from streetflow.functions.media import (  # noqa: F401
    box_line, camera_of, decode_base64, frame_label, frame_name, object_key, object_url, rebase_url,
)
from streetflow.functions.time import (  # noqa: F401
    event_date, hour_of_day, is_weekend, iso_weekday, parse_event_time, sunday_weekday, unix_seconds,
)
