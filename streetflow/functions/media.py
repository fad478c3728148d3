"""Frame names, object keys, base64 payloads and label lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name patterns, bucket marker, label line format, default camera.
FRAME_NAME = "img%05d.jpg"
FRAME_LABEL = "%s_img%05d"
BUCKET_MARKER = "/cctv-frames/"
DEFAULT_BASE_URL = "http://localhost:9000/cctv-frames"
DEFAULT_CAMERA = "camera_0"
LABEL_LINE = "0 %.6f %.6f %.6f %.6f"


def object_key(camera: Column, frame: Column) -> Column:
    """`camera/frame` with inner slashes replaced and `.jpg` added where missing."""
    key = F.concat_ws("/", F.replace(camera, F.lit("/"), F.lit("_")), F.replace(frame, F.lit("/"), F.lit("_")))
    return F.when(F.lower(key).endswith(".jpg"), key).otherwise(F.concat(key, F.lit(".jpg")))


def object_url(key: Column, base: str = DEFAULT_BASE_URL) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), key)


def rebase_url(url: Column, base: str = DEFAULT_BASE_URL) -> Column:
    """Move a stored frame URL under `base`; URLs without the marker stay."""
    at = F.instr(url, BUCKET_MARKER)
    tail = F.substring(url, at + F.lit(len(BUCKET_MARKER)), F.length(url))
    return (F.when(url.isNull() | (url == ""), "")
            .when(url.contains(base) | (at == 0), url)
            .otherwise(F.concat(F.lit(base.rstrip("/") + "/"), tail)))


def camera_of(name: Column, up_to_first_underscore: bool = True) -> Column:
    """Camera of a flat file name.

    By default the text before the first underscore. With `up_to_first_underscore=False` the
    text before the last one, which keeps names such as `camera_7_0001.jpg` apart.
    """
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    pattern = "^([^_]*)_" if up_to_first_underscore else "^(.*)_"
    return F.when(stem.contains("_"), F.regexp_extract(stem, pattern, 1)).otherwise(DEFAULT_CAMERA)


def decode_base64(text: Column) -> Column:
    """Bytes, or null when the text is not base64."""
    return F.try_to_binary(text, F.lit("base64"))


def frame_name(number: Column) -> Column:
    return F.format_string(FRAME_NAME, number)


def frame_label(sequence: Column, number: Column, suffix: str) -> Column:
    """`<sequence>_img00001` plus `.jpg` or `.txt`."""
    return F.concat(F.format_string(FRAME_LABEL, sequence, number), F.lit(suffix))


def _unit(value: Column) -> Column:
    """Clamp to [0, 1]; six digits, a value exactly between two goes to the even one."""
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)), 6)


def box_line(left: Column, top: Column, width: Column, height: Column,
             frame_width: Column, frame_height: Column) -> Column:
    """Label line of a box: centre and size relative to the frame, clamped to [0, 1]."""
    return F.format_string(LABEL_LINE, _unit((left + width / 2) / frame_width),
                           _unit((top + height / 2) / frame_height),
                           _unit(width / frame_width), _unit(height / frame_height))
