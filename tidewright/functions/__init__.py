"""Column functions built from Spark expressions; no Python runs per row."""

from tidewright.functions.geometry import (
    box_iou,
    central_bounds,
    grid_box,
    lonlat_cell,
    pack_boxes,
    shortest_side,
)
from tidewright.functions.keys import bucket_of, hash_unit, match_on, md5_number, value_key
from tidewright.functions.text import (
    fill_placeholders,
    folder_up,
    join_key,
    non_blank_text,
    strip_home,
    typed_literal,
)
from tidewright.functions.times import compact_date, due_by, epoch_seconds, time_parts
from tidewright.functions.vectors import (
    argmax_position,
    channel_scale,
    distance,
    dot,
    expanded_sq_distance,
    linspace,
    log_mean_exp,
    permute_axes,
    projection_hash,
    rbf,
    squared_distance,
    status_code,
)

__all__ = [
    "argmax_position", "box_iou", "bucket_of", "central_bounds", "channel_scale", "compact_date",
    "distance", "dot", "due_by", "epoch_seconds", "expanded_sq_distance", "fill_placeholders",
    "folder_up", "grid_box", "hash_unit", "join_key", "linspace", "log_mean_exp", "lonlat_cell",
    "match_on", "md5_number", "non_blank_text", "pack_boxes", "permute_axes", "projection_hash", "rbf",
    "shortest_side", "squared_distance", "status_code", "strip_home", "time_parts",
    "typed_literal", "value_key",
]
