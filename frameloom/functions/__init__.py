"""Pure Column builders; none needs Python at run time."""

from .geometry import crop_side, parse_box, square_crop
from .hashing import bundle_path, hash_fraction, normal_path, python_float, safe_basename, sha1_prefix, sha1_seed, split_for_group, template_id
from .sequences import active_keys, even_positions, even_sample, even_values, let, prefix_endpoint, prefix_sample
from .text import (
    count_of,
    format_reasons,
    gib,
    html_escape,
    is_cjk,
    is_json_like,
    mentions_annotation,
    natural_key,
    numbered_frame,
    path_name,
    path_parent,
    path_stem,
    path_suffix,
    placeholder_tokens,
    relative_path,
    sentence_count,
    strip,
    to_data_url,
    under_segment,
    without_last_part,
    word_count,
)

__all__ = [x for x in dir() if not x.startswith("_") and x not in ("geometry", "hashing", "sequences", "text")]
