"""Queries over whole tables, compared with plain Python."""

import json
import math

from frameloom.plans import catalogue
from frameloom.session import read_table


def rows_of(spark, data, table, *columns):
    return read_table(spark, data, table).select(*columns).collect()


def test_check_errors_whole(spark, data):
    files = {r.source_path for r in rows_of(spark, data, "media_manifest", "source_path")}
    expected, datasets = {}, set()
    for r in rows_of(spark, data, "built_samples", "sample_key", "dataset", "row_json"):
        try:
            row = json.loads(r.row_json or "")
        except ValueError:
            continue
        said = {role: "".join(m["content"] or "" for m in row["messages"] if m["role"] == role) for role in ("user", "assistant")}
        images, videos = row.get("images") or [], row.get("videos") or []
        n = sum(p not in files for p in images + [p for v in videos for p in v])
        n += (said["user"].count("<image>") != len(images)) + (said["user"].count("<video>") != len(videos)) + (not said["assistant"].strip())
        n += [m["role"] for m in row["messages"]] not in (["system", "user", "assistant"], ["user", "assistant"])
        if n:
            expected[r.sample_key] = n
            datasets.add(r.dataset)
    got = {r.sample_key: r.errors for r in catalogue.check_errors(spark, data).collect()}
    assert got == expected and len(datasets) > 1


def test_square_crop_whole(spark, data):
    expected, scales = {}, set()
    for r in rows_of(spark, data, "template_records", "record_id", "bbox_xywh", "original_size", "context_scale"):
        if r.bbox_xywh is None or len(r.bbox_xywh) != 4 or r.original_size is None or r.context_scale is None:
            continue
        (x, y, w, h), (iw, ih) = r.bbox_xywh, r.original_size
        side = max(2, min(max(w, h) * r.context_scale, iw, ih))
        left, top = (min(max(c - side / 2, 0), n - side) for c, n in ((x + w / 2, iw), (y + h / 2, ih)))
        expected[r.record_id] = (max(0, math.floor(left)), max(0, math.floor(top)), min(iw, math.ceil(left + side)), min(ih, math.ceil(top + side)))
        scales.add(r.context_scale)
    got = {r.record_id: (r.crop_left, r.crop_top, r.crop_right, r.crop_bottom) for r in catalogue.square_crop(spark, data).collect()}
    assert got == expected and scales == {2.0, 3.0}
