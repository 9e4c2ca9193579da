import base64
import http.server
import json
import os
import struct
import subprocess
import sys
import tarfile
import threading
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from frameloom import cli
from frameloom.functions import normal_path
from frameloom.operators import infer
from frameloom.plans import pipelines
from frameloom.sources import archives, files, schemas, sinks
from frameloom.sources import json as readers
from frameloom.streaming import run_available


def png(width=64, height=48):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0" * (width + 1) * height)) + chunk(b"IEND", b"")


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data) if isinstance(data, bytes) else path.write_text(data if isinstance(data, str) else json.dumps(data), encoding="utf-8")


@pytest.fixture
def corpus(tmp_path):
    """A small copy of each source's layout."""
    base = tmp_path / "cv_datasets"
    put(base / "d3/annotations.json", {"images": [{"id": i, "file_name": f"{i}.png"} for i in range(6)], "categories": [{"id": 1, "name": "a red car"}, {"id": 2, "name": "a boat"}], "annotations": [{"image_id": i, "category_id": 1 + i % 2} for i in range(6)] * 2})
    for i in range(5):
        put(base / f"d3/images/{i}.png", png())
    for i in range(4):
        put(base / f"refer_kitti/expression/000{i % 2}/e{i}.json", {"sentence": f" the car {i // 2} ", "raw_sentence": None, "label": {str(f): [1] for f in range(9, 9 + 3 * i)} | {"1": []}})
    for split in ("train", "val"):
        put(base / f"lamot/{split}/MOT17/S1_a.json", {"language": "people who walk", "targets": {str(f): [3] for f in range(1, 9)}})
    for f in range(1, 9):
        put(base / f"lamot/frames/train/S1/{f:06d}.jpg", png())
    put(base / "mevis/meta_expressions.json", {"videos": {"v1": {"expressions": {"0": {"exp": "moves left"}, "1": {"exp": "turns"}}, "frames": [f"{i:05d}" for i in range(9)]}}})
    for name, folder, language in (("lasot", "img", "nlp.txt"), ("tnl2k", "imgs", "language.txt")):
        for s in ("kite-1", "kite-2"):
            for i in range(8):
                put(base / f"{name}/{s}/{folder}/{i + 1}.png", png(100, 80))
            put(base / f"{name}/{s}/groundtruth.txt", "10,10,20,10\n1,1,1,1\n")
            put(base / f"{name}/{s}/{language}", "﻿ a kite \nmore\n")
    put(base / "sorec/trainL.json", [{"image": f"{i % 3}.png", "bbox": [1.0, 2.5, 10.0, 8.0], "ref": f" thing {i} "} for i in range(5)])
    for i in range(3):
        put(base / f"sorec/Images/{i}.png", png())
    return tmp_path


def test_templates_build_pack_check(spark, corpus, tmp_path):
    root, out = str(corpus), str(tmp_path / "templates")
    assert cli.main(["templates", "--root", root, "--output", out]) == 0
    lines = [json.loads(x) for x in open(f"{out}/lasot.jsonl")]
    assert {r["sample_id"] for r in lines} == {"lasot_kite-1", "lasot_kite-2"} and lines[0]["crop_xyxy"] == [0, 0, 40, 40] and lines[0]["source_text"] == "a kite"
    sorec = [json.loads(x) for x in open(f"{out}/sorec.jsonl")]
    assert len(sorec) == 5 and len({r["sample_id"] for r in sorec}) == 5 and sorec[0]["source_text"].startswith("thing")
    assert cli.main(["templates", "--root", root, "--output", f"{out}/l", "--write-sorec-extract-list", "--sorec-limit", "2"]) == 0
    assert len([x for x in spark.read.text(f"{out}/l/extract_list").collect() if x.value.startswith("Images\\")]) == 2

    b = pipelines.Build(spark, root, str(tmp_path / "rows"), quotas={"d3": 4, "sorec": 3, "refer_kitti": 2, "lamot": 3, "lasot": 2, "tnl2k": 9, "mevis": 9})
    samples = pipelines.build(b).cache()
    counts = {r.dataset: r["count"] for r in samples.groupBy("dataset").count().collect()}
    assert counts["sorec"] == 3 and counts["refer_kitti"] == 2 and counts["lasot"] == 2 and counts["tnl2k"] == 2 and counts["mevis"] == 2 and counts["d3"] <= 4 and counts["lamot"] == 2
    assert {r.split for r in samples.where("dataset = 'lamot'").collect()} == {"train", "val"}
    assert sorted(r.ordinal for r in samples.collect()) == list(range(samples.count()))
    kitti = samples.where("dataset = 'refer_kitti'").collect()
    assert all(0 < len(r.row.videos[0]) <= 6 for r in kitti) and '"raw_sentence":null' in kitti[0].metadata
    pipelines.write_build(samples, b.output)
    assert spark.read.text(f"{b.output}/rows").count() == samples.count() == spark.read.text(f"{b.output}/merged").count()
    demo = pipelines.build(pipelines.Build(spark, root), ("mevis", "d3"), "demo", 1)
    assert {r.split for r in demo.collect()} == {"demo"} and demo.count() <= 2
    pipelines.write_build(demo, str(tmp_path / "demo"), "demo")
    assert "<article>" in open(tmp_path / "demo/preview.html").read()


def bundle_rows(tmp_path):
    image = tmp_path / "src/cv/a.png"
    put(image, png())
    put(tmp_path / "src/cv/b.png", png())
    row = lambda user, images: json.dumps({"messages": [{"role": "user", "content": user}, {"role": "assistant", "content": "ok"}], "images": images})
    put(tmp_path / "src/data/train.jsonl", "\n".join([row("<image>x", [str(image)]), "", row("<image><image>y", ["cv/b.png", str(image)])]) + "\n")
    put(tmp_path / "src/data/val.jsonl", row("<image>z", ["../cv/../cv/b.png".replace("../cv/../", "")]) + "\n")
    return str(tmp_path / "src")


def test_pack_resolve_check(spark, tmp_path):
    src = bundle_rows(tmp_path)
    out = str(tmp_path / "bundle")
    about = pipelines.pack(spark, src, f"{src}/data", out, dry_run=True)
    assert about["unique_media_files"] == 2 and about["rows_across_files"] == 3 and not os.path.exists(out)
    assert cli.main(["pack", "--root", src, "--source-data", f"{src}/data", "--output", out, "--checksum"]) == 0
    assert json.load(open(f"{out}/bundle.json"))["media_bytes"] == 2 * len(png())
    moved = str(tmp_path / "elsewhere")
    os.rename(out, moved)
    assert pipelines.resolve(spark, moved, check_only=True) == {"train": 2, "val": 1}
    assert cli.main(["resolve", "--bundle-root", moved]) == 0 and cli.main(["check", "--bundle-root", moved, "--verify-images"]) == 0
    one = next(os.path.join(d, f) for d, _, fs in os.walk(f"{moved}/media") for f in fs if f.endswith("a.png"))
    with open(one, "wb") as f:
        f.write(png()[:-20])
    assert cli.main(["check", "--bundle-root", moved, "--verify-images"]) == 1 and cli.main(["check", "--bundle-root", moved]) == 0
    os.remove(one)
    report = {r.file: r for r in pipelines.check(spark, moved).collect()}
    assert report["train"].error_rows == 2 and "media not found" in report["train"].errors[0]
    with pytest.raises(FileNotFoundError):
        pipelines.resolve(spark, moved)
    with pytest.raises(FileNotFoundError):
        pipelines.pack(spark, src, str(tmp_path / "src/cv"), out)


def test_pack_keeps_all_keys_and_media(spark, tmp_path):
    src, out = bundle_rows(tmp_path), str(tmp_path / "bundle")
    for name in ("c.wav", "d.png", "e.png", "f.wav", "g.png"):
        put(tmp_path / f"src/cv/{name}", name.encode())
    media = {"images": ["cv/a.png"], "videos": [["cv/g.png"], "cv/b.png"], "audios": ["cv/c.wav"], "rejected_images": ["cv/d.png"], "rejected_videos": [["cv/e.png", "cv/d.png"]], "rejected_audios": "cv/f.wav"}
    rest = {"messages": [{"role": "user", "content": "é<image>", "loss": True}], "objects": {"bbox": [[1.0, 2]], "x": None}, "big": 12345678901234567890, "label": None}
    put(tmp_path / "src/data/more.jsonl", json.dumps(rest | media) + "\n")
    assert pipelines.pack(spark, src, f"{src}/data", out)["unique_media_files"] == 7
    assert pipelines.resolve(spark, out)["more"] == 1
    back = json.loads(open(f"{out}/runtime_data/more.jsonl").read())
    assert {k: v for k, v in back.items() if k not in media} == rest and set(back) == set(rest) | set(media)
    flat = lambda v: [v] if isinstance(v, str) else [x for i in v for x in flat(i)]
    for name, value in media.items():
        assert [open(p, "rb").read() for p in flat(back[name])] == [open(f"{src}/{p}", "rb").read() for p in flat(value)]
    assert isinstance(back["rejected_audios"], str) and [len(v) for v in back["rejected_videos"]] == [2]


def test_bundle_keeps_order_and_lines(spark, tmp_path):
    src, out = bundle_rows(tmp_path), str(tmp_path / "bundle")
    rows = [{"messages": [{"role": "user", "content": f"q{i}"}, {"role": "assistant", "content": "a"}], "id": i} for i in range(500)]
    put(tmp_path / "src/data/deep/er/many.jsonl", "\n\n".join(map(json.dumps, rows)) + "\n")
    put(tmp_path / "src/data/notes.txt", "no rows")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # so that a file is read in many blocks
    try:
        about = pipelines.pack(spark, src, f"{src}/data", out)
        assert about["jsonl_files"] == 3 and pipelines.resolve(spark, out) == {"train": 2, "val": 1, "deep/er/many": 500}
        lines = open(f"{out}/runtime_data/deep/er/many.jsonl").read().splitlines()
        assert [json.loads(x) for x in lines] == rows
        numbered = readers.numbered_lines(spark, f"{src}/data/deep/er/many.jsonl", "id long", ordinal=True).collect()
        assert sorted((r.line, r.id, r.ordinal) for r in numbered) == [(2 * i + 1, i, i) for i in range(500)]
        both = readers.numbered_lines(spark, f"{src}/data", "id long", ordinal=True).orderBy("file", "line").collect()
        assert [r.ordinal for r in both] == list(range(503))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    lines[7], lines[9] = "{broken", json.dumps(rows[9] | {"audios": ["media/none.wav"]})
    open(f"{out}/runtime_data/deep/er/many.jsonl", "w").write("\n".join(lines) + "\n")
    report = {r.file: r for r in pipelines.check(spark, out).collect()}["deep/er/many"]
    assert report.rows == 500 and report.audio_rows == 1 and report.error_rows == 2
    assert report.errors[0] == "8: not a JSON object" and report.errors[1].startswith("10: media not found: media/none.wav")
    with pytest.raises(ValueError, match="many.jsonl:8"):
        pipelines.resolve(spark, out, "runtime_data", "again")


def test_bundle_resolves_itself(spark, tmp_path):
    src, out = bundle_rows(tmp_path), str(tmp_path / "bundle")
    pipelines.pack(spark, src, f"{src}/data", out)
    moved = str(tmp_path / "moved")
    os.rename(out, moved)
    subprocess.run([sys.executable, f"{moved}/resolve.py"], check=True)
    alone = open(f"{moved}/runtime_data/train.jsonl").read()
    pipelines.resolve(spark, moved)
    assert [json.loads(x) for x in alone.splitlines()] == [json.loads(x) for x in open(f"{moved}/runtime_data/train.jsonl")]


def test_one_file_under_two_spellings(spark, tmp_path):
    src, out = bundle_rows(tmp_path), str(tmp_path / "bundle")
    row = {"messages": [], "images": ["cv/a.png", "cv/../cv/./a.png", f"{src}/x/..//cv/a.png"]}
    put(tmp_path / "src/data/more.jsonl", json.dumps(row) + "\n")
    assert pipelines.pack(spark, src, f"{src}/data", out)["unique_media_files"] == 2
    made = spark.createDataFrame([("/a/./b//../c/",), ("/../x",), ("/",)], "p string").select(normal_path(F.col("p"))).collect()
    assert [r[0] for r in made] == ["/a/c", "/x", "/"]


def test_preview_has_all_cards(spark, tmp_path):
    cards = spark.range(300).selectExpr("300 - id AS ordinal", "concat('<article>', id, '</article>') AS card")
    sinks.write_preview(cards, str(tmp_path / "preview.html"))
    page = (tmp_path / "preview.html").read_text()
    assert page.count("<article>") == 300 and page.index(">299<") < page.index(">0<")


@pytest.mark.parametrize("bad", ["{", "[1]", "5", "null"])
def test_unreadable_lines_are_errors(spark, tmp_path, bad):
    src = bundle_rows(tmp_path)
    (tmp_path / "src/data/more.jsonl").write_text(f'\n \t\n{{"messages": []}}\n{bad}\n')
    with pytest.raises(ValueError, match="more.jsonl:4"):
        pipelines.pack(spark, src, f"{src}/data", str(tmp_path / "bundle"))
    with pytest.raises(ValueError, match="more.jsonl:4"):
        cli.main(["infer", "--dataset", f"{src}/data/more.jsonl", "--output", str(tmp_path / "pred")])


def test_evaluate_and_infer(spark, tmp_path):
    rows = [{"messages": [{"role": "user", "content": f"say {i}"}, {"role": "assistant", "content": f"word {i}"}]} for i in range(3)]
    put(tmp_path / "val.jsonl", "\n".join(map(json.dumps, rows)) + "\n")
    args = ["infer", "--dataset", str(tmp_path / "val.jsonl"), "--output", str(tmp_path / "pred"), "--request-interval", "0"]
    assert cli.main([*args, "--max-samples", "2"]) == 0 and cli.main(args) == 0 and cli.main(args) == 0
    got = spark.read.schema("index long, response string").json(str(tmp_path / "pred")).orderBy("index").collect()
    assert [(r["index"], r.response) for r in got] == [(0, "say 0"), (1, "say 1"), (2, "say 2")]
    put(tmp_path / "p.jsonl", "\n".join(json.dumps({"index": i, "response": f"a mask {i}" if i else "fine"}) for i in range(3)) + "\n")
    assert cli.main(["evaluate", "--reference", str(tmp_path / "val.jsonl"), "--prediction", str(tmp_path / "p.jsonl"), "--output-dir", str(tmp_path / "e")]) == 0
    about = json.load(open(tmp_path / "e/model_summary.json"))
    assert about["num_samples"] == 3 and about["format_success_count"] == 1 and len(open(tmp_path / "e/model_per_sample.jsonl").readlines()) == 3


PLUGIN = '''
def vectors(texts, **options):
    return [[[float(len(w)), 1.0] for w in t.split()] for t in texts]


def paid(system, user):
    if user[0]["text"] == "say 4":
        raise RuntimeError("no answer")
    return {"response": user[0]["text"].upper()}
'''


@pytest.fixture(scope="module")
def plugin(spark, tmp_path_factory):
    """A module of the user's own, which the session sends to the workers."""
    folder = tmp_path_factory.mktemp("plugin")
    (folder / "own_model.py").write_text(PLUGIN)
    spark.sparkContext.addPyFile(str(folder / "own_model.py"))
    sys.path.insert(0, str(folder))
    return "own_model"


def test_scores_from_the_command_line(spark, tmp_path, plugin):
    rows = [{"messages": [{"role": "user", "content": "x"}, {"role": "assistant", "content": f"word {i}"}]} for i in range(3)]
    put(tmp_path / "val.jsonl", "\n".join(map(json.dumps, rows)) + "\n")
    put(tmp_path / "p.jsonl", "\n".join(json.dumps({"response": f"word {i}"}) for i in range(3)) + "\n")
    args = ["evaluate", "--reference", str(tmp_path / "val.jsonl"), "--prediction", str(tmp_path / "p.jsonl"), "--output-dir", str(tmp_path / "e")]
    assert cli.main([*args, "--embedder", f"{plugin}:vectors"]) == 0
    about = json.load(open(tmp_path / "e/model_summary.json"))
    assert about["bertscore_f1"] == pytest.approx(1) and about["metric_config"]["bert_num_layers"] == 24
    got = [json.loads(x) for x in open(tmp_path / "e/model_per_sample.jsonl")]
    assert [r["index"] for r in got] == [0, 1, 2] and got[0]["bertscore_p"] == pytest.approx(1)
    put(tmp_path / "p.jsonl", '{"response": "a"}\n[1]\n')
    with pytest.raises(ValueError, match="p.jsonl:2"):
        cli.main(args)


def test_answers_outlive_a_run_that_fails(spark, tmp_path, plugin):
    rows = [{"messages": [{"role": "user", "content": f"say {i}"}]} for i in range(6)]
    put(tmp_path / "v/a.jsonl", "\n".join(map(json.dumps, rows[:3])) + "\n")
    put(tmp_path / "v/b.jsonl", "\n".join(map(json.dumps, rows[3:])) + "\n")
    out = str(tmp_path / "pred")
    args = ["infer", "--dataset", str(tmp_path / "v"), "--output", out, "--request-interval", "0", "--retry-wait-seconds", "0", "--max-retries", "2"]
    with pytest.raises(Exception, match="no answer"):
        cli.main([*args, "--client", f"{plugin}:paid"])
    kept = {r["index"]: r.response for r in infer.answers(spark, out).collect()}
    assert kept and 4 not in kept and all(v == f"SAY {k}" for k, v in kept.items())
    assert cli.main(args) == 0
    now = {r["index"]: r.response for r in infer.answers(spark, out).collect()}
    assert sorted(now) == list(range(6)) and kept.items() <= now.items() and now[4] == "say 4"


def test_media_are_sent_to_a_server(spark, tmp_path):
    asked = []

    class Server(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            asked.append((self.path, self.headers["Authorization"], json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            body = json.dumps({"choices": [{"message": {"content": " fine "}}], "usage": {"prompt_tokens": 1, "completion_tokens": 2, "total_tokens": 3}}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    put(tmp_path / "media/a.png", png())
    row = {"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "<image>look<video>"}], "images": ["a.png"], "videos": [["a.png", "a.png"]]}
    put(tmp_path / "val.jsonl", json.dumps(row) + "\n")
    args = ["infer", "--dataset", str(tmp_path / "val.jsonl"), "--media-root", str(tmp_path / "media"), "--base-url", f"http://127.0.0.1:{server.server_port}/v1", "--model", "m", "--max-tokens", "7", "--request-interval", "0"]
    assert cli.main([*args, "--output", str(tmp_path / "pred")]) == 0
    server.shutdown()
    path, _, body = asked[0]
    assert path == "/v1/chat/completions" and body["model"] == "m" and body["max_tokens"] == 7 and body["messages"][0] == {"role": "system", "content": "s"}
    parts = body["messages"][1]["content"]
    url = f"data:image/png;base64,{base64.b64encode(png()).decode()}"
    assert parts == [{"type": "image_url", "image_url": {"url": url}}, {"type": "text", "text": "look"}, {"type": "video", "video": [url, url]}]
    got = infer.answers(spark, str(tmp_path / "pred")).first()
    assert got.response == "fine" and got.usage.total_tokens == 3


def test_compare_checks_first(spark, tmp_path, plugin):
    put(tmp_path / "val.jsonl", json.dumps({"messages": [{"role": "user", "content": "say 1"}]}) + "\n")
    args = ["compare", "--dataset", str(tmp_path / "val.jsonl"), "--output-dir", str(tmp_path / "o"), "--request-interval", "0"]
    with pytest.raises(ValueError, match="no client for lora"):
        cli.main([*args, "both", "--base-client", f"{plugin}:paid"])
    assert not os.path.exists(tmp_path / "o")
    with pytest.raises(FileNotFoundError):
        cli.main(["compare", "--dataset", str(tmp_path / "none"), "--output-dir", str(tmp_path / "o")])
    assert cli.main([*args, "base", "--base-client", f"{plugin}:paid"]) == 0 and infer.answers(spark, str(tmp_path / "o/base")).first().response == "SAY 1"


def test_json_lines(spark, tmp_path):
    put(tmp_path / "a.jsonl", '{"index": 1, "response": "x"}\n\n{"index": 2}\n')
    put(tmp_path / "b/bad.jsonl", '{"index": 1}\n[1]\n{oops\n')
    assert readers.lines(spark, str(tmp_path / "a.jsonl"), "index long, response string").count() == 2
    assert len(readers.lines(spark, str(tmp_path / "a.jsonl"), "index long, response string", strict=True).collect()) == 2
    with pytest.raises(Exception, match="not an object"):
        readers.lines(spark, str(tmp_path / "b/bad.jsonl"), "index long", strict=True).collect()
    with pytest.raises(Exception):  # noqa: B017
        readers.lines(spark, str(tmp_path / "b/bad.jsonl"), "index long").collect()
    assert len(readers.lines(spark, str(tmp_path), "index long", strict=False, recursive=True).where("false").collect()) == 0
    got = readers.numbered_lines(spark, str(tmp_path / "a.jsonl"), "index long").orderBy("line").collect()
    assert [(r.line, r["index"]) for r in got] == [(1, 1), (3, 2)]
    assert [r.error is None for r in readers.numbered_lines(spark, str(tmp_path / "b/bad.jsonl"), "index long").orderBy("line").collect()] == [True, False, False]


def test_archives(spark, tmp_path):
    z, t = str(tmp_path / "a.zip"), str(tmp_path / "b.tar")
    with zipfile.ZipFile(z, "w") as a:
        a.writestr("dir\\x.png" if os.sep == "/" else "dir/x.png", png())
        a.writestr("dir/y.txt", "hi")
    put(tmp_path / "m.txt", "member")
    with tarfile.open(t, "w") as a:
        a.add(tmp_path / "m.txt", "./JPEG/m.txt")
    assert {tuple(r) for r in archives.members(spark, [z, t]).collect()} == {(z, "dir/x.png"), (z, "dir/y.txt"), (t, "JPEG/m.txt")}
    wanted = spark.createDataFrame([(z, "dir/x.png", "o/x.png"), (t, "JPEG/m.txt", "o/m.txt")], "archive string, member string, target string")
    for _ in range(2):
        assert archives.extract(wanted, str(tmp_path)).count() == 2
    assert (tmp_path / "o/m.txt").read_text() == "member"
    with pytest.raises(Exception, match="isn't in"):
        archives.extract(spark.createDataFrame([(z, "no", "o/no")], wanted.schema), str(tmp_path)).collect()
    put(tmp_path / "i/good.png", png(7, 9))
    put(tmp_path / "i/cut.png", png()[:-20])
    put(tmp_path / "i/text.jpg", "no image")
    got = {os.path.basename(r.path): (r.width, r.height, r.error) for r in archives.verified(spark, str(tmp_path / "i")).collect()}
    assert got == {"good.png": (7, 9, None), "cut.png": (64, 48, "cut off"), "text.jpg": (None, None, "not an image")}


PILLOW = '''
"""As much of Pillow as cutting needs, on images that are text."""
class _Held:
    def __init__(self, said): self.said = said
    def __enter__(self): return self
    def __exit__(self, *a): pass
    def verify(self): pass
    def convert(self, mode): return _Held([*self.said, mode])
    def crop(self, box): return _Held([*self.said, list(box)])
    def resize(self, size, how): return _Held([*self.said, list(size), how])
    def save(self, path, kind, **options):
        import json
        with open(path, "w") as f:
            json.dump([*self.said, kind, options], f)
class Image:
    class Resampling: LANCZOS = "lanczos"
    @staticmethod
    def open(path): return _Held([str(path)[-5:] if isinstance(path, str) else "bytes"])
class ImageOps:
    @staticmethod
    def exif_transpose(image): return _Held([*image.said, "upright"])
'''


def test_render_cuts_where_pillow_is(spark, tmp_path):
    crops = spark.createDataFrame([("src/a.png", "templates/x/a.jpg", 1, 2, 30, 31), ("src/b.png", "templates/x/b.jpg", 0, 0, 5, 5)], "source_image string, template_image string, left int, top int, right int, bottom int")
    try:
        import PIL  # noqa: F401
    except ImportError:
        with pytest.raises(Exception, match="Pillow"):
            archives.render(crops, str(tmp_path)).collect()
    (tmp_path / "p/PIL").mkdir(parents=True)
    (tmp_path / "p/PIL/__init__.py").write_text(PILLOW)
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(cli.__file__)))!r})
from frameloom.session import local_session
from frameloom.sources import archives
spark = local_session("x", "2", 2)
crops = spark.createDataFrame([("src/a.png", "templates/x/a.jpg", 1, 2, 30, 31)], "source_image string, template_image string, left int, top int, right int, bottom int")
print("made", [r.path for r in archives.render(crops, {str(tmp_path)!r}, 64).collect()])
"""
    said = subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYTHONPATH": str(tmp_path / "p")}, capture_output=True, text=True, timeout=300)
    assert "made" in said.stdout, said.stderr[-2000:]
    assert json.load(open(tmp_path / "templates/x/a.jpg")) == ["a.png", "upright", "RGB", [1, 2, 30, 31], [64, 64], "lanczos", "JPEG", {"quality": 95, "subsampling": 0}]
    assert os.listdir(tmp_path / "templates/x") == ["a.jpg"]


def test_png_is_decoded():
    good = png(7, 9)
    assert archives.png_problem(good) is None
    assert archives.png_problem(good[:-3]) == "cut off" and archives.png_problem(good[:20]) == "cut off"
    assert archives.png_problem(good.replace(b"IDAT", b"IDAX")) == "wrong checksum"
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = good[:8] + chunk(b"IHDR", struct.pack(">IIBBBBB", 7, 9, 8, 0, 0, 0, 0))
    assert archives.png_problem(head + chunk(b"IDAT", zlib.compress(b"\0" * 70)) + chunk(b"IEND", b"")) == "pixels are missing"
    assert archives.png_problem(head + chunk(b"IDAT", b"xx") + chunk(b"IEND", b"")) == "pixels can't be unpacked"
    assert archives.png_problem(good[:8] + chunk(b"IEND", b"")) == "no header"


def test_image_sizes():
    assert archives.image_size(b"GIF89a" + struct.pack("<HH", 3, 4)) == (3, 4)
    assert archives.image_size(b"BM" + b"\0" * 16 + struct.pack("<ii", 5, -6)) == (5, 6)
    assert archives.image_size(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 8, 9) + b"\0" * 20) == (9, 8)
    assert archives.image_size(b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + (9).to_bytes(3, "little") + (4).to_bytes(3, "little")) == (10, 5)
    assert archives.image_size(b"") is None


def test_listings(spark, tmp_path):
    for name in ("b/img10.PNG", "a/img2.png", "a/img10.png", "a/notes.txt"):
        put(tmp_path / name, png())
    assert {r.name: os.path.basename(os.path.dirname(r.path)) for r in files.image_index(spark, str(tmp_path)).collect()} == {"img2.png": "a", "img10.png": "a", "img10.PNG": "b"}
    assert [r.name for r in files.images(spark, str(tmp_path / "a")).orderBy("key").collect()] == ["img2.png", "img10.png"]
    with pytest.raises(FileNotFoundError):
        files.dataset_folder(str(tmp_path), "none")
    put(tmp_path / "e/empty.txt", "\n\n")
    with pytest.raises(Exception, match="empty first line"):
        files.first_lines(spark, str(tmp_path / "e/empty.txt")).collect()
    one, two = spark.createDataFrame([("k", "a")], "k string, v string"), spark.createDataFrame([("k", "b"), ("l", "c")], "k string, v string")
    assert {tuple(r) for r in files.prefer(one, two, "k", "v").collect()} == {("k", "a"), ("l", "c")}
    made = spark.createDataFrame([("/x",), ("y",)], "p string").select(files.absolute_media(F.col("p"), "/d/val.jsonl"), files.absolute_media(F.col("p"), "/d/val.jsonl", "/m/"))
    assert [tuple(r) for r in made.collect()] == [("/x", "/x"), ("/d/y", "/m/y")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(i, "ü" if i % 2 else None) for i in range(20)], "ordinal long, text string")
    assert sinks.write_file(df.repartition(5), str(tmp_path / "one.jsonl"), "ordinal") == 20
    lines = open(tmp_path / "one.jsonl", encoding="utf-8").read().splitlines()
    assert lines[0] == "{}" and lines[1] == '{"text":"ü"}'
    records = spark.createDataFrame([("a", "sorec")], "sample_id string, source string")
    sinks.write_manifest(records, str(tmp_path / "m"))
    sinks.write_manifest(records.withColumn("source", F.lit("tnl2k")), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 2


def test_stream_takes_only_what_is_new(spark, tmp_path):
    source, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    df = spark.range(10)
    df.write.parquet(source)
    assert run_available(spark, source, df.schema, target, mark) == 10 and run_available(spark, source, df.schema, target, mark) == 0
    spark.range(10, 14).write.mode("append").parquet(source)
    assert run_available(spark, source, df.schema, target, mark) == 4 and spark.read.parquet(target).count() == 14


def test_schemas_parse(spark):
    for ddl in (schemas.DESCRIBED_OBJECTS, schemas.SMALL_OBJECTS, schemas.EXPRESSION, schemas.TRACKING, schemas.MOTION, schemas.TEMPLATE, schemas.ROW, schemas.PREDICTION):
        assert spark.createDataFrame([], ddl).count() == 0
