"""Members of ZIP and TAR archives, and images."""

from __future__ import annotations

import os
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from .files import plain_path


def _open(path: str):
    return zipfile.ZipFile(path) if zipfile.is_zipfile(path) else tarfile.open(path)


def _names(archive) -> dict[str, str]:
    """Files by their name with forward slashes."""
    if isinstance(archive, zipfile.ZipFile):
        return {i.filename.replace("\\", "/"): i.filename for i in archive.infolist() if not i.is_dir()}
    return {m.name.replace("\\", "/").removeprefix("./"): m.name for m in archive.getmembers() if m.isfile()}


def _bytes(archive, name: str) -> bytes:
    if isinstance(archive, zipfile.ZipFile):
        return archive.read(name)
    held = archive.extractfile(name)
    assert held is not None
    return held.read()


def members(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(archive, member): the files in archives of a shared folder, one task an archive; nothing is unpacked."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["archive"]:
                with _open(path) as archive:
                    yield pd.DataFrame({"archive": path, "member": list(_names(archive))})

    ship(spark)
    made = spark.createDataFrame([(p,) for p in paths], "archive string").repartition(max(1, len(paths)), "archive")
    return made.mapInPandas(run, "archive string, member string")


def extract(wanted: DataFrame, root: str) -> DataFrame:
    """(archive, member, path): unpacks members (archive, member, target: path below root) into a shared folder.

    A file that is there already is used again; files appear under their name only when complete; a member that an archive lacks is an error.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, part in pdf.groupby("archive", sort=False):
                with _open(path) as archive:
                    names = _names(archive)
                    for member, target in zip(part["member"], part["target"], strict=True):
                        place = os.path.join(root, target)
                        if not os.path.exists(place):
                            if member not in names:
                                raise FileNotFoundError(f"{member} isn't in {path}")
                            os.makedirs(os.path.dirname(place), exist_ok=True)
                            half = f"{place}.{os.getpid()}.part"
                            with open(half, "wb") as f:
                                f.write(_bytes(archive, names[member]))
                            os.replace(half, place)
                        out.append((path, member, place))
            yield pd.DataFrame(out, columns=["archive", "member", "path"])

    ship(wanted.sparkSession)
    return wanted.select("archive", "member", "target").mapInPandas(run, "archive string, member string, path string")


def image_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) told by an image's header; null for what is no PNG, JPEG, GIF, BMP or WebP."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return struct.unpack("<HH", data[6:10])
    if data[:2] == b"BM" and len(data) >= 26:
        w, h = struct.unpack("<ii", data[18:26])
        return w, abs(h)
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP" and len(data) >= 30:
        if data[12:16] == b"VP8X":
            return 1 + int.from_bytes(data[24:27], "little"), 1 + int.from_bytes(data[27:30], "little")
        if data[12:16] == b"VP8 ":
            return struct.unpack("<HH", data[26:30])[0] & 0x3FFF, struct.unpack("<HH", data[26:30])[1] & 0x3FFF
        bits = int.from_bytes(data[21:25], "little")
        return (bits & 0x3FFF) + 1, ((bits >> 14) & 0x3FFF) + 1
    if data[:2] == b"\xff\xd8":
        i = 2
        while i + 9 < len(data):
            if data[i] != 0xFF:
                return None
            marker, length = data[i + 1], int.from_bytes(data[i + 2 : i + 4], "big")
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[i + 5 : i + 9])
                return w, h
            i += 2 + length
    return None


def png_problem(data: bytes) -> str | None:
    """What is wrong with a PNG: a chunk that is cut or whose checksum differs, or pixels that don't unpack to its size; null if it is sound."""
    at, packed, size, channels = 8, [], None, {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
    while True:
        if at + 12 > len(data):
            return "cut off"
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body, end = data[at + 8 : at + 8 + n], at + 12 + n
        if end > len(data):
            return "cut off"
        if zlib.crc32(kind + body) != struct.unpack(">I", data[end - 4 : end])[0]:
            return "wrong checksum"
        if kind == b"IHDR" and n == 13:
            size = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        elif kind == b"IEND":
            break
        at = end
    if size is None:
        return "no header"
    try:
        pixels = zlib.decompress(b"".join(packed))
    except zlib.error:
        return "pixels can't be unpacked"
    width, height, depth, colour, *_, woven = size
    row = 1 + (width * depth * channels.get(colour, 1) + 7) // 8
    return None if woven or len(pixels) == row * height else "pixels are missing"


def verified(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, width, height, error): image files with the size their header tells; error for files that aren't images or are cut.

    With Pillow installed an image is decoded as well.
    """

    def problem(data: bytes) -> str | None:
        if image_size(data) is None:
            return "not an image"
        if data[:8] == b"\x89PNG\r\n\x1a\n" and (bad := png_problem(data)):
            return bad
        if data[:2] == b"\xff\xd8" and b"\xff\xd9" not in data[-64:]:
            return "cut off"
        try:
            import io

            from PIL import Image
        except ImportError:
            return None
        try:
            Image.open(io.BytesIO(data)).verify()
        except Exception as e:
            return str(e)
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes = [image_size(x) or (None, None) for x in pdf["content"]]
            out = pd.DataFrame({"path": pdf["path"], "width": [s[0] for s in sizes], "height": [s[1] for s in sizes], "error": [problem(x) for x in pdf["content"]]})
            yield out.astype({"width": "Int32", "height": "Int32"})

    ship(spark)
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select(plain_path(F.col("path")).alias("path"), "content")
    return read.mapInPandas(run, "path string, width int, height int, error string")


def render(crops: DataFrame, root: str, size: int = 336, quality: int = 95) -> DataFrame:
    """(path): cuts crops (source_image, template_image, left, top, right, bottom) out of images below a shared root and writes them as JPEG squares.

    Needs Pillow; without it an error says so.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            from PIL import Image, ImageOps
        except ImportError as e:
            raise RuntimeError("cutting images needs Pillow") from e
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                place = os.path.join(root, r.template_image)
                os.makedirs(os.path.dirname(place), exist_ok=True)
                with Image.open(os.path.join(root, r.source_image)) as held:
                    cut = ImageOps.exif_transpose(held).convert("RGB").crop((r.left, r.top, r.right, r.bottom)).resize((size, size), Image.Resampling.LANCZOS)
                half = f"{place}.{os.getpid()}.part"
                cut.save(half, "JPEG", quality=quality, subsampling=0)
                os.replace(half, place)
                out.append(place)
            yield pd.DataFrame({"path": out})

    ship(crops.sparkSession)
    return crops.mapInPandas(run, "path string")
