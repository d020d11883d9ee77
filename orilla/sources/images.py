"""Folders of images: listing, sniffing, decoding, and writing crops."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orilla import storage
from orilla.functions import payload

MAX_PIXELS = 512_000_000


def scan(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """path, modificationTime, length, content of all image files below a folder, in order of the path if limited."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    files = files.where(payload.is_image_file(F.col("path"), F.col("content")))
    return files.orderBy("path").limit(limit) if limit is not None else files


def exif_orientation(content: bytes) -> int:
    """The orientation in a JPEG's EXIF block, 1 if there is none."""
    if content[:2] != b"\xff\xd8":
        return 1
    at = 2
    while at + 4 <= len(content) and content[at] == 0xFF:
        marker, size = content[at + 1], int.from_bytes(content[at + 2 : at + 4], "big")
        part = content[at + 4 : at + 2 + size]
        if marker == 0xE1 and part[:6] == b"Exif\x00\x00":
            tiff = part[6:]
            order = {b"II": "little", b"MM": "big"}.get(tiff[:2])
            if order is None:
                return 1
            num = lambda a, n: int.from_bytes(tiff[a : a + n], order)
            first = num(4, 4)
            for i in range(num(first, 2)):
                entry = first + 2 + 12 * i
                if num(entry, 2) == 0x0112:
                    value = num(entry + 8, 2)
                    return value if 1 <= value <= 8 else 1
            return 1
        if marker == 0xDA:
            return 1
        at += 2 + size
    return 1


def orientations(files: DataFrame) -> DataFrame:
    """source and orientation of the files that aren't upright; only JPEG heads are looked at."""

    def run(frames):  # noqa: ANN001, ANN202
        for f in frames:
            f = f.assign(orientation=[exif_orientation(bytes(c)) for c in f["head"]])
            yield f.loc[f["orientation"] != 1, ["source", "orientation"]]

    heads = files.where(F.startswith("content", F.unhex(F.lit("FFD8FF")))).select(F.col("path").alias("source"), F.substring("content", 1, 65536).alias("head"))
    return heads.mapInPandas(run, "source string, orientation int")


def fingerprints(files: DataFrame) -> DataFrame:
    """path, length and SHA-256 of the content."""
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def decode(spark: SparkSession, folder: str, max_pixels: int = MAX_PIXELS) -> DataFrame:
    """source, image, error and EXIF orientation; undecodable files and those over the pixel ceiling have an error."""
    rows = spark.read.format("image").option("recursiveFileLookup", True).load(folder)
    w, h = F.col("image.width"), F.col("image.height")
    error = F.when(w < 0, "unsupported_format").when(w.cast("long") * h > max_pixels, "image_too_large_blocked")
    out = rows.select(F.col("image.origin").alias("source"), F.when(error.isNull(), F.col("image")).alias("image"), error.alias("error"))
    turned = orientations(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder))
    return out.join(turned, "source", "left").withColumn("orientation", F.coalesce("orientation", F.lit(1)))


def png(rgb: np.ndarray) -> bytes:
    """An RGB raster as PNG."""
    h, w = rgb.shape[:2]
    raw = np.concatenate([np.zeros((h, 1), np.uint8), rgb.reshape(h, w * 3)], 1).tobytes()
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def bmp(rgb: np.ndarray) -> bytes:
    """An RGB raster as 24-bit BMP."""
    h, w = rgb.shape[:2]
    pad = -w * 3 % 4
    body = np.pad(rgb[::-1, :, ::-1].reshape(h, w * 3), ((0, 0), (0, pad))).astype(np.uint8).tobytes()
    return struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 2835, 2835, 0, 0) + body


def write_crops(decoded: DataFrame, decisions: DataFrame, out: str) -> None:
    """Writes each crop once, as PNG or BMP by the source's extension; a file appears whole or not at all.

    decisions: source, status, crop_box, out_name. Only rows with status ok are written.
    """
    from orilla.operators.raster import to_rgb, upright

    rows = decoded.join(decisions.where("status = 'ok'"), "source").select("image", "orientation", "crop_box", "out_name")

    def save(part) -> None:  # noqa: ANN001
        for r in part:
            i, b = r["image"], r["crop_box"]
            rgb = upright(to_rgb(i["data"], i["height"], i["width"], i["nChannels"]), r["orientation"])[b["y"] : b["y"] + b["h"], b["x"] : b["x"] + b["w"]]
            name = f"{out}/{r['out_name']}"
            storage.write(name, bmp(rgb) if name.lower().endswith(".bmp") else png(rgb))

    rows.foreachPartition(save)
